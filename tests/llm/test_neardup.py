from __future__ import annotations

import random
import re
from itertools import combinations

import numpy as np
import pyarrow as pa
import pytest

from grovelift.llm.components import components
from grovelift.llm.neardup import least_overlap, near_duplicates
from grovelift.llm.shingles import digest, shingle_sets

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def shingles(text, words):
    found = [w for w in re.split("[\x20\x09-\x0d]+", (text or "").translate(LOWER)) if w]
    if len(found) < words:
        return {tuple(found)} if found else set()
    return {tuple(found[i : i + words]) for i in range(len(found) - words + 1)}


def brute(rows, words, percent):
    """(doc_id, n_shingles, component_id, kept) by comparing every pair."""
    sets = {i: shingles(t, words) for i, t in rows}
    top = {i: i for i in sets}

    def find(i):
        while top[i] != i:
            i = top[i]
        return i

    for a, b in combinations(sorted(sets), 2):
        both = len(sets[a] & sets[b])
        if both and both * 100 >= len(sets[a] | sets[b]) * percent:
            x, y = sorted((find(a), find(b)))
            top[y] = x
    return sorted((i, len(s), find(i), find(i) == i) for i, s in sets.items())


def got(frame, words, percent):
    return sorted(map(tuple, near_duplicates(frame, words, percent).collect()))


def edited(rng, text, share, mark):
    return " ".join(f"{mark}{i}" if rng.random() < share else w for i, w in enumerate(text.split()))


def corpus(seed):
    """Exact copies, chains and stars of near copies, shared passages, odd texts."""
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(400)]
    passage = " ".join(rng.choices(vocabulary, k=60))

    def fresh(n):
        return " ".join(rng.choices(vocabulary, k=n))

    texts = [fresh(rng.randint(3, 200)) for _ in range(40)]
    hub = fresh(150)
    texts += [hub] + [edited(rng, hub, rng.choice([0.01, 0.03, 0.05]), f"e{i}_") for i in range(60)]
    chain = fresh(120)
    for i in range(15):
        texts.append(chain)
        chain = edited(rng, chain, 0.02, f"c{i}_")
    texts += [fresh(20) + " " + passage + " " + fresh(rng.randint(1, 60)) for _ in range(60)]
    texts += [passage] * 20 + ["One two", "one  TWO", "one", "", " \t\n", None, "É é", "é É", hub.upper()]
    rng.shuffle(texts)
    return list(enumerate(texts))


@pytest.mark.parametrize("seed, words, percent", [(0, 3, 85), (1, 5, 80)])
def test_against_all_pairs(documents, seed, words, percent):
    rows = corpus(seed)
    assert got(documents(rows), words, percent) == brute(rows, words, percent)


@pytest.mark.parametrize("seed", [3, 4])
def test_many_copies_similar_or_not(documents, seed):
    """Edits of one text of all strengths, parts of it, and edits of edits."""
    rng = random.Random(seed)
    base = " ".join(f"w{rng.randrange(300)}" for _ in range(140))
    words = base.split()
    texts = [base] + [edited(rng, base, rng.choice([0.01, 0.04, 0.08]), f"e{i}_") for i in range(70)]
    for i in range(40):
        start = rng.randrange(40)
        part = words[start : start + rng.randint(60, 110)]
        texts += [" ".join(part), " ".join(part[1:]), " ".join([*part[:-2], f"p{i}"])]
    for i in range(12):
        strong = edited(rng, base, 0.15, f"s{i}_")
        texts += [strong, edited(rng, strong, 0.01, f"t{i}_")]
    rng.shuffle(texts)
    rows = list(enumerate(texts))
    expected = brute(rows, 3, 85)
    assert got(documents(rows), 3, 85) == expected
    assert 5 < len({r[2] for r in expected}) < len(rows) - 20


def test_sample_table(table):
    rows = [(r.doc_id, r.text) for r in table("documents").collect()]
    assert got(table("documents"), 3, 85) == brute(rows, 3, 85)


def test_texts_without_words(documents):
    rows = [(3, None), (1, ""), (2, " \n")]
    assert got(documents(rows), 3, 85) == [(1, 0, 1, True), (2, 0, 2, True), (3, 0, 3, True)]


def test_repeated_rows_and_missing_ids(documents):
    rows = [(7, "a b c d"), (7, "a b c d"), (5, "A B C D"), (None, "a b c d"), (None, None)]
    found = near_duplicates(documents(rows), 3, 85).collect()
    assert sorted(map(str, map(tuple, found))) == [
        "(5, 2, 5, True)",
        "(7, 2, 5, False)",
        "(7, 2, 5, False)",
        "(None, 0, None, True)",
        "(None, 2, None, True)",
    ]


def test_empty(documents):
    assert near_duplicates(documents([])).collect() == []


def test_sets_do_not_depend_on_the_batch():
    texts = ["a b c d e", None, "", "x", "A  b\tc D e", "é b c", "long " * 5000] * 3
    whole = [digest(s) if len(s) else None for s in shingle_sets(pa.array(texts), 3)]
    alone = [
        digest(s) if len(s) else None for t in texts for s in shingle_sets(pa.array([t], pa.string()), 3)
    ]
    sliced = list(shingle_sets(pa.array(["zz", *texts]).slice(1), 3))
    assert whole == alone == [digest(s) if len(s) else None for s in sliced]
    assert whole[0] == whole[4] and whole[1] is None
    assert [len(s) for s in shingle_sets(pa.array(texts[:7]), 3)] == [3, 0, 0, 1, 3, 1, 1]


def test_least_overlap_is_safe():
    rng = np.random.default_rng(0)
    least = least_overlap(64, 85)
    assert 30 < least < 45
    assert (rng.binomial(64, 0.85, 200_000) >= least).all()


def test_components_of_a_long_chain_and_a_star(spark):
    chain = [(i, i + 1) for i in range(10, 60)]
    star = [(100, i) for i in range(101, 160)] + [(101, 100), (100, 100)]
    pairs = spark.createDataFrame(chain + star + [(None, 3)], "a long, b long")
    found = dict(map(tuple, components(pairs).collect()))
    assert found == {i: 10 for i in range(10, 61)} | {i: 100 for i in range(100, 160)}
    assert components(pairs.limit(0)).collect() == []
