from __future__ import annotations

import random
import re
from collections import Counter, defaultdict
from itertools import combinations

import pytest
from pyspark.sql import functions as F

from grovelift.llm import divergence
from grovelift.llm.divergence import PatternTree, source_divergence, term_counts, terms_of

TERM = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


def brute(rows, least, top):
    """Every pair of sources by all its terms; rows are (text, lang, source)."""
    rows = [tuple(v or "" for v in r) for r in rows]
    documents, counts = defaultdict(Counter), defaultdict(Counter)
    for text, lang, source in rows:
        found = [t.translate(LOWER) for t in TERM.findall(text)]
        documents[lang].update(set(found))
        counts[lang, source].update(found)
    out = []
    for lang in {r[1] for r in rows}:
        kept = sorted(t for t, n in documents[lang].items() if n >= least)
        sources = sorted({r[2] for r in rows if r[1] == lang})

        def shares(held, kept=kept):
            total = sum(held[t] for t in kept)
            return {t: 1 + 10**9 * (held[t] + 5) // (total + 5 * len(kept)) for t in kept}

        whole = shares(sum((counts[lang, s] for s in sources), Counter()))
        p = {s: shares(counts[lang, s]) for s in sources}
        for s in sources:
            pairs = [(-sum(abs(p[s][t] - p[o][t]) for t in kept), o) for o in sources if o != s]
            own = counts[lang, s]
            terms = [(whole[t] - p[s][t], t) for t in kept if own[t] and p[s][t] > whole[t]]
            by = lambda x: (x[0], x[1].encode())
            for part, found, most in (("pair", pairs, len(pairs)), ("term", terms, top)):
                for rank, (value, item) in enumerate(sorted(found, key=by)[:most], 1):
                    out.append((lang, s, part, item, -value, rank))
    return sorted(out)


def frame(spark, rows):
    return spark.createDataFrame(rows, "text string, lang string, source string")


def corpus(n, seed):
    rng = random.Random(seed)
    words = ["the", "The", "été", "Éa", "x1y", "z-w", "ß", "日本", "q", "a", "b", "c", "d", "long" * 9]
    sources = [None, "", "s1", "s2", "hot", "é", "z"]
    rows = []
    for _ in range(n):
        text = " ".join(rng.choices(words, [9, 5, 3, 2, 2, 2, 1, 1, 4, 4, 3, 2, 1, 1], k=rng.randint(0, 20)))
        source = "hot" if rng.random() < 0.4 else rng.choice(sources)
        rows.append((text or None, rng.choice(["en", "en", "fr", None, ""]), source))
    return rows


def test_terms():
    for text in ("The quick-Brown É1é_x ÀÀ", "", "a\x00b\x7fc[d`e{f", "Ü" * 3 + "A" * 3):
        assert [t.decode() for t in terms_of(text.encode())] == [t.translate(LOWER) for t in TERM.findall(text)]


def test_tree_against_all_pairs_of_rows():
    rng = random.Random(3)
    z = {s: rng.randint(1, 50) for s in "abcdefgh"}
    rows = [
        ([(s, z[s] + rng.randint(0, 3), z[s]) for s in sorted(rng.sample("abcdefgh", rng.randint(1, 8)))], rng.randint(1, 4))
        for _ in range(200)
    ]
    tree, expected = PatternTree(), Counter()
    for row, times in rows:
        tree.insert(row, times)
        for (s, p, y), (t, q, w) in combinations(row, 2):
            expected[s, t] += times * (abs(p - q) - abs(p - w) - abs(y - q) + abs(y - w))
    assert {k: v for k, v in tree.walk().items() if v} == {k: v for k, v in expected.items() if v}
    assert len(tree.nodes) - 1 < sum(len(row) for row, _ in rows)  # paths are shared


def test_deep_rows_of_a_tree():
    tree = PatternTree()
    row = [(f"{i:04}", i + 2, i % 3) for i in range(300)]
    tree.insert(row, 2)
    sums = tree.walk()
    assert len(sums) == 300 * 299 // 2
    s, t = row[7], row[250]
    value = abs(s[1] - t[1]) - abs(s[1] - t[2]) - abs(s[2] - t[1]) + abs(s[2] - t[2])
    assert sums["0007", "0250"] == 2 * value


@pytest.mark.parametrize("n, least, top, held", [(150, 3, 2, 10), (400, 12, 50, 10**6), (60, 1, 50, 100)])
def test_against_brute_force(spark, monkeypatch, n, least, top, held):
    monkeypatch.setattr(divergence, "_HELD_COUNTS", held)
    monkeypatch.setattr(divergence, "_HELD_PAIRS", held)
    rows = corpus(n, n) * 2 + [("lone", "xx", "s1"), ("", "yy", "s1"), (None, "yy", None)]
    df = frame(spark, rows)
    for name in ("term", "n", "docs", "part", "item", "value", "rank", "path", "z"):  # clashing names
        df = df.withColumn(name, F.lit("x"))
    got = sorted(map(tuple, source_divergence(df, least, top).collect()))
    assert got == brute(rows, least, top)


def test_very_long_texts(spark):
    rows = [("word " * 200_000 + "tail", "en", "a"), ("other word", "en", "b")]
    assert sorted(map(tuple, source_divergence(frame(spark, rows), 1).collect())) == brute(rows, 1, 50)


def test_empty(spark):
    none = frame(spark, [])
    assert source_divergence(none).collect() == [] and term_counts(none).collect() == []
    alone = frame(spark, [("a b", "en", "s")])
    assert source_divergence(alone, 1).collect() == []
