from __future__ import annotations

import math
import random
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from grovelift.llm import outliers as o
from grovelift.llm.outliers import chi2_cdf, chi2_quantile, judge_documents, text_counts


def brute_counts(text):
    text = text or ""
    words, word = [], ""
    for c in text + " ":
        if c in " \t\n\x0b\x0c\r":
            words += [word] if word else []
            word = ""
        else:
            word += c
    windows = Counter(tuple(words[i : i + 3]) for i in range(len(words) - 2))
    covered = {
        j for i in range(len(words) - 2) if windows[tuple(words[i : i + 3])] > 1 for j in range(i, i + 3)
    }
    seen, repeated, lines = set(), 0, 0
    for line in text.split("\n"):
        if line.strip(" \t\n\x0b\x0c\r"):
            lines += 1
            repeated += line in seen
            seen.add(line)
    symbols = sum(c in "#*$%&|<>" for c in text)
    return (len(words), sum(map(len, words)), symbols, repeated, len(covered), lines)


@pytest.mark.parametrize("seed", range(30))
def test_counts(seed):
    rng = random.Random(seed)
    parts = ["a", "b", "cc", "é#", "日本", " ", " ", "\n", "\t", "\r\n", "\x0b", "\x0c", "\x1c", "\xa0", " ", "|", "$%"]
    text = "".join(rng.choices(parts, k=rng.choice([0, 1, 5, 50, 400])))
    assert text_counts(text) == brute_counts(text)


def test_counts_of_special_texts():
    assert text_counts(None) == text_counts("") == (0,) * 6
    assert text_counts("x " * 100_000)[:5] == (100_000, 100_000, 0, 0, 100_000)
    assert text_counts("a b c a b c")[4] == 6 and text_counts("a a a")[4] == 0
    assert text_counts("l\nl\n \n\nl")[3] == 2


def test_chi2():
    assert chi2_cdf(2 * math.log(2), 2) == pytest.approx(0.5)
    assert chi2_quantile(0.95, 1) == pytest.approx(3.841458820694124)
    assert chi2_quantile(0.975, 5) == pytest.approx(12.832501994030027)


# -- the estimate of one group, on arrays


def binned_subset(d, n):
    """Rows in the nearest steps of distance that hold enough rows."""
    step = np.floor(np.log2(d + 1e-6) * o._STEPS_PER_OCTAVE)
    wanted = min(n, max(math.ceil(o.SHARE * n), (n + o.P + 1) // 2))
    return step <= np.sort(step)[wanted - 1]


def distances(x, mean, cov):
    away = np.linalg.solve(np.linalg.cholesky(cov), (x - mean).T)
    return (away * away).sum(axis=0)


def moments(x, raised):
    mean = x.mean(axis=0)
    return mean, o.regular((x - mean).T @ (x - mean) / len(x), len(x), raised)


def fit(x):
    n, found = len(x), []
    width = np.array(o.SPREADS) / o._BINS_PER_SPREAD
    order = np.sort(np.floor(x / width), axis=0)
    q1, q2, q3 = (order[math.ceil(n * s) - 1] for s in (0.25, 0.5, 0.75))
    centre = (q2 + 0.5) * width
    scale = np.maximum(o.FLOORS, (q3 - q1) * width / 1.349)
    z = (x - centre) / scale
    square = (z * z).sum(axis=1)
    unit = z * np.where(square > 0, 1 / np.sqrt(np.where(square > 0, square, 1)), 0)[:, None]
    covs = [np.diag(scale**2)]
    for u in (unit, np.tanh(z)):
        sums = u.T @ u
        spread = np.sqrt(np.diag(sums))
        spread[spread == 0] = 1
        correlation = sums / np.outer(spread, spread)
        np.fill_diagonal(correlation, 1)
        covs.append(np.diag(scale) @ correlation @ np.diag(scale))

    def step(mean, cov):
        near = binned_subset(distances(x, mean, cov), n)
        return moments(x[near], o.consistency(min(1.0, near.mean())))

    for cov in covs:
        at = (centre, o.regular(cov, n, 1.0))
        for _ in range(o.FIRST_STEPS):
            at = step(*at)
        found.append(at)
    at = min(found, key=lambda f: np.linalg.slogdet(f[1])[1])
    for _ in range(o.MOST_STEPS - o.FIRST_STEPS):
        at = step(*at)
    near = distances(x, *at) <= chi2_quantile(o.REWEIGHTED, o.P)
    return moments(x[near], o.consistency(o.REWEIGHTED))


def brute_judge(rows):
    """{doc_id: (base_failed, kept, distance)} of (doc_id, text, lang, source)."""
    groups, out = defaultdict(list), {}
    for doc_id, text, lang, source in rows:
        n, chars, symbols, lines, again, all_lines = brute_counts(text)
        failed = n < 50 or 100 * again > 50 * n
        if failed:
            out[doc_id] = (True, False, None)
        else:
            x = [
                math.log(n),
                chars / n,
                math.sqrt(symbols / n),
                math.sqrt(lines / all_lines),
                math.sqrt(again / n),
            ]
            groups[lang, source].append((doc_id, x))
    for held in groups.values():
        x = np.array([v for _, v in held])
        d = distances(x, *fit(x))
        for (doc_id, _), own in zip(held, d, strict=True):
            out[doc_id] = (False, bool(own <= chi2_quantile(1 - o.REJECTED, o.P)), own)
    return out


SCHEMA = "doc_id long, text string, lang string, source string"


def sample(n, seed):
    rng = random.Random(seed)
    words = [f"w{i}" + "x" * (i % 7) for i in range(900)]
    rows = []
    for i in range(n):
        kind = rng.random()
        text = " ".join(rng.choices(words, k=rng.randint(50, 300)))
        text = text.replace(" w1", "\nw1", rng.randint(0, 6))
        if kind < 0.1:
            text = " ".join(w + "###" for w in text.split())
        elif kind < 0.15:
            text = "same line of words\n" * rng.randint(1, 9) + text
        elif kind < 0.2:
            text = rng.choice([None, "", "few words", "a b c " * 60])
        lang = rng.choice(["en", "en", "de", None])
        rows.append((i, text, lang, "hot" if rng.random() < 0.5 else rng.choice(["s", None])))
    return rows


def test_against_estimates_on_arrays(spark):
    rows = sample(400, 1)
    df = spark.createDataFrame(rows, SCHEMA)
    for name in ("grp", "own", "row", "x0", "n", "d", "mean", "start", "n_words", "kept"):  # clashing names
        df = df.withColumn(name, F.lit("x"))
    expected = brute_judge(rows)
    got = {r.doc_id: r for r in judge_documents(df).collect()}
    assert set(got) == set(expected)
    for doc_id, text, *_ in rows:
        r, (failed, kept, distance) = got[doc_id], expected[doc_id]
        assert tuple(r)[1:6] == brute_counts(text)[:5]
        assert (r.base_failed, r.kept) == (failed, kept)
        assert r.distance == (None if distance is None else pytest.approx(distance, rel=0.05, abs=0.05))
    assert sum(r.kept for r in got.values()) > 300
    assert not any(got[i].kept for i, text, *_ in rows if "###" in (text or ""))


def test_a_third_of_outliers_does_not_move_the_centre(spark):
    rng = np.random.default_rng(0)
    rows = [(0, *map(float, rng.normal([5, 5, 0.1, 0, 0.1], 0.1))) for _ in range(300)]
    rows += [(0, *map(float, rng.normal([9, 12, 2, 1, 0.6], 0.1))) for _ in range(90)]
    schema = T.StructType(
        [T.StructField("grp", T.StringType())] + [T.StructField(f"x{i}", T.DoubleType()) for i in range(5)]
    )
    vectors = spark.createDataFrame([("g", *r[1:]) for r in rows], schema)
    (fitted,) = o.fit_groups(vectors).collect()
    assert np.allclose(fitted.mean, [5, 5, 0.1, 0, 0.1], atol=0.05)


def test_few_and_repeated_rows(spark):
    text = " ".join(f"w{i}" for i in range(60))
    rows = [(1, text, "en", "s"), (1, text, "en", "s"), (None, text, None, None), (2, None, None, None)]
    got = judge_documents(spark.createDataFrame(rows, SCHEMA)).collect()
    assert sorted((str(r.doc_id), r.base_failed, r.kept) for r in got) == [
        ("1", False, True),
        ("1", False, True),
        ("2", True, False),
        ("None", False, True),
    ]


def test_empty(spark):
    none = spark.createDataFrame([], SCHEMA)
    assert judge_documents(none).collect() == []
    failed = spark.createDataFrame([(1, "", "en", "s")], SCHEMA)
    assert [r.kept for r in judge_documents(failed).collect()] == [False]


def test_labelled_documents(spark, sf_dir):
    """Documents of good quality stay, those of bad quality go."""
    folder = "/root/testdata/sf0.01"
    got = judge_documents(spark.read.parquet(f"{folder}/documents.parquet")).toPandas()
    labels = spark.read.parquet(f"{folder}/labels.parquet").toPandas()
    both = got.merge(labels, on="doc_id")
    passed = both[~both.base_failed]
    assert passed[passed.quality == 1].kept.mean() >= 0.99
    assert passed[passed.quality == 0].kept.mean() <= 0.2
