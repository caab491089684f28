"""Quality rules: robust multivariate outliers among statistics of whole texts.

Each document that passes the base rules has a vector of five transformed
statistics. Per language and source, the minimum covariance determinant gives a
centre and a covariance that outliers do not pull at: those of the part of the
rows, three quarters, whose covariance has the least determinant. Documents far
from the centre of their group, by Mahalanobis distance, are rejected.

The estimate is found by concentration steps from three robust starts that
need no random subsets (median and quartiles, alone, with the correlations of
spatial signs, and with those of hyperbolic tangents). A step orders the rows of
a group by their distance and takes the moments of the nearest. It is one
grouped sum over all rows: moments are added up per step of distance, of about
four percent, and the nearest steps that hold enough rows are taken together. So
a group of any size costs no task more than its share, nothing is sampled, and
the driver sees one number a round.

Covariances get a fixed floor, so that a statistic that hardly varies in a group
does not turn small changes into outliers, and are drawn towards fixed spreads
with the weight of a few rows, which matters in small groups only.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import reduce
from operator import add

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from grovelift.llm.common import checkpointed, spelled, texts_of, with_columns, with_text
from grovelift.operators.sizing import BROADCAST_LIMIT_BYTES

LEAST_WORDS = 50
MOST_REPEATED_PERCENT = 50
SYMBOLS = b"#*$%&|<>"
SEPARATORS = b" \t\n\x0b\x0c\r"
# Spread that a statistic has by itself, and the spread that counts as usual.
FLOORS = (0.1, 0.1, 0.05, 0.1, 0.1)
SPREADS = (1.0, 0.5, 0.1, 0.2, 0.2)
P = len(FLOORS)
# Rows whose weight the usual spreads have beside those of a group.
PRIOR_ROWS = 20
SHARE = 0.75
# A regular document would be rejected with this chance if its vector were normal;
# statistics of texts have heavier tails, so it is set low.
REJECTED = 1e-8
REWEIGHTED = 0.975
STARTS = 3
# Steps from all starts, then most steps from the best one; it ends when no
# determinant falls by more than one part in this many.
FIRST_STEPS = 2
MOST_STEPS = 10
_SETTLED = 1e-4
_STEPS_PER_OCTAVE = 16
_BINS_PER_SPREAD = 64
_COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines")
_LOWER = [(i, j) for i in range(P) for j in range(i + 1)]


# -- statistics of a text


def repeated_words(words: list[bytes]) -> int:
    """Words that lie in a window of three found twice or more, first occurrences included."""
    if len(words) < 4:
        return 0
    numbers: dict[bytes, int] = {}
    codes = np.array([numbers.setdefault(w, len(numbers)) for w in words], np.int64)
    k = len(numbers)
    pairs = np.unique(codes[:-1] * k + codes[1:], return_inverse=True)[1]
    _, which, held = np.unique(pairs[:-1] * k + codes[2:], return_inverse=True, return_counts=True)
    again = held[which] > 1
    covered = np.zeros(len(words), bool)
    for shift in range(3):
        covered[shift : shift + len(again)] |= again
    return int(covered.sum())


def text_counts(text: str | None) -> tuple[int, ...]:
    """The numbers named in `_COUNTS`; words are what lies between ASCII white space."""
    data = (text or "").encode()
    words = data.split()
    lines = [line for line in data.split(b"\n") if line.split()]
    separators = len(data) - len(data.translate(None, SEPARATORS))
    return (
        len(words),
        len(text or "") - separators,
        len(data) - len(data.translate(None, SYMBOLS)),
        len(lines) - len(set(lines)),
        repeated_words(words),
        len(lines),
    )


def _count_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        found = [text_counts(t.as_py()) for t in texts_of(batch)]
        columns = [pa.array([f[i] for f in found], pa.int64()) for i in range(len(_COUNTS))]
        yield pa.RecordBatch.from_arrays([batch.column("row"), *columns], ["row", *_COUNTS])


def text_statistics(documents: DataFrame, kept: list[str]) -> DataFrame:
    """`row` (a struct of the kept columns) and the counts of each whole text."""
    rows = with_text(documents, kept)
    schema = with_columns(rows, **dict.fromkeys(_COUNTS, T.LongType()))
    return rows.mapInArrow(_count_batches, schema)


def base_failed() -> Column:
    few = F.col("n_words") < LEAST_WORDS
    return few | (100 * F.col("n_repeat_words") > MOST_REPEATED_PERCENT * F.col("n_words"))


def transformed() -> list[Column]:
    """The vector of a document: length, length of words, and roots of three rates."""
    words = F.col("n_words")
    return [
        F.log(words),
        F.col("word_chars") / words,
        F.sqrt(F.col("n_symbols") / words),
        F.sqrt(F.col("n_dup_lines") / F.col("n_lines")),
        F.sqrt(F.col("n_repeat_words") / words),
    ]


# -- the chi-squared distribution


def chi2_cdf(x: float, k: int) -> float:
    """Chance that the squared length of k standard normal values is at most x."""
    a, half = k / 2, x / 2
    if half <= 0:
        return 0.0
    term = total = 1 / a
    n = a
    while term > total * 1e-16:
        n += 1
        term *= half / n
        total += term
    return min(1.0, total * math.exp(-half + a * math.log(half) - math.lgamma(a)))


def chi2_quantile(chance: float, k: int) -> float:
    low, high = 0.0, 1.0
    while chi2_cdf(high, k) < chance:
        high *= 2
    for _ in range(100):
        middle = (low + high) / 2
        low, high = (middle, high) if chi2_cdf(middle, k) < chance else (low, middle)
    return high


def consistency(share: float) -> float:
    """What the covariance of the nearest part of normal rows must be raised by."""
    return share / chi2_cdf(chi2_quantile(share, P), P + 2) if share < 1 else 1.0


# -- estimates of groups, as rows


def subset_size(n: int) -> int:
    """Rows of a group that the estimate rests on."""
    return min(n, max(math.ceil(SHARE * n), (n + P + 1) // 2))


def regular(cov: np.ndarray, rows: int, raised: float) -> np.ndarray:
    """A covariance drawn towards the usual spreads, with the floor added."""
    prior = np.diag(np.square(SPREADS))
    drawn = (rows * raised * cov + PRIOR_ROWS * prior) / (rows + PRIOR_ROWS)
    return drawn + np.diag(np.square(FLOORS))


def _packed(cov: np.ndarray) -> tuple[list[float], float]:
    """The inverse of the lower root, row by row, and the logarithm of the determinant."""
    root = np.linalg.cholesky(cov)
    inverse = np.linalg.inv(root)
    return [float(inverse[i, j]) for i, j in _LOWER], float(2 * np.log(np.diag(root)).sum())


_FITTED = "grp string, start int, n long, mean array<double>, inverse array<double>, det double"
_FITTED_ARROW = pa.schema(
    [
        ("grp", pa.string()),
        ("start", pa.int32()),
        ("n", pa.int64()),
        ("mean", pa.list_(pa.float64())),
        ("inverse", pa.list_(pa.float64())),
        ("det", pa.float64()),
    ]
)


def _fitted_batch(rows: list[tuple]) -> pa.RecordBatch:
    columns = zip(*rows, strict=True) if rows else [[]] * len(_FITTED_ARROW)
    arrays = [pa.array(c, f.type) for c, f in zip(columns, _FITTED_ARROW, strict=True)]
    return pa.RecordBatch.from_arrays(arrays, schema=_FITTED_ARROW)


def _symmetric(packed: list[float]) -> np.ndarray:
    out = np.zeros((P, P))
    for (i, j), value in zip(_LOWER, packed, strict=True):
        out[i, j] = out[j, i] = value
    return out


def first_estimates(centre, scale, signs, tanhs):
    """Mean and covariance of the three starts, from sums of products of the two transforms."""
    scales = np.diag(scale)
    yield np.array(centre), np.diag(np.square(scale))
    for sums in (signs, tanhs):
        sums = _symmetric(sums)
        spread = np.sqrt(np.diag(sums))
        spread[spread == 0] = 1
        correlation = sums / np.outer(spread, spread)
        np.fill_diagonal(correlation, 1)
        yield np.array(centre), scales @ correlation @ scales


def _start_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = []
        for r in batch.to_pylist():
            starts = first_estimates(r["centre"], r["scale"], r["signs"], r["tanhs"])
            for start, (mean, cov) in enumerate(starts):
                inverse, det = _packed(regular(cov, r["n"], 1.0))
                rows.append((r["grp"], start, r["n"], mean.tolist(), inverse, det))
        yield _fitted_batch(rows)


def estimate(mean, rows: int, sums, products, raised: float) -> tuple[np.ndarray, np.ndarray]:
    """Mean and covariance from sums of differences to `mean` and of their products."""
    shift = np.array(sums) / rows
    cov = _symmetric(products) / rows - np.outer(shift, shift)
    return np.array(mean) + shift, regular(cov, rows, raised)


def _estimate_batches(reweighted: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for r in batch.to_pylist():
                share = REWEIGHTED if reweighted else min(1.0, r["taken"] / r["n"])
                found = estimate(r["mean"], r["taken"], r["sums"], r["products"], consistency(share))
                inverse, det = _packed(found[1])
                rows.append((r["grp"], r["start"], r["n"], found[0].tolist(), inverse, det))
            yield _fitted_batch(rows)

    return run


# -- passes over all rows


def _x(i: int) -> Column:
    return F.col(f"x{i}")


def _total(columns) -> Column:
    return reduce(add, columns)


def _measured_rows(vectors: DataFrame, fitted: DataFrame) -> DataFrame:
    """Vectors with each estimate of their group, and the squared distance `d`."""
    # Some hundred bytes per group and start: broadcast if that is little. Else
    # Spark joins by group, and splits a hot one.
    if fitted.count() * 1024 <= BROADCAST_LIMIT_BYTES:
        fitted = F.broadcast(fitted)
    away = [_x(i) - F.col("mean")[i] for i in range(P)]
    at = {place: F.col("inverse")[k] for k, place in enumerate(_LOWER)}
    turned = [_total(at[i, j] * away[j] for j in range(i + 1)) for i in range(P)]
    return vectors.join(fitted, "grp").withColumn("d", _total(t * t for t in turned))


def _moments() -> list[Column]:
    away = [_x(i) - F.col("mean")[i] for i in range(P)]
    return [
        F.count(F.lit(1)).alias("taken"),
        *[F.sum(away[i]).alias(f"s{i}") for i in range(P)],
        *[F.sum(away[i] * away[j]).alias(f"p{i}{j}") for i, j in _LOWER],
        F.first("mean").alias("mean"),
        F.first("n").alias("n"),
    ]


def _gathered(sums: DataFrame) -> DataFrame:
    return sums.select(
        "grp",
        "start",
        "n",
        "mean",
        "taken",
        F.array(*[f"s{i}" for i in range(P)]).alias("sums"),
        F.array(*[f"p{i}{j}" for i, j in _LOWER]).alias("products"),
    )


def _concentrated(vectors: DataFrame, fitted: DataFrame) -> DataFrame:
    """One concentration step: the estimate from the nearest rows of each group."""
    rows = _measured_rows(vectors, fitted)
    step = F.floor(F.log2(F.col("d") + 1e-6) * _STEPS_PER_OCTAVE).alias("step")
    sums = rows.groupBy("grp", "start", step).agg(*_moments())
    nearer = Window.partitionBy("grp", "start").orderBy("step")
    nearer = nearer.rowsBetween(Window.unboundedPreceding, -1)
    before = F.coalesce(F.sum("taken").over(nearer), F.lit(0))
    wanted = F.least(
        F.col("n"), F.greatest(F.ceil(F.lit(SHARE) * F.col("n")), F.floor((F.col("n") + P + 1) / 2))
    )
    near = sums.withColumn("before", before).where(F.col("before") < wanted)
    names = ["taken", *[f"s{i}" for i in range(P)], *[f"p{i}{j}" for i, j in _LOWER]]
    near = near.groupBy("grp", "start").agg(
        *[F.sum(c).alias(c) for c in names], F.first("mean").alias("mean"), F.first("n").alias("n")
    )
    return checkpointed(_gathered(near).mapInArrow(_estimate_batches(False), _FITTED))


def _reweighted(vectors: DataFrame, fitted: DataFrame) -> DataFrame:
    """The estimate from all rows that are not far from the one given."""
    near = _measured_rows(vectors, fitted).where(F.col("d") <= chi2_quantile(REWEIGHTED, P))
    sums = near.groupBy("grp", "start").agg(*_moments())
    found = _gathered(sums).mapInArrow(_estimate_batches(True), _FITTED)
    return checkpointed(found)


def _centres(vectors: DataFrame) -> DataFrame:
    """(grp, n, centre, scale): median and spread between the quartiles of each statistic."""
    bins = [
        F.struct(F.lit(i).alias("i"), F.floor(_x(i) * (_BINS_PER_SPREAD / SPREADS[i])).alias("bin"))
        for i in range(P)
    ]
    held = vectors.select("grp", F.explode(F.array(*bins)).alias("at")).select("grp", "at.*")
    held = held.groupBy("grp", "i", "bin").agg(F.count(F.lit(1)).alias("rows"))
    own = Window.partitionBy("grp", "i")
    held = held.withColumn("n", F.sum("rows").over(own)).withColumn(
        "up", F.sum("rows").over(own.orderBy("bin"))
    )

    def quantile(share: float) -> Column:
        return F.min(F.when(F.col("up") >= F.lit(share) * F.col("n"), F.col("bin")))

    width = F.element_at(F.array(*[F.lit(s / _BINS_PER_SPREAD) for s in SPREADS]), F.col("i") + 1)
    floor = F.element_at(F.array(*map(F.lit, FLOORS)), F.col("i") + 1)
    found = held.groupBy("grp", "i").agg(
        F.max("n").alias("n"), *[quantile(q / 4).alias(f"q{q}") for q in (1, 2, 3)]
    )
    found = found.select(
        "grp",
        "i",
        "n",
        ((F.col("q2") + 0.5) * width).alias("centre"),
        F.greatest(floor, (F.col("q3") - F.col("q1")) * width / 1.349).alias("scale"),
    )

    def listed(name: str) -> Column:  # one entry per statistic
        entries = F.array_sort(F.collect_list(F.struct("i", name)))
        return F.transform(entries, lambda x: x[name]).alias(name)

    return found.groupBy("grp").agg(F.max("n").alias("n"), listed("centre"), listed("scale"))


def _starts(vectors: DataFrame) -> DataFrame:
    centres = checkpointed(_centres(vectors))
    if centres.count() * 1024 <= BROADCAST_LIMIT_BYTES:
        centres = F.broadcast(centres)
    scaled = [(_x(i) - F.col("centre")[i]) / F.col("scale")[i] for i in range(P)]
    square = _total(z * z for z in scaled)
    rows = vectors.join(centres, "grp").withColumn("square", square)
    # Rows at the centre have no direction.
    unit = F.when(F.col("square") > 0, 1 / F.col("square")).otherwise(0.0)
    products = [F.sum(scaled[i] * scaled[j] * unit).alias(f"u{i}{j}") for i, j in _LOWER]
    products += [F.sum(F.tanh(scaled[i]) * F.tanh(scaled[j])).alias(f"t{i}{j}") for i, j in _LOWER]
    same = [F.first(c).alias(c) for c in ("n", "centre", "scale")]
    sums = rows.groupBy("grp").agg(*products, *same).select(
        "grp",
        "n",
        "centre",
        "scale",
        F.array(*[f"u{i}{j}" for i, j in _LOWER]).alias("signs"),
        F.array(*[f"t{i}{j}" for i, j in _LOWER]).alias("tanhs"),
    )
    return checkpointed(sums.mapInArrow(_start_batches, _FITTED))


def fit_groups(vectors: DataFrame) -> DataFrame:
    """The robust estimate of each group `grp` of vectors x0, x1, ...: one row per group."""
    fitted = _starts(vectors)
    for _ in range(FIRST_STEPS):
        fitted = _concentrated(vectors, fitted)
    best = Window.partitionBy("grp").orderBy("det", "start")
    fitted = fitted.withColumn("place", F.row_number().over(best)).where("place = 1").drop("place")
    fitted = checkpointed(fitted)
    for _ in range(MOST_STEPS - FIRST_STEPS):
        nearer = _concentrated(vectors, fitted)
        old = fitted.select("grp", F.col("det").alias("old"))
        fall = nearer.join(old, "grp").agg(F.max(F.col("old") - F.col("det"))).first()[0]
        fitted = nearer
        if fall is None or fall <= _SETTLED:
            break
    return _reweighted(vectors, fitted)


def quality_rules(documents: DataFrame, kept: list[str]) -> DataFrame:
    """`row` (a struct of the kept columns), the counts, base_failed, distance and kept.

    `distance` is the squared Mahalanobis distance to the robust centre of the
    document's language and source, null where the base rules reject it; `kept`
    is false for those, and for distances beyond the quantile of the chi-squared
    distribution that regular documents exceed with a chance of `REJECTED`.

    A null lang or source is a value like others. A null or empty text has no
    words and fails the base rules; very long texts are taken whole. Repeated
    rows have equal results and count as often as they occur. A group of one
    document is its own centre and is kept. Other columns, whatever their names,
    are ignored. Without documents, or none that passes, nothing is fitted.
    """
    grp, names = "grp", [*kept, "lang", "source"]
    given = documents.select(
        F.struct(*[F.col(f"`{c}`") for c in kept]).alias("own"),
        spelled(F.col("lang"), F.col("source")).alias(grp),
        "text",
    )
    rows = text_statistics(given, ["own", grp])
    rows = rows.select("row.own", F.col(f"row.{grp}").alias(grp), *_COUNTS)
    rows = checkpointed(rows.withColumn("base_failed", base_failed()))
    passed = rows.where(~F.col("base_failed"))
    x = [c.alias(f"x{i}") for i, c in enumerate(transformed())]
    vectors = checkpointed(passed.select(grp, *x))
    counts = [F.col("own").alias("row"), *_COUNTS, "base_failed"]
    fitted = fit_groups(vectors)
    judged = _measured_rows(passed.select(*rows.columns, *x), fitted)
    cutoff = chi2_quantile(1 - REJECTED, P)
    judged = judged.select(*counts, F.col("d").alias("distance"), (F.col("d") <= cutoff).alias("kept"))
    failed = rows.where("base_failed").select(
        *counts, F.lit(None).cast("double").alias("distance"), F.lit(False).alias("kept")
    )
    return judged.unionByName(failed)


def judge_documents(documents: DataFrame) -> DataFrame:
    """doc_id, the counts of each whole text, base_failed, kept and distance."""
    judged = quality_rules(documents, ["doc_id"])
    return judged.select("row.doc_id", *_COUNTS[:-1], "base_failed", "kept", "distance")
