"""A quality classifier by compression.

Two zstandard dictionaries are built, from texts labelled good and bad. A text
is compressed with each, piece by piece, so that a long text gains from a
dictionary as a short one does. The difference of the sizes, divided by their
sum, is calibrated to a chance by an isotonic fit on labelled texts that neither
dictionary has seen.

Dictionaries and calibration are learnt from a bounded sample of labelled rows.
The calibration weighs a sampled row by the labelled rows of its class that it
stands for, so a score means the same at any size. Scoring is one pass over the
texts.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from grovelift.llm.common import checkpointed, fold

HELD_OUT_FOLD, FOLDS = 1, 3
# Labelled rows per class that are learnt from, and the longest text in a dictionary.
SAMPLE_PER_CLASS = 3_000
SAMPLE_BYTES = 20_000
DICTIONARY_BYTES = 64 * 1024
PIECE_BYTES = 500
LEVEL = 3
CALIBRATION_SHARE = 3  # every third row of the sample calibrates


def pieces_of(text: str | None) -> list[bytes]:
    """The whole text as UTF-8 in pieces; an empty text is one empty piece."""
    raw = (text or "").encode("utf-8", "replace")
    return [raw[i : i + PIECE_BYTES] for i in range(0, max(1, len(raw)), PIECE_BYTES)]


def _dictionary(texts: list[str]) -> bytes:
    """A dictionary of the texts; plain content if they are too few to train on."""
    samples = [p for t in texts for p in pieces_of(t) if p]
    try:
        return zstandard.train_dictionary(DICTIONARY_BYTES, samples).as_bytes()
    except zstandard.ZstdError:
        return b"".join(samples)[-DICTIONARY_BYTES:]


class Compressors:
    """Compressed sizes of a text under the good and the bad dictionary."""

    def __init__(self, good: bytes, bad: bytes):
        self.both = []
        for content in (good, bad):
            held = None
            if content:
                held = zstandard.ZstdCompressionDict(content)
                held.precompute_compress(level=LEVEL)
            options = {"write_content_size": False, "write_dict_id": False}
            self.both.append(zstandard.ZstdCompressor(level=LEVEL, dict_data=held, **options))

    def difference(self, text: str | None) -> float:
        """From -1 to 1: above 0 if the good dictionary helps more."""
        pieces = pieces_of(text)
        good, bad = (sum(len(c.compress(p)) for p in pieces) for c in self.both)
        return (bad - good) / (bad + good)


def isotonic(
    x: np.ndarray, y: np.ndarray, weights: tuple[float, float] = (1.0, 1.0)
) -> tuple[np.ndarray, np.ndarray]:
    """The non-decreasing fit of y to x, as points to interpolate between.

    A row counts by the weight of its class. Rows of equal x are one pool, and
    neighbours that would fall are pooled. The mean of a pool stands at its middle, with half a row of either
    class added, so that no chance is 0 or 1.
    """
    values, at = np.unique(x, return_inverse=True)
    w = np.where(y > 0, weights[1], weights[0])
    ones, total = (np.bincount(at, v, len(values)) for v in (w * y, w))
    pools: list[list[float]] = []  # [weighted sum of y, weight, weighted sum of x]
    for xi, yi, wi in zip(values, ones, total, strict=True):
        pools.append([yi, wi, wi * xi])
        while len(pools) > 1 and pools[-2][0] * pools[-1][1] >= pools[-1][0] * pools[-2][1]:
            last = pools.pop()
            pools[-1] = [a + b for a, b in zip(pools[-1], last, strict=True)]
    points = np.array([p[2] / p[1] for p in pools])
    values = np.array([(p[0] + 0.5 * weights[1]) / (p[1] + 0.5 * sum(weights)) for p in pools])
    return points, np.maximum.accumulate(values)


def _labelled_sample(
    documents: DataFrame, labels: DataFrame, label: str, per_class: int
) -> tuple[DataFrame, tuple[float, float]]:
    """Up to so many learning rows per class by a hash of the id, and the weights of the classes.

    The rows have doc_id, text, y, place and part; the weight of a class is the
    number of its labelled learning rows over those taken.
    """
    known = labels.where(F.col(label).isin(0, 1)).groupBy("doc_id").agg(F.max(label).alias("y"))
    known = known.where(fold("doc_id", FOLDS) != HELD_OUT_FOLD)
    known = known.withColumn("place", F.xxhash64("doc_id"))
    sizes = {r["y"]: r["n"] for r in known.groupBy("y").agg(F.count(F.lit(1)).alias("n")).collect()}
    ids = [known.where(F.col("y") == y).orderBy("place", "doc_id").limit(per_class) for y in (0, 1)]
    # The ids of the sample are at most 2 * per_class, so few texts are shuffled.
    wanted = F.broadcast(ids[0].unionByName(ids[1]))
    rows = documents.select("doc_id", "text").join(wanted, "doc_id").dropDuplicates(["doc_id"])
    rows = checkpointed(rows)
    # At most per_class ids a class.
    order = Window.partitionBy("y").orderBy("place", "doc_id")
    part = (F.row_number().over(order) - 1) % CALIBRATION_SHARE
    parts = rows.select("doc_id", "y", "place").select("doc_id", "place", part.alias("part"))
    found = rows.select("doc_id", "text", "y").join(F.broadcast(parts), "doc_id")
    return found, tuple(max(1.0, sizes.get(y, 0) / per_class) for y in (0, 1))


def _difference_batches(good: bytes, bad: bytes):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sizes = Compressors(good, bad)
        for batch in batches:
            x = pa.array([sizes.difference(t.as_py()) for t in batch.column("text")], pa.float64())
            columns = [batch.column("y"), batch.column("place"), batch.column("doc_id"), x]
            yield pa.RecordBatch.from_arrays(columns, ["y", "place", "doc_id", "x"])

    return run


def fit_quality(documents: DataFrame, labels: DataFrame, per_class: int = SAMPLE_PER_CLASS) -> tuple:
    """(good dictionary, bad dictionary, points, chances), learnt on the learning folds.

    Each class gives at most `per_class` texts, of which those of at most
    `SAMPLE_BYTES` bytes make the dictionaries and those of any length calibrate.
    The classes are weighed alike in the sample, then by their true shares among
    all labelled learning rows.
    """
    sample, weights = _labelled_sample(documents, labels, "quality", per_class)
    kept = sample.where((F.col("part") > 0) & (F.octet_length("text") <= SAMPLE_BYTES))
    kept = kept.orderBy("place", "doc_id").select("text", "y").collect()
    good, bad = (_dictionary([r["text"] for r in kept if r["y"] == v]) for v in (1, 0))
    # Only numbers of the calibrating rows reach the driver.
    held = sample.where("part = 0").select(
        F.col("y").cast("int").alias("y"), "place", F.col("doc_id").cast("long").alias("doc_id"), "text"
    )
    held = held.mapInArrow(_difference_batches(good, bad), "y int, place long, doc_id long, x double")
    held = sorted(tuple(r) for r in held.collect())
    x, y = np.array([r[3] for r in held]), np.array([float(r[0]) for r in held])
    if len(np.unique(y)) < 2:  # one class only, or none: nothing to tell apart
        return good, bad, np.zeros(1), np.array([y.mean() if len(y) else 0.5])
    points, chances = isotonic(x, y, weights)
    return good, bad, points, chances


def _score_batches(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        good, bad, points, chances = shared.value
        sizes = Compressors(good, bad)
        for batch in batches:
            x = np.array([sizes.difference(t.as_py()) for t in batch.column("text")])
            # Between equal chances a slight slope keeps the order of the differences.
            y = 0.99 * np.interp(x, points, chances) + 0.005 * (1 + np.clip(x, -1, 1))
            columns = [batch.column("doc_id"), pa.array(y, pa.float64())]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "score"])

    return run


def score_quality(documents: DataFrame, model: tuple) -> DataFrame:
    """doc_id and the chance, by its whole text alone, that a document is good."""
    shared = documents.sparkSession.sparkContext.broadcast(model)
    rows = documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return rows.mapInArrow(_score_batches(shared), "doc_id long, score double")


def classify_quality(documents: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score and predicted of every row.

    Learns from labelled documents of two of three folds of the ids. A null
    text scores as an empty one. Labels that are null or neither 0 nor 1 are
    left out, and of several labels of a document the highest counts. With
    labels of one class only, or none, every text has about the same score.
    Repeated rows have equal scores; rows without doc_id are scored too.
    """
    scored = score_quality(documents, fit_quality(documents, labels))
    return scored.select(
        "doc_id",
        (fold("doc_id", FOLDS) == HELD_OUT_FOLD).alias("held_out"),
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
    )
