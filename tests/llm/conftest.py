from __future__ import annotations

import zlib

import pandas as pd
import pytest
from pyspark.sql import types as T

DOCUMENTS = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("text", T.StringType()),
        T.StructField("lang", T.StringType()),
        T.StructField("source", T.StringType()),
        T.StructField("n_chars", T.LongType()),
    ]
)


@pytest.fixture(scope="session")
def table(spark, sf_dir):
    """A sample table by name."""
    return lambda name: spark.read.parquet(f"{sf_dir}/{name}.parquet")


@pytest.fixture(scope="session")
def documents(spark):
    """A frame of documents from (doc_id, text) or (doc_id, text, lang) tuples."""

    def make(rows):
        rows = [(r[0], r[1], r[2] if len(r) > 2 else None, "s", len(r[1] or "")) for r in rows]
        return spark.createDataFrame(rows, DOCUMENTS)

    return make


def fold_of(doc_id: int, folds: int) -> int:
    return zlib.crc32(str(doc_id).encode()) % folds


def auc(label: pd.Series, score: pd.Series) -> float:
    rank = score.rank()
    ones = label.sum()
    return (rank[label == 1].sum() - ones * (ones + 1) / 2) / (ones * (len(label) - ones))
