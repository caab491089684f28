"""Cutting lineage, and broadcasting only what has been measured."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from grovelift.operators.bloom import maybe_in

BROADCAST_LIMIT_BYTES = 32 * 1024 * 1024
# Memory of a key in the table of a broadcast, besides its text.
KEY_BYTES = 48
# Memory of one 64-bit hash in the table of a broadcast.
HASH_BYTES = 24
# Keys of one task's hash table, on average over the partitions.
HASHED_LIMIT_BYTES = 64 * 1024 * 1024


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    """Use the folder named in `spark.checkpoint.dir`, else one in the warehouse.

    Both are shared by the driver and all executors.
    """
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        own = spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_checkpoints"
        context.setCheckpointDir(spark.conf.get("spark.checkpoint.dir", own))


_own_folder: ContextVar[str | None] = ContextVar("own_folder", default=None)


@contextmanager
def own_folder(spark: SparkSession) -> Iterator[None]:
    """Within it, what is checkpointed goes to a folder that is removed at the end."""
    ensure_checkpoint_dir(spark)
    folder = f"{spark.sparkContext.getCheckpointDir()}/work-{uuid.uuid4().hex}"
    before = _own_folder.set(folder)
    try:
        yield
    finally:
        _own_folder.reset(before)
        path = spark._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def checkpointed(df: DataFrame) -> DataFrame:
    """Write the rows once to the shared folder and read them from there.

    Needed where a second evaluation could give other rows or another order:
    range bounds are sampled, and a lost executor makes Spark evaluate again.
    """
    folder = _own_folder.get()
    if folder is None:
        ensure_checkpoint_dir(df.sparkSession)
        return df.checkpoint()
    place = f"{folder}/{uuid.uuid4().hex}"
    df.write.parquet(place)
    return df.sparkSession.read.schema(df.schema).parquet(place)


def checkpointed_with_size(df: DataFrame, column: str) -> tuple[DataFrame, Size]:
    """A checkpointed narrow frame and its size, taken while the rows are written."""
    size = Observation()
    seen = df.observe(
        size, F.count(F.lit(1)).alias("n"), F.sum(F.octet_length(column)).alias("length")
    )
    kept = checkpointed(seen)
    rows = int(size.get["n"])
    return kept, Size(rows, int(size.get["length"] or 0) + KEY_BYTES * rows)


def broadcast_if_small(df: DataFrame, size: Size, limit: int = BROADCAST_LIMIT_BYTES) -> DataFrame:
    """Hint a broadcast when the measured size allows it, else leave the join to shuffle."""
    return F.broadcast(df) if size.bytes <= limit else df


@dataclass(frozen=True)
class Size:
    """Measured rows and bytes of a narrow frame."""

    rows: int
    bytes: int


def measured(df: DataFrame, column: str | Column) -> Size:
    """Rows of a narrow frame, and its bytes by the lengths of its one long column."""
    row = df.agg(F.count(F.lit(1)), F.sum(F.octet_length(column))).first()
    return Size(row[0], int(row[1] or 0) + KEY_BYTES * row[0])


def join_by_keys(wide: DataFrame, keys: DataFrame, column: str, size: Size | None) -> DataFrame:
    """Rows of a wide frame joined with keys, without a shuffle of unwanted wide rows.

    Few keys are broadcast. Of more keys 64-bit hashes are broadcast first, so
    that only wanted rows, but for rare collisions, reach the shuffle of the
    exact join; of still more, a Bloom filter, which lets about one in a hundred
    unwanted rows pass. Keys too many for that, or of unknown size, are joined as
    Spark chooses; its runtime filters still apply.
    """
    if size is None:
        return wide.join(keys, column)
    if size.bytes <= BROADCAST_LIMIT_BYTES:
        return wide.join(F.broadcast(keys), column)
    if size.rows * HASH_BYTES <= BROADCAST_LIMIT_BYTES:
        hashes = keys.select(F.xxhash64(column).alias("_hash")).distinct()
        same = F.xxhash64(wide[column]) == F.col("_hash")
        wide = wide.join(F.broadcast(hashes), same, "left_semi")
    else:
        wide = maybe_in(wide, keys, column, size.rows)
    partitions = int(keys.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    fits = size.bytes <= HASHED_LIMIT_BYTES * partitions
    return wide.join(keys.hint("shuffle_hash") if fits else keys, column)
