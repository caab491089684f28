"""Helpers that the operators of this package share."""

from __future__ import annotations

import gc
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    """Use the folder named in `spark.checkpoint.dir`, else one in the warehouse."""
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        own = spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_checkpoints"
        context.setCheckpointDir(spark.conf.get("spark.checkpoint.dir", own))


def checkpointed(df: DataFrame) -> DataFrame:
    """Write the rows once to the shared folder; later reads survive lost executors."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint()


def free_finished(spark: SparkSession) -> None:
    """Let Spark remove the shuffle files of steps that nothing refers to any more.

    It does so when the driver collects its garbage, which a driver with little
    to do may not for hours, while many rounds leave their files on the executors.
    """
    gc.collect()
    spark._jvm.System.gc()


def with_text(rows: DataFrame, kept: list[str]) -> DataFrame:
    """`row`, a struct of the kept columns, and `text`: no kept name can clash with others.

    A text that is kept is there once, in the struct (see `texts_of`).
    """
    row = F.struct(*[F.col(f"`{c}`") for c in kept]).alias("row")
    return rows.select(row) if "text" in kept else rows.select(row, "text")


def released(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The same batches; at their end the worker, which goes on, gives unused memory back."""
    yield from batches
    pa.default_memory_pool().release_unused()


def texts_of(batch: pa.RecordBatch) -> pa.Array:
    """The texts of a batch of rows made by `with_text`."""
    if "text" in batch.schema.names:
        return batch.column("text")
    return batch.column("row").field("text")


def with_columns(rows: DataFrame, **types: T.DataType) -> T.StructType:
    """The schema of `row` followed by columns of these types."""
    return T.StructType([rows.schema["row"], *(T.StructField(c, t) for c, t in types.items())])


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def spelled(*values: Column) -> Column:
    """One text that tells rows of values apart: `-` for null, else length in bytes, `:`, value."""

    def part(value: Column) -> Column:
        text = value.cast("string")
        return F.coalesce(F.concat(F.octet_length(text), F.lit(":"), text), F.lit("-"))

    return F.concat(*map(part, values))


def fold(id_column: str | Column, folds: int) -> Column:
    """crc32 of the id as text, modulo the number of folds; null ids are in fold 0."""
    value = F.col(id_column) if isinstance(id_column, str) else id_column
    text = F.coalesce(value.cast("string"), F.lit(""))
    return F.crc32(text.cast("binary")) % folds


def usable_vector(column: str | Column) -> Column:
    """True for vectors that are not null and hold only finite components."""
    value = F.col(column) if isinstance(column, str) else column
    finite = F.forall(
        value,
        lambda x: x.isNotNull()
        & ~F.isnan(x.cast("double"))
        & (F.abs(x.cast("double")) < F.lit(float("inf"))),
    )
    return F.coalesce(value.isNotNull() & finite, F.lit(False))
