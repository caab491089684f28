"""Batches of rows in id order, and the log of those batches."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from grovelift.operators.sizing import checkpointed
from grovelift.schemas import COMPLETED, ID, IN_PROGRESS, MISSING_PARENTS

# monotonically_increasing_id keeps the row's place within its partition in the
# low 33 bits and the partition number above them.
_SLOT_BITS = 33


def first_batch(df: DataFrame, size: int, key: str = ID) -> DataFrame:
    """The first `size` rows by key: a distributed top-k, not a full sort."""
    return df.orderBy(key).limit(size)


def number_rows(
    df: DataFrame, key: str = ID, within: str | None = None, name: str = "position"
) -> DataFrame:
    """Number the rows 1, 2, ... by key, separately for each value of `within`.

    A window without partitions would move every row into one task. Here the
    rows are range-partitioned and sorted, take their place within their own
    partition, and add the number of rows in earlier partitions. Only those
    counts, one row per partition and group, pass through a window and are
    broadcast. Range bounds are sampled, so the sorted rows are written before
    anything is counted. `within` must have few values.
    """
    order = [c for c in (within, key) if c]
    groups = [within] if within else []
    slot = F.monotonically_increasing_id()
    ranged = checkpointed(
        df.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("_slot", slot)
    )
    part = F.shiftright("_slot", _SLOT_BITS)
    place = F.col("_slot").bitwiseAND(F.lit((1 << _SLOT_BITS) - 1))
    ranged = ranged.withColumn("_part", part).withColumn("_place", place)

    starts = ranged.groupBy("_part", *groups).agg(
        F.min("_place").alias("_first"), F.count(F.lit(1)).alias("_rows")
    )
    earlier = (
        Window.partitionBy(*groups)
        .orderBy("_part")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    starts = starts.select(
        "_part",
        *groups,
        (F.coalesce(F.sum("_rows").over(earlier), F.lit(0)) - F.col("_first")).alias("_shift"),
    )
    starts = checkpointed(starts)
    return ranged.join(F.broadcast(starts), ["_part", *groups]).select(
        *df.columns, (F.col("_place") + F.col("_shift") + 1).alias(name)
    )


def running_total(df: DataFrame, order: str, value: str, name: str) -> DataFrame:
    """Add the sum of `value` over this row and all before it, by `order`.

    As in `number_rows`, ranges of rows are summed on their own and raised by
    the sums of the ranges before them, so that no task sees all rows.
    """
    part = F.spark_partition_id().alias("_part")
    ranged = checkpointed(df.repartitionByRange(order).select("*", part))
    earlier = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = ranged.groupBy("_part").agg(F.sum(value).alias("_sum"))
    starts = starts.select(
        "_part", F.coalesce(F.sum("_sum").over(earlier), F.lit(0)).alias("_start")
    )
    within = Window.partitionBy("_part").orderBy(order).rowsBetween(
        Window.unboundedPreceding, Window.currentRow
    )
    return ranged.join(F.broadcast(starts), "_part").select(
        *df.columns, (F.col("_start") + F.sum(value).over(within)).alias(name)
    )


def batch_of(position: Column, size: int) -> Column:
    """Number of the batch that holds a position, counting from 1."""
    return F.floor((position - 1) / F.lit(size)).cast("int") + 1


def assign_batches(
    df: DataFrame, size: int, key: str = ID, within: str | None = None
) -> DataFrame:
    """Give each row the batch in which "take the next `size` rows" would reach it."""
    numbered = number_rows(df, key, within)
    return numbered.withColumn("batch_number", batch_of(F.col("position"), size)).drop("position")


def _log_row(step, batch, inserted, total, status, taken) -> list[Column]:
    return [
        F.lit(step).cast("short").alias("step"),
        batch.cast("int").alias("batch_number"),
        inserted.cast("long").alias("rows_inserted"),
        total.cast("long").alias("total_rows_inserted"),
        F.lit(status).alias("status"),
        taken.cast("long").alias("queue_taken"),
    ]


def completed_row(spark: SparkSession, step: int, total: int) -> DataFrame:
    """The row that closes a step: batch 0, no rows, the total of the step."""
    zero = F.lit(0)
    return spark.range(1).select(*_log_row(step, zero, zero, F.lit(total), COMPLETED, zero))


def batch_log(
    spark: SparkSession,
    step: int,
    n_rows: int,
    size: int,
    *,
    first: int = 1,
    base: int = 0,
    close: bool = True,
) -> DataFrame:
    """Log of `n_rows` rows loaded in full batches of `size`, in closed form.

    Steps 1 and 3 notice that they are done by a batch of no rows, which is
    logged too; step 2 stops before it logs one. Sizes and totals follow from
    the batch number alone, so the log needs no window.
    """
    n_batches = -(-n_rows // size)
    if close and step != MISSING_PARENTS:
        n_batches += 1
    before = F.col("id") * size
    inserted = F.greatest(F.lit(0), F.least(F.lit(size), F.lit(n_rows) - before))
    total = F.lit(base) + F.least(before + size, F.lit(n_rows))
    taken = inserted if step == MISSING_PARENTS else F.lit(0)
    log = spark.range(n_batches).select(
        *_log_row(step, F.col("id") + first, inserted, total, IN_PROGRESS, taken)
    )
    return log.unionByName(completed_row(spark, step, base + n_rows)) if close else log


def counted_log(
    batches: DataFrame,
    spark: SparkSession,
    step: int,
    n_rows: int,
    size: int,
    *,
    first: int = 1,
    base: int = 0,
) -> DataFrame:
    """Log of batches that hold fewer rows than were drawn for them.

    `batches` has (batch_number, rows_inserted) as counted in the target. Used
    when queued ids have no source row any more; batches without a row are
    logged with 0.
    """
    drawn = batch_log(spark, step, n_rows, size, first=first, close=False)
    counts = batches.select("batch_number", F.col("rows_inserted").alias("_n"))
    counted = (
        drawn.drop("total_rows_inserted")
        .join(counts, "batch_number", "left")
        .withColumn("rows_inserted", F.coalesce("_n", F.lit(0).cast("long")))
        .drop("_n")
    )
    totals = running_total(counted, "batch_number", "rows_inserted", "total_rows_inserted")
    total = F.lit(base) + F.col("total_rows_inserted")
    return totals.withColumn("total_rows_inserted", total).select(drawn.columns)
