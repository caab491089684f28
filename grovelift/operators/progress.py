"""What the progress log and the work queue say about runs."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from grovelift.schemas import COMPLETED, ID, IN_PROGRESS, QUEUE_COLUMNS

RUN = ["run_id", "table_name"]


def resume_state(progress: DataFrame) -> DataFrame:
    """Per run, table and step: the last batch, the rows so far, whether it is done.

    One aggregate answers for all steps. Failure rows take no part, so a resumed
    step goes on with the batch after the last one that was loaded.
    """
    loaded = F.col("status") == IN_PROGRESS
    return progress.groupBy(*RUN, "step").agg(
        F.coalesce(F.max(F.when(loaded, F.col("batch_number"))), F.lit(0)).alias("batch_number"),
        F.coalesce(F.max(F.when(loaded, F.col("total_rows_inserted"))), F.lit(0)).alias(
            "total_rows_inserted"
        ),
        F.max(F.col("status") == COMPLETED).alias("completed"),
    )


def steps_completed(progress: DataFrame) -> DataFrame:
    """Steps that need not run again."""
    return progress.where(F.col("status") == COMPLETED).select(*RUN, "step").distinct()


def run_started_at(progress: DataFrame) -> DataFrame:
    """Start time of each run; the earliest, should the log hold several."""
    return progress.groupBy(*RUN).agg(F.min("run_started_at").alias("run_started_at"))


def without_run(rows: DataFrame, run_id: str, table_name: str) -> DataFrame:
    """State rows that are left after a reset of one run of one table."""
    return rows.where((F.col("run_id") != run_id) | (F.col("table_name") != table_name))


def queue_view(queue: DataFrame, drawn: int) -> DataFrame:
    """The work queue of a run with its processed flag.

    Batches drain the queue in order of position, so the number of rows drawn
    so far tells for every row whether it was processed; no row is updated and
    nothing is joined.
    """
    return queue.withColumn("processed", F.col("position") <= drawn).select(*QUEUE_COLUMNS)


def mark_processed(queue: DataFrame, batch: DataFrame) -> DataFrame:
    """Set the processed flag of the queue rows that a batch of ids names."""
    done = batch.select(ID).distinct().withColumn("_done", F.lit(True))
    return (
        queue.join(done, ID, "left")
        .withColumn("processed", F.col("processed") | F.col("_done").isNotNull())
        .select(queue.columns)
    )
