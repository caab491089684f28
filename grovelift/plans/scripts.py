"""Steps stated as SQL text that is kept in tables.

A script names its tables as {src}, {meta}, {allow} and {tgt} and its values
as :excluded_id, :run_id, :table_name and :batch_size; the metadata id column
is IDENTIFIER(:metadata_id_column). Spark binds frames and values, so nothing
is spliced into the text.

The step scripts for steps 1 and 3 and the queue script return the ids to
load; the step script for step 2 returns the rows of a queue batch {batch}.
"""

from __future__ import annotations

from collections.abc import Mapping
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from grovelift.operators.sizing import checkpointed
from grovelift.schemas import (
    BATCH_INSERT,
    CHILDREN,
    ID,
    MISSING_PARENTS,
    ROOTS,
    SCRIPT_SCHEMA,
    STAGE_NAMES,
)
from grovelift.sources.state import StateStore

_SCOPE = """
WITH allowed_meta AS (
  SELECT DISTINCT IDENTIFIER(:metadata_id_column) AS id
  FROM {meta} m LEFT SEMI JOIN {allow} a ON a.businessunit = m.OwningBusinessUnit
), held AS (SELECT DISTINCT stream_id FROM {tgt})
"""

ROOTS_SCRIPT = (
    _SCOPE
    + """
SELECT s.stream_id
FROM {src} s
LEFT SEMI JOIN allowed_meta m ON m.id = s.stream_id
LEFT ANTI JOIN held t ON t.stream_id = s.stream_id
WHERE s.parent_path_locator IS NULL AND s.stream_id <> :excluded_id
"""
)

CHILDREN_SCRIPT = (
    _SCOPE
    + """
SELECT s.stream_id
FROM {src} s
LEFT SEMI JOIN allowed_meta m ON m.id = s.stream_id
LEFT ANTI JOIN held t ON t.stream_id = s.stream_id
WHERE s.parent_path_locator IS NOT NULL AND s.stream_id <> :excluded_id
"""
)

QUEUE_SCRIPT = (
    _SCOPE
    + """
, parent_paths AS (
  SELECT DISTINCT s.parent_path_locator AS path
  FROM {src} s LEFT SEMI JOIN allowed_meta m ON m.id = s.stream_id
  WHERE s.parent_path_locator IS NOT NULL AND s.stream_id <> :excluded_id
)
SELECT DISTINCT p.stream_id
FROM {src} p
LEFT SEMI JOIN parent_paths c ON c.path = p.path_locator
LEFT ANTI JOIN held t ON t.stream_id = p.stream_id
WHERE p.stream_id <> :excluded_id
"""
)

BATCH_SCRIPT = """
SELECT s.stream_id FROM {src} s LEFT SEMI JOIN {batch} b ON b.stream_id = s.stream_id
"""

_DESCRIPTIONS = {
    ROOTS: "In-scope rows without a parent that the target lacks",
    MISSING_PARENTS: "Rows of a batch of queued parents",
    CHILDREN: "In-scope rows with a parent that the target lacks",
}
_BODIES = {ROOTS: ROOTS_SCRIPT, MISSING_PARENTS: BATCH_SCRIPT, CHILDREN: CHILDREN_SCRIPT}


def bind_script(
    spark: SparkSession,
    body: str,
    frames: Mapping[str, DataFrame],
    args: Mapping[str, Any] | None = None,
) -> DataFrame:
    """Run a stored script on frames and typed values."""
    return spark.sql(body, args=dict(args or {}), **frames)


def default_step_scripts(spark: SparkSession) -> DataFrame:
    rows = [
        (step, BATCH_INSERT, STAGE_NAMES[step], body, False, _DESCRIPTIONS[step])
        for step, body in _BODIES.items()
    ]
    return spark.createDataFrame(rows, SCRIPT_SCHEMA)


# A second upsert always moves these; for step 1 it also moves the flag that
# says whether the script takes a parallelism value.
STEP_UPDATED = ["stage_name", "script_body", "description"]
STEP_1_UPDATED = [*STEP_UPDATED, "use_parameterized_max_dop"]


def upsert_step_scripts(state: StateStore, rows: DataFrame) -> None:
    default = {"use_parameterized_max_dop": F.lit(False)}
    first = F.col("step_number") == ROOTS
    state.upsert("step_scripts", rows.where(first), STEP_1_UPDATED, default)
    state.upsert("step_scripts", rows.where(~first), STEP_UPDATED, default)


def upsert_queue_scripts(state: StateStore, rows: DataFrame) -> None:
    state.upsert("queue_scripts", rows, ["script_body"])


def seed_scripts(state: StateStore, table_names: list[str]) -> None:
    """Store the default scripts for all steps and for the given tables."""
    spark = state.spark
    upsert_step_scripts(state, default_step_scripts(spark))
    names = spark.createDataFrame([(n,) for n in table_names], "table_name string")
    upsert_queue_scripts(state, names.withColumn("script_body", F.lit(QUEUE_SCRIPT)))


def _one(rows: DataFrame, what: str) -> str:
    found = rows.select("script_body").first()
    if found is None:
        raise KeyError(f"no script for {what}")
    return found[0]


def step_script(state: StateStore, step: int) -> str:
    rows = state.read("step_scripts").where(
        (F.col("step_number") == step) & (F.col("script_kind") == BATCH_INSERT)
    )
    return _one(rows, f"step {step}")


def queue_script(state: StateStore, table_name: str) -> str:
    rows = state.read("queue_scripts").where(F.col("table_name") == table_name)
    return _one(rows, f"the queue of {table_name}")


def label_by_scripts(
    state: StateStore,
    table_name: str,
    frames: Mapping[str, DataFrame],
    args: Mapping[str, Any],
    steps: set[int],
    queued: DataFrame | None,
) -> DataFrame:
    """(id, step) as the stored scripts give it.

    Each script sees the target plus the rows of the steps before it.
    """
    spark = state.spark
    held = frames["tgt"]
    labelled = None
    for step in sorted(steps):
        seen = {**frames, "tgt": held}
        if step == MISSING_PARENTS:
            batch = queued
            if batch is None:
                batch = bind_script(spark, queue_script(state, table_name), seen, args)
            seen = {"src": frames["src"], "batch": batch}
            ids = bind_script(spark, step_script(state, step), seen).join(
                held.select(ID).distinct(), ID, "left_anti"
            )
        else:
            ids = bind_script(spark, step_script(state, step), seen, args)
        # The next script reads these ids as part of its target. The new name gives a
        # new attribute: what Spark infers about the old one does not outlast the cut.
        ids = checkpointed(ids.select(F.col(ID).alias("_found"))).select(F.col("_found").alias(ID))
        held = held.select(ID).unionByName(ids)
        part = ids.withColumn("step", F.lit(step).cast("short"))
        labelled = part if labelled is None else labelled.unionByName(part)
    return labelled
