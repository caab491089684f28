"""Every operator of the library as a query over the sample tables.

Each query takes (spark, folder of the tables) and reads whole tables. Run id
and times are constants, so that results can be compared; payloads are shown
in hexadecimal. State tables with many runs are derived from orders, and
configurations with many tables from customers and suppliers.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from grovelift.functions import bind_tokens
from grovelift.operators import (
    add_column,
    assign_batches,
    batch_log,
    direct_parents,
    fetch_rows,
    first_batch,
    in_scope,
    key_violations,
    label_rows,
    missing_parents,
    resume_state,
    roots,
    run_started_at,
    running_total,
    scope_ids,
    steps_completed,
    upsert,
    without_run,
)
from grovelift.operators.progress import mark_processed
from grovelift.operators.sizing import Size, checkpointed, checkpointed_with_size
from grovelift.plans.config import active, resolved_names
from grovelift.plans.scripts import ROOTS_SCRIPT, STEP_1_UPDATED, STEP_UPDATED, bind_script
from grovelift.schemas import (
    CHILDREN,
    CONFIG_KEY,
    CONFIG_SCHEMA,
    CONFIG_UPDATED,
    DEFAULT_BATCH_SIZE,
    FILE_COLUMNS,
    ID,
    MISSING_PARENTS,
    PARENT,
    PAYLOAD,
    PROGRESS_COLUMNS,
    QUEUE_SCRIPT_KEY,
    ROOTS,
    SCRIPT_KEY,
    SCRIPT_TOKENS,
    STEPS,
)
from grovelift.sources.bindings import Inputs, chain, forest, forest_source, table

RUN_ID = "5C0FFEE0-0000-4000-8000-000000000001"
TABLE = "lake.files.orders"
CHAIN_TABLE = "lake.files.conversations"
STARTED = "2026-01-01 00:00:00"
NOW = "2026-01-01 00:00:10"
# The run of the derived log that a reset forgets.
RESET_RUN, RESET_TABLE = "R7", "F"
SCRIPT_TEXT = (
    "FROM [SourceTableFull] JOIN [MetadataTableFull] ON [MetadataIdColumn] "
    "INTO [TargetTableFull] WITH [MaxDOP]"
)


def _at(value: str) -> Column:
    return F.lit(value).cast("timestamp_ntz")


def _shown(rows: DataFrame) -> DataFrame:
    return rows.withColumn(PAYLOAD, F.hex(PAYLOAD))


def _scope(inputs: Inputs) -> DataFrame:
    return scope_ids(inputs.metadata, inputs.allowed, inputs.id_column)


# -- scans and scope


def files_scan(spark, sf_dir):
    return _shown(forest_source(spark, sf_dir).select(*FILE_COLUMNS, PARENT))


def scope_keys(spark, sf_dir):
    return _scope(forest(spark, sf_dir))


def in_scope_rows(spark, sf_dir):
    inputs = forest(spark, sf_dir)
    rows = in_scope(inputs.source, _scope(inputs), inputs.excluded_id)
    return rows.select(ID, "name", "path_locator", PARENT)


# -- the steps


def _label_args(inputs: Inputs):
    return inputs.source, _scope(inputs), inputs.target, inputs.excluded_id


def roots_pending(spark, sf_dir):
    inputs = forest(spark, sf_dir)
    narrow = inputs.source.select(ID, PARENT)
    keys = roots(narrow, _scope(inputs), inputs.target, inputs.excluded_id).select(ID)
    keys, size = checkpointed_with_size(keys, ID)
    return _shown(fetch_rows(inputs.source, keys, size))


def children_pending(spark, sf_dir):
    """Step 3, which sees what the target held and what steps 1 and 2 brought."""
    keys, size = checkpointed_with_size(_ids_of(CHILDREN, spark, sf_dir), ID)
    return _shown(fetch_rows(forest(spark, sf_dir).source, keys, size))


def parents(spark, sf_dir):
    inputs = forest(spark, sf_dir)
    return direct_parents(inputs.source, _scope(inputs), inputs.excluded_id)


def _labels(inputs: Inputs) -> tuple[DataFrame, Size]:
    return checkpointed_with_size(label_rows(*_label_args(inputs)), ID)


def parent_queue(spark, sf_dir):
    """Missing parents after step 1 has run, as rows of the work queue."""
    inputs = forest(spark, sf_dir)
    source, scope, target, excluded_id = _label_args(inputs)
    scope = checkpointed(scope)
    brought = roots(source, scope, target, excluded_id)
    held = target.select(ID).unionByName(brought.select(ID))
    return _queue_rows(missing_parents(source, scope, held, excluded_id))


def _queue_rows(ids: DataFrame) -> DataFrame:
    return ids.select(
        F.lit(RUN_ID).alias("run_id"),
        F.lit(TABLE).alias("table_name"),
        ID,
        F.lit(False).alias("processed"),
        _at(STARTED).alias("created_at"),
    )


def _ids_of(step: int, spark, sf_dir) -> DataFrame:
    """Ids that one step loads, as a load finds them: narrow columns, one pass."""
    steps = [s for s in STEPS if s <= step]
    labels = label_rows(*_label_args(forest(spark, sf_dir)), steps)
    return labels.where(F.col("step") == step).select(ID)


def missing_parents_rows(spark, sf_dir):
    keys, size = checkpointed_with_size(_ids_of(MISSING_PARENTS, spark, sf_dir), ID)
    return _shown(fetch_rows(forest(spark, sf_dir).source, keys, size))


# -- batches, queue and log


def _first_rows(step: int, spark, sf_dir) -> DataFrame:
    """The first batch: top ids first, then the payload of those rows only."""
    keys = first_batch(_ids_of(step, spark, sf_dir), DEFAULT_BATCH_SIZE)
    keys, size = checkpointed_with_size(keys, ID)
    return _shown(fetch_rows(forest(spark, sf_dir).source, keys, size))


def roots_first_batch(spark, sf_dir):
    return _first_rows(ROOTS, spark, sf_dir)


def children_first_batch(spark, sf_dir):
    return _first_rows(CHILDREN, spark, sf_dir)


def queue_batch(spark, sf_dir):
    return first_batch(_ids_of(MISSING_PARENTS, spark, sf_dir), DEFAULT_BATCH_SIZE)


def queue_after_batch(spark, sf_dir):
    queue = checkpointed(_queue_rows(_ids_of(MISSING_PARENTS, spark, sf_dir)))
    return mark_processed(queue, first_batch(queue, DEFAULT_BATCH_SIZE))


def queue_unprocessed(spark, sf_dir):
    return queue_after_batch(spark, sf_dir).where(~F.col("processed"))


def roots_batches(spark, sf_dir):
    return assign_batches(_ids_of(ROOTS, spark, sf_dir), DEFAULT_BATCH_SIZE)


def children_batches(spark, sf_dir):
    return assign_batches(_ids_of(CHILDREN, spark, sf_dir), DEFAULT_BATCH_SIZE)


def parent_batches(spark, sf_dir):
    return assign_batches(_ids_of(MISSING_PARENTS, spark, sf_dir), DEFAULT_BATCH_SIZE)


def batch_totals(spark, sf_dir):
    """Rows of each batch of step 3 as counted, and the running total."""
    counts = children_batches(spark, sf_dir).groupBy("batch_number")
    counts = counts.agg(F.count(F.lit(1)).alias("rows_inserted"))
    return running_total(counts, "batch_number", "rows_inserted", "total_rows_inserted")


def progress_log(spark, sf_dir):
    """The log of a whole load; only one count per step reaches the driver."""
    labels = label_rows(*_label_args(forest(spark, sf_dir)))
    counts = {r["step"]: r["count"] for r in labels.groupBy("step").count().collect()}
    logs = [batch_log(spark, s, counts.get(s, 0), DEFAULT_BATCH_SIZE) for s in STEPS]
    given = {
        "run_id": F.lit(RUN_ID),
        "table_name": F.lit(TABLE),
        "run_started_at": _at(STARTED),
        "batch_started_at": _at(STARTED),
        "batch_completed_at": _at(NOW),
        "error_message": F.lit(None).cast("string"),
        "failure_number": F.lit(0),
    }
    return reduce(DataFrame.unionByName, logs).withColumns(given).select(*PROGRESS_COLUMNS)


# -- whole loads


def _loaded(inputs: Inputs) -> DataFrame:
    """The target after a load: what it held, and the rows of all three steps."""
    labels, size = _labels(inputs)
    loaded = fetch_rows(inputs.source, labels.select(ID), size)
    return _shown(inputs.target.unionByName(loaded))


def migrated_target(spark, sf_dir):
    return _loaded(forest(spark, sf_dir))


def migrated_two_tables(spark, sf_dir):
    first = _loaded(forest(spark, sf_dir)).withColumn("table_name", F.lit(TABLE))
    second = _loaded(chain(spark, sf_dir)).withColumn("table_name", F.lit(CHAIN_TABLE))
    return first.unionByName(second)


def load_labels(spark, sf_dir):
    """Which step loads which row."""
    return label_rows(*_label_args(forest(spark, sf_dir)))


def chain_labels(spark, sf_dir):
    return label_rows(*_label_args(chain(spark, sf_dir)))


# -- run state, from a log in which each order is a batch


def run_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    price, priority = F.col("o_totalprice"), F.col("o_orderpriority")
    status = F.when(price > 400000, "Completed").when(price > 350000, "Failed")
    step = F.when(priority.isin("1-URGENT", "2-HIGH"), 1)
    step = step.when(priority.isin("3-MEDIUM", "4-NOT SPECIFIED"), 2).otherwise(3)
    return table(spark, sf_dir, "orders").select(
        F.concat(F.lit("R"), "o_custkey").alias("run_id"),
        F.col("o_orderstatus").alias("table_name"),
        F.col("o_orderdate").alias("run_started_at"),
        step.cast("short").alias("step"),
        F.col("o_orderkey").alias("batch_number"),
        F.floor(price).alias("total_rows_inserted"),
        status.otherwise("InProgress").alias("status"),
    )


def resume_state_rows(spark, sf_dir):
    return resume_state(run_log(spark, sf_dir))


def steps_completed_rows(spark, sf_dir):
    return steps_completed(run_log(spark, sf_dir))


def run_started_at_rows(spark, sf_dir):
    return run_started_at(run_log(spark, sf_dir))


def state_after_reset(spark, sf_dir):
    return without_run(run_log(spark, sf_dir), RESET_RUN, RESET_TABLE)


def evolve_backfill(spark, sf_dir):
    """A log from before table names were kept; adding the column twice is harmless."""
    old = run_log(spark, sf_dir).drop("table_name")
    new = add_column(old, "table_name", "string", TABLE)
    return add_column(new, "table_name", "string", "another default")


def evolve_nullable(spark, sf_dir):
    return add_column(_held_scripts(spark, sf_dir).drop("stage_name"), "stage_name", "string")


def key_check(spark, sf_dir):
    return key_violations(table(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"])


def key_check_widened(spark, sf_dir):
    """The same check on the log, before and after its key got the table name."""
    log = run_log(spark, sf_dir).drop("batch_number")
    narrow = key_violations(log, ["run_id", "step", "status"])
    wide = key_violations(log, ["run_id", "table_name", "step", "status"])
    return narrow.withColumn("table_name", F.lit(None).cast("string")).unionByName(wide)


# -- configuration and scripts


def _config(rows: DataFrame, kind: str, number: str, nation: str, archive: str, schema: Column):
    name = F.concat(F.lit(kind + "_"), number)
    return rows.select(
        F.concat(F.lit("lake.files."), name).alias("table_name"),
        F.lit(archive).alias("source_database"),
        schema.alias("source_schema"),
        name.alias("source_table"),
        F.lit("lake").alias("target_database"),
        F.lit("files").alias("target_schema"),
        name.alias("target_table"),
        F.lit("meta").alias("metadata_database"),
        F.lit("owners").alias("metadata_schema"),
        F.concat(F.lit("nation_"), nation).alias("metadata_table"),
        F.lit("file_id").alias("metadata_id_column"),
        F.lit(None).cast("string").alias("excluded_stream_id"),
    )


def config_seed(spark, sf_dir):
    """One table per customer and one per supplier."""
    customers = _config(
        table(spark, sf_dir, "customer"), "customer", "c_custkey", "c_nationkey", "archive",
        F.lower("c_mktsegment"),
    )
    suppliers = _config(
        table(spark, sf_dir, "supplier"), "supplier", "s_suppkey", "s_nationkey", "archive",
        F.lit("supplier"),
    )
    return customers.unionByName(suppliers)


def _held_config(spark, sf_dir) -> DataFrame:
    """Customers in credit have a config already, from an older archive."""
    customers = table(spark, sf_dir, "customer").where(F.col("c_acctbal") >= 0)
    is_active = F.col("source_schema") != "machinery"
    rows = _config(
        customers, "customer", "c_custkey", "c_nationkey", "old_archive", F.lower("c_mktsegment")
    )
    return rows.select(
        *[c for c in rows.columns if c != "excluded_stream_id"],
        F.concat(F.lit("X-"), "source_table").alias("excluded_stream_id"),
        is_active.alias("is_active"),
        _at(STARTED).alias("created_at"),
        _at(STARTED).alias("updated_at"),
    ).select(*CONFIG_SCHEMA.names)


def config_upsert(spark, sf_dir):
    return upsert(
        _held_config(spark, sf_dir),
        config_seed(spark, sf_dir),
        CONFIG_KEY,
        CONFIG_UPDATED,
        defaults={"is_active": F.lit(True), "created_at": _at(NOW)},
        on_update={"updated_at": _at(NOW)},
    )


def config_resolved(spark, sf_dir):
    return resolved_names(config_upsert(spark, sf_dir))


def config_active(spark, sf_dir):
    return active(config_upsert(spark, sf_dir))


def _scripts(spark, sf_dir, step: Column) -> DataFrame:
    return (
        table(spark, sf_dir, "part")
        .groupBy(step.cast("short").alias("step_number"), F.col("p_type").alias("script_kind"))
        .agg(
            F.min("p_brand").alias("stage_name"),
            F.min("p_name").alias("script_body"),
            (F.count(F.lit(1)) > 1).alias("use_parameterized_max_dop"),
            F.max("p_name").alias("description"),
        )
    )


def _held_scripts(spark, sf_dir) -> DataFrame:
    return _scripts(spark, sf_dir, F.col("p_size"))


def steps_upsert(spark, sf_dir):
    """Scripts by part size and type; step 1 has one more column to update."""
    given = _scripts(spark, sf_dir, 51 - F.col("p_size"))
    first = F.col("step_number") == 1
    merged = upsert(_held_scripts(spark, sf_dir), given.where(first), SCRIPT_KEY, STEP_1_UPDATED)
    return upsert(merged, given.where(~first), SCRIPT_KEY, STEP_UPDATED)


def queue_defs_upsert(spark, sf_dir):
    held = _held_config(spark, sf_dir).select("table_name", F.lit("old").alias("script_body"))
    given = config_seed(spark, sf_dir).select(
        "table_name", F.concat(F.lit(SCRIPT_TEXT + " -- "), "source_schema").alias("script_body")
    )
    return upsert(held, given, QUEUE_SCRIPT_KEY, ["script_body"])


def template_bound(spark, sf_dir):
    """The stored script of each table with the table's names put in."""
    config = resolved_names(config_upsert(spark, sf_dir))
    names = ["source", "target", "metadata", "metadata_id_column"]
    values = dict(zip(SCRIPT_TOKENS, [*map(F.col, names), F.lit(2)], strict=True))
    return queue_defs_upsert(spark, sf_dir).join(config, "table_name").select(
        "table_name", bind_tokens("script_body", values).alias("script_body")
    )


def template_roots(spark, sf_dir):
    inputs = forest(spark, sf_dir)
    frames = {
        "src": inputs.source,
        "meta": inputs.metadata,
        "allow": inputs.allowed,
        "tgt": inputs.target,
    }
    args = {"metadata_id_column": inputs.id_column, "excluded_id": inputs.excluded_id}
    return bind_script(spark, ROOTS_SCRIPT, frames, args)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "files_scan": files_scan,
    "scope_keys": scope_keys,
    "in_scope": in_scope_rows,
    "roots_pending": roots_pending,
    "children_pending": children_pending,
    "direct_parents": parents,
    "parent_queue": parent_queue,
    "missing_parents_rows": missing_parents_rows,
    "roots_first_batch": roots_first_batch,
    "children_first_batch": children_first_batch,
    "queue_batch": queue_batch,
    "queue_after_batch": queue_after_batch,
    "queue_unprocessed": queue_unprocessed,
    "roots_batches": roots_batches,
    "children_batches": children_batches,
    "parent_batches": parent_batches,
    "batch_totals": batch_totals,
    "progress_log": progress_log,
    "load_labels": load_labels,
    "chain_labels": chain_labels,
    "migrated_target": migrated_target,
    "migrated_two_tables": migrated_two_tables,
    "resume_state": resume_state_rows,
    "steps_completed": steps_completed_rows,
    "run_started_at": run_started_at_rows,
    "state_after_reset": state_after_reset,
    "evolve_backfill": evolve_backfill,
    "evolve_nullable": evolve_nullable,
    "key_check": key_check,
    "key_check_widened": key_check_widened,
    "config_seed": config_seed,
    "config_upsert": config_upsert,
    "config_resolved": config_resolved,
    "config_active": config_active,
    "steps_upsert": steps_upsert,
    "queue_defs_upsert": queue_defs_upsert,
    "template_bound": template_bound,
    "template_roots": template_roots,
}
