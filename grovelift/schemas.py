"""Column names, table schemas and values that callers rely on."""

from __future__ import annotations

from pyspark.sql import types as T

# --- Fixed values -----------------------------------------------------------
# Names and constants that must be equal on both sides of a load.

ID = "stream_id"
PAYLOAD = "file_stream"
PATH = "path_locator"
PARENT = "parent_path_locator"

FILE_COLUMNS = [
    "stream_id",
    "file_stream",
    "name",
    "path_locator",
    "creation_time",
    "last_write_time",
    "last_access_time",
    "is_directory",
    "is_offline",
    "is_hidden",
    "is_readonly",
    "is_archive",
    "is_system",
    "is_temporary",
]

OWNER = "OwningBusinessUnit"
ALLOWED_OWNER = "businessunit"

DEFAULT_EXCLUDED_ID = "7F8D53EC-B98C-F011-B86B-005056A2DD37"
DEFAULT_BATCH_SIZE = 500

ROOTS, MISSING_PARENTS, CHILDREN = 1, 2, 3
STAGE_NAMES = {1: "Roots", 2: "MissingParents", 3: "Children"}
BATCH_INSERT = "BatchInsert"

IN_PROGRESS, COMPLETED, FAILED = "InProgress", "Completed", "Failed"
FAILURE_BATCH = 999999

# Markers that a stored script may hold and that binding replaces.
SCRIPT_TOKENS = [
    "[SourceTableFull]",
    "[TargetTableFull]",
    "[MetadataTableFull]",
    "[MetadataIdColumn]",
    "[MaxDOP]",
]
# --- End of fixed values ----------------------------------------------------

STEPS = (ROOTS, MISSING_PARENTS, CHILDREN)


def _type_of(column: str) -> T.DataType:
    if column == PAYLOAD:
        return T.BinaryType()
    if column.startswith("is_"):
        return T.BooleanType()
    if column.endswith("_time"):
        return T.TimestampNTZType()
    return T.StringType()


TARGET_SCHEMA = T.StructType([T.StructField(c, _type_of(c)) for c in FILE_COLUMNS])
SOURCE_SCHEMA = T.StructType(TARGET_SCHEMA.fields + [T.StructField(PARENT, T.StringType())])

# Tables that the library keeps. `attempt` and `chunk` place a row in a
# partition; the other columns are what a caller reads.
PROGRESS_SCHEMA = T.StructType(
    [
        T.StructField("run_started_at", T.TimestampNTZType(), False),
        T.StructField("step", T.ShortType(), False),
        T.StructField("batch_number", T.IntegerType(), False),
        T.StructField("rows_inserted", T.LongType(), False),
        T.StructField("total_rows_inserted", T.LongType(), False),
        T.StructField("batch_started_at", T.TimestampNTZType(), False),
        T.StructField("batch_completed_at", T.TimestampNTZType(), False),
        T.StructField("status", T.StringType(), False),
        T.StructField("error_message", T.StringType()),
        # 0, or the number of the failure within its run and table
        T.StructField("failure_number", T.IntegerType(), False),
        # queue rows that the batch drew; step 2 only
        T.StructField("queue_taken", T.LongType(), False),
        T.StructField("run_id", T.StringType(), False),
        T.StructField("table_name", T.StringType(), False),
        T.StructField("attempt", T.IntegerType(), False),
        T.StructField("chunk", T.IntegerType(), False),
    ]
)
PROGRESS_COLUMNS = [
    "run_id",
    "table_name",
    "run_started_at",
    "step",
    "batch_number",
    "rows_inserted",
    "total_rows_inserted",
    "batch_started_at",
    "batch_completed_at",
    "status",
    "error_message",
    "failure_number",
]
PROGRESS_KEY = ["run_id", "table_name", "step", "batch_number", "failure_number"]

QUEUE_SCHEMA = T.StructType(
    [
        T.StructField("stream_id", T.StringType(), False),
        T.StructField("position", T.LongType(), False),
        T.StructField("created_at", T.TimestampNTZType(), False),
        T.StructField("run_id", T.StringType(), False),
        T.StructField("table_name", T.StringType(), False),
        T.StructField("attempt", T.IntegerType(), False),
    ]
)
QUEUE_COLUMNS = ["run_id", "table_name", "stream_id", "processed", "created_at"]
QUEUE_KEY = ["run_id", "table_name", "stream_id"]

# The file that holds a source row, next to the columns of a source.
FILE = "_file"

_RUN_FIELDS = [
    T.StructField("run_id", T.StringType(), False),
    T.StructField("table_name", T.StringType(), False),
    T.StructField("attempt", T.IntegerType(), False),
]
# The rows to load in one round, numbered; a part is what is copied with keys of its own.
WORK_SCHEMA = T.StructType(
    [
        T.StructField("stream_id", T.StringType(), False),
        T.StructField("step", T.ShortType(), False),
        T.StructField("position", T.LongType(), False),
        T.StructField(FILE, T.StringType()),
        T.StructField("part", T.LongType(), False),
        *_RUN_FIELDS,
        T.StructField("round", T.IntegerType(), False),
    ]
)
# One row per round once its list is whole: the version of the target it was made
# for, and the positions drawn per step.
ROUND_SCHEMA = T.StructType(
    [
        T.StructField("version", T.LongType(), False),
        *[T.StructField(f"drawn_{step}", T.LongType(), False) for step in STEPS],
        *_RUN_FIELDS,
        T.StructField("round", T.IntegerType(), False),
    ]
)
# One row per part of a chunk once the chunk is committed, with the rows written
# per step by the whole chunk.
COPIED_SCHEMA = T.StructType(
    [
        T.StructField("round", T.IntegerType(), False),
        T.StructField("part", T.LongType(), False),
        *[T.StructField(f"written_{step}", T.LongType(), False) for step in STEPS],
        T.StructField("merged_chunk", T.IntegerType()),
        *_RUN_FIELDS,
        T.StructField("chunk", T.IntegerType(), False),
    ]
)

RESET_SCHEMA = T.StructType(
    [
        T.StructField("run_id", T.StringType(), False),
        T.StructField("table_name", T.StringType(), False),
        T.StructField("attempt", T.IntegerType(), False),
        T.StructField("reset_at", T.TimestampNTZType(), False),
    ]
)

CONFIG_SCHEMA = T.StructType(
    [T.StructField("table_name", T.StringType(), False)]
    + [
        T.StructField(f"{role}_{part}", T.StringType(), False)
        for role in ("source", "target", "metadata")
        for part in ("database", "schema", "table")
    ]
    + [
        T.StructField("metadata_id_column", T.StringType(), False),
        T.StructField("excluded_stream_id", T.StringType()),
        T.StructField("is_active", T.BooleanType(), False),
        T.StructField("created_at", T.TimestampNTZType(), False),
        T.StructField("updated_at", T.TimestampNTZType()),
    ]
)
CONFIG_KEY = ["table_name"]
# A second upsert of a table moves its names only: whether it is active, its
# excluded id and its creation time stay as they are.
CONFIG_UPDATED = [
    f.name
    for f in CONFIG_SCHEMA.fields
    if f.name.startswith(("source_", "target_", "metadata_"))
]

SCRIPT_SCHEMA = T.StructType(
    [
        T.StructField("step_number", T.ShortType(), False),
        T.StructField("script_kind", T.StringType(), False),
        T.StructField("stage_name", T.StringType()),
        T.StructField("script_body", T.StringType(), False),
        T.StructField("use_parameterized_max_dop", T.BooleanType(), False),
        T.StructField("description", T.StringType()),
    ]
)
SCRIPT_KEY = ["step_number", "script_kind"]

QUEUE_SCRIPT_SCHEMA = T.StructType(
    [
        T.StructField("table_name", T.StringType(), False),
        T.StructField("script_body", T.StringType(), False),
    ]
)
QUEUE_SCRIPT_KEY = ["table_name"]
