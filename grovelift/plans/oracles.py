"""The sample queries as plain SQL, to check results against another engine.

The statements use other join forms than the library: inner joins for scope,
outer joins with a NULL test for absent rows, windows for batches and totals.
"""

from __future__ import annotations

from grovelift.plans.sample_queries import (
    CHAIN_TABLE,
    NOW,
    RESET_RUN,
    RESET_TABLE,
    RUN_ID,
    SCRIPT_TEXT,
    STARTED,
    TABLE,
)
from grovelift.schemas import DEFAULT_BATCH_SIZE, FILE_COLUMNS
from grovelift.sources.bindings import (
    CHAIN_OWNER,
    FOREST_EXCLUDED,
    FOREST_REGION,
    LOADED_BEFORE,
)

_COLUMNS = ", ".join(FILE_COLUMNS)
_TIMES = [c for c in FILE_COLUMNS if c.endswith("_time")]
_FLAGS = [c for c in FILE_COLUMNS if c.startswith("is_")]


def _file(id_, payload, name, path, parent, at, is_dir):
    true_flag = "is_directory" if is_dir else "is_archive"
    times = ", ".join(f"{at} AS {c}" for c in _TIMES)
    flags = ", ".join(f"{str(c == true_flag).lower()} AS {c}" for c in _FLAGS)
    return (
        f"SELECT {id_} AS stream_id, hex(encode({payload})) AS file_stream, {name} AS name, "
        f"{path} AS path_locator, {times}, {flags}, {parent} AS parent_path_locator"
    )


_DAY = "date_diff('day', DATE '1970-01-01', CAST(l_shipdate AS DATE))"
_TAIL = f"l_linenumber || '-' || l_partkey || '-' || l_suppkey || '-' || {_DAY}"
_ITEM = f"'L' || l_orderkey || '-' || {_TAIL}"
_FOLDER = "'/' || l_orderkey || '/'"

FOREST = f"""
files AS MATERIALIZED (
  {_file("'O' || o_orderkey", "o_orderpriority", "o_orderpriority", "'/' || o_orderkey || '/'",
         "CAST(NULL AS VARCHAR)", "o_orderdate", True)} FROM orders
  UNION ALL
  {_file(_ITEM, "l_returnflag", "l_returnflag", f"{_FOLDER} || {_TAIL} || '/'", _FOLDER,
         "l_shipdate", False)} FROM lineitem
), meta AS MATERIALIZED (
  SELECT 'O' || o_orderkey AS file_id, c_nationkey AS unit
  FROM orders JOIN customer ON c_custkey = o_custkey
  UNION ALL
  SELECT {_ITEM}, s_nationkey FROM lineitem JOIN supplier ON s_suppkey = l_suppkey
), allowed AS (
  SELECT n_nationkey AS unit FROM nation JOIN region ON r_regionkey = n_regionkey
  WHERE r_name = '{FOREST_REGION}'
), held AS (
  SELECT {_COLUMNS} FROM files WHERE creation_time < TIMESTAMP '{LOADED_BEFORE}'
)
"""

_CHAIN_PATH = "'/' || conv_id || '/' || turn || '/'"
_CHAIN_PARENT = "CASE WHEN turn > 0 THEN '/' || conv_id || '/' || (turn - 1) || '/' END"
CHAIN = f"""
files AS (
  {_file("conv_id || '-' || turn", "text", "role", _CHAIN_PATH, _CHAIN_PARENT,
         "TIMESTAMP '2026-01-01'", False)} FROM conversations
), meta AS (
  SELECT conv_id || '-' || turn AS file_id, role AS unit FROM conversations
), allowed AS (
  SELECT '{CHAIN_OWNER}' AS unit
), held AS (
  SELECT {_COLUMNS} FROM files WHERE false
)
"""

# Each step reads what the target held and what the steps before it brought. The
# steps work on narrow rows, each computed once; other columns are added at the end.


def _steps(excluded: str) -> str:
    return f"""
, narrow AS MATERIALIZED (
  SELECT stream_id, name, path_locator, parent_path_locator FROM files
), held_1 AS MATERIALIZED (SELECT stream_id FROM held),
scoped AS MATERIALIZED (
  SELECT f.* FROM narrow f
  JOIN meta m ON m.file_id = f.stream_id
  JOIN allowed a ON a.unit = m.unit
  WHERE f.stream_id <> '{excluded}'
), step_1 AS MATERIALIZED (
  SELECT s.stream_id FROM scoped s LEFT JOIN held_1 h ON h.stream_id = s.stream_id
  WHERE s.parent_path_locator IS NULL AND h.stream_id IS NULL
), held_2 AS MATERIALIZED (
  SELECT stream_id FROM held_1 UNION ALL SELECT stream_id FROM step_1
), parents AS MATERIALIZED (
  SELECT DISTINCT p.stream_id FROM scoped s
  JOIN narrow p ON p.path_locator = s.parent_path_locator
), queue AS MATERIALIZED (
  SELECT p.stream_id FROM parents p LEFT JOIN held_2 h ON h.stream_id = p.stream_id
  WHERE p.stream_id <> '{excluded}' AND h.stream_id IS NULL
), step_2 AS MATERIALIZED (SELECT stream_id FROM queue),
held_3 AS MATERIALIZED (
  SELECT stream_id FROM held_2 UNION ALL SELECT stream_id FROM step_2
), step_3 AS MATERIALIZED (
  SELECT s.stream_id FROM scoped s LEFT JOIN held_3 h ON h.stream_id = s.stream_id
  WHERE s.parent_path_locator IS NOT NULL AND h.stream_id IS NULL
), loaded AS MATERIALIZED (
  SELECT 1 AS step, stream_id FROM step_1
  UNION ALL SELECT 2, stream_id FROM step_2
  UNION ALL SELECT 3, stream_id FROM step_3
), target AS (
  SELECT {_COLUMNS} FROM held
  UNION ALL
  SELECT {_COLUMNS} FROM files JOIN loaded USING (stream_id)
)"""


def _forest(select: str) -> str:
    return f"WITH {FOREST} {_steps(FOREST_EXCLUDED)} {select}"


def _chain(select: str) -> str:
    return f"WITH {CHAIN} {_steps('')} {select}"


def _rows(step: str) -> str:
    return f"SELECT {_COLUMNS} FROM files WHERE stream_id IN (SELECT stream_id FROM {step})"


_B = DEFAULT_BATCH_SIZE


def _batches(step: str) -> str:
    number = f"CAST(ceil(row_number() OVER (ORDER BY stream_id) / {_B}.0) AS INTEGER)"
    return _forest(f"SELECT stream_id, {number} AS batch_number FROM {step}")


def _first(step: str) -> str:
    return _forest(f"{_rows(step)} ORDER BY stream_id LIMIT {_B}")


_QUEUE = f"""
SELECT '{RUN_ID}' AS run_id, '{TABLE}' AS table_name, stream_id, {{processed}} AS processed,
       TIMESTAMP '{STARTED}' AS created_at
FROM queue
"""
_DONE = f"stream_id IN (SELECT stream_id FROM queue ORDER BY stream_id LIMIT {_B})"

_PROGRESS = f"""
, numbered AS (
  SELECT step, ceil(row_number() OVER (PARTITION BY step ORDER BY stream_id) / {_B}.0) AS batch
  FROM loaded
), batches AS (
  SELECT step, batch, count(*) AS n FROM numbered GROUP BY step, batch
  UNION ALL
  SELECT s.step, 1 + coalesce(max(n.batch), 0), 0
  FROM (SELECT unnest([1, 3]) AS step) s LEFT JOIN numbered n ON n.step = s.step GROUP BY s.step
), log AS (
  SELECT step, batch, n, sum(n) OVER (PARTITION BY step ORDER BY batch) AS total,
         'InProgress' AS status
  FROM batches
  UNION ALL
  SELECT s.step, 0, 0, count(l.stream_id), 'Completed'
  FROM (SELECT unnest([1, 2, 3]) AS step) s LEFT JOIN loaded l ON l.step = s.step GROUP BY s.step
)
SELECT '{RUN_ID}' AS run_id, '{TABLE}' AS table_name, TIMESTAMP '{STARTED}' AS run_started_at,
       CAST(step AS SMALLINT) AS step, CAST(batch AS INTEGER) AS batch_number,
       CAST(n AS BIGINT) AS rows_inserted, CAST(total AS BIGINT) AS total_rows_inserted,
       TIMESTAMP '{STARTED}' AS batch_started_at, TIMESTAMP '{NOW}' AS batch_completed_at,
       status, CAST(NULL AS VARCHAR) AS error_message, 0 AS failure_number
FROM log
"""

LOG = """
log AS (
  SELECT 'R' || o_custkey AS run_id, o_orderstatus AS table_name, o_orderdate AS run_started_at,
         CAST(CASE WHEN o_orderpriority IN ('1-URGENT', '2-HIGH') THEN 1
                   WHEN o_orderpriority IN ('3-MEDIUM', '4-NOT SPECIFIED') THEN 2
                   ELSE 3 END AS SMALLINT) AS step,
         o_orderkey AS batch_number, CAST(floor(o_totalprice) AS BIGINT) AS total_rows_inserted,
         CASE WHEN o_totalprice > 400000 THEN 'Completed'
              WHEN o_totalprice > 350000 THEN 'Failed' ELSE 'InProgress' END AS status
  FROM orders
)
"""

_OPEN = "status = 'InProgress'"


def _config(table, kind, number, nation, archive, schema):
    return f"""
  SELECT 'lake.files.{kind}_' || {number} AS table_name, '{archive}' AS source_database,
         {schema} AS source_schema, '{kind}_' || {number} AS source_table,
         'lake' AS target_database, 'files' AS target_schema,
         '{kind}_' || {number} AS target_table, 'meta' AS metadata_database,
         'owners' AS metadata_schema, 'nation_' || {nation} AS metadata_table,
         'file_id' AS metadata_id_column
  FROM {table}"""


_NAMES = [
    f"{role}_{part}"
    for role in ("source", "target", "metadata")
    for part in ("database", "schema", "table")
] + ["metadata_id_column"]

CONFIG = f"""
seed AS ({_config("customer", "customer", "c_custkey", "c_nationkey", "archive", "lower(c_mktsegment)")}
  UNION ALL {_config("supplier", "supplier", "s_suppkey", "s_nationkey", "archive", "'supplier'")}
), old AS (
  SELECT *, 'X-' || source_table AS excluded_stream_id, source_schema <> 'machinery' AS is_active
  FROM ({_config("customer WHERE c_acctbal >= 0", "customer", "c_custkey", "c_nationkey",
                 "old_archive", "lower(c_mktsegment)")})
), config AS (
  SELECT table_name, {", ".join(_NAMES)}, excluded_stream_id, is_active,
         TIMESTAMP '{STARTED}' AS created_at, TIMESTAMP '{STARTED}' AS updated_at
  FROM old WHERE table_name NOT IN (SELECT table_name FROM seed)
  UNION ALL
  SELECT s.table_name, {", ".join("s." + n for n in _NAMES)}, o.excluded_stream_id,
         o.table_name IS NULL OR o.is_active,
         CASE WHEN o.table_name IS NULL THEN TIMESTAMP '{NOW}' ELSE TIMESTAMP '{STARTED}' END,
         CASE WHEN o.table_name IS NOT NULL THEN TIMESTAMP '{NOW}' END
  FROM seed s LEFT JOIN old o ON o.table_name = s.table_name
), resolved AS (
  SELECT table_name, source_database || '.' || source_schema || '.' || source_table AS source,
         target_database || '.' || target_schema || '.' || target_table AS target,
         metadata_database || '.' || metadata_schema || '.' || metadata_table AS metadata,
         metadata_id_column, is_active
  FROM config
), queue_scripts AS (
  SELECT table_name, 'old' AS script_body FROM old
  WHERE table_name NOT IN (SELECT table_name FROM seed)
  UNION ALL
  SELECT table_name, '{SCRIPT_TEXT} -- ' || source_schema FROM seed
)
"""


def _scripts(step):
    return f"""
  SELECT CAST({step} AS SMALLINT) AS step_number, p_type AS script_kind,
         min(p_brand) AS stage_name, min(p_name) AS script_body,
         count(*) > 1 AS use_parameterized_max_dop, max(p_name) AS description
  FROM part GROUP BY ALL"""


SCRIPTS = f"held AS ({_scripts('p_size')}), given AS ({_scripts('51 - p_size')})"

ORACLES: dict[str, str] = {
    "files_scan": f"WITH {FOREST} SELECT {_COLUMNS}, parent_path_locator FROM files",
    "scope_keys": f"""WITH {FOREST}
        SELECT DISTINCT file_id AS stream_id FROM meta m JOIN allowed a ON a.unit = m.unit""",
    "in_scope": _forest("SELECT stream_id, name, path_locator, parent_path_locator FROM scoped"),
    "roots_pending": _forest(_rows("step_1")),
    "children_pending": _forest(_rows("step_3")),
    "direct_parents": _forest("SELECT stream_id FROM parents"),
    "parent_queue": _forest(_QUEUE.format(processed="false")),
    "missing_parents_rows": _forest(_rows("step_2")),
    "roots_first_batch": _first("step_1"),
    "children_first_batch": _first("step_3"),
    "queue_batch": _forest(f"SELECT stream_id FROM queue ORDER BY stream_id LIMIT {_B}"),
    "queue_after_batch": _forest(_QUEUE.format(processed=_DONE)),
    "queue_unprocessed": _forest(
        f"SELECT * FROM ({_QUEUE.format(processed=_DONE)}) WHERE NOT processed"
    ),
    "roots_batches": _batches("step_1"),
    "children_batches": _batches("step_3"),
    "parent_batches": _batches("queue"),
    "batch_totals": f"""
        SELECT batch_number, count(*) AS rows_inserted,
               CAST(sum(count(*)) OVER (ORDER BY batch_number) AS BIGINT) AS total_rows_inserted
        FROM ({_batches("step_3")}) GROUP BY batch_number""",
    "progress_log": _forest(_PROGRESS),
    "load_labels": _forest("SELECT stream_id, CAST(step AS SMALLINT) AS step FROM loaded"),
    "chain_labels": _chain("SELECT stream_id, CAST(step AS SMALLINT) AS step FROM loaded"),
    "migrated_target": _forest("SELECT * FROM target"),
    "migrated_two_tables": f"""
        SELECT *, '{TABLE}' AS table_name FROM ({_forest("SELECT * FROM target")})
        UNION ALL
        SELECT *, '{CHAIN_TABLE}' FROM ({_chain("SELECT * FROM target")})""",
    "resume_state": f"""WITH {LOG}
        SELECT run_id, table_name, step,
               coalesce(max(batch_number) FILTER ({_OPEN}), 0) AS batch_number,
               coalesce(max(total_rows_inserted) FILTER ({_OPEN}), 0) AS total_rows_inserted,
               count(*) FILTER (status = 'Completed') > 0 AS completed
        FROM log GROUP BY run_id, table_name, step""",
    "steps_completed": f"""WITH {LOG}
        SELECT DISTINCT run_id, table_name, step FROM log WHERE status = 'Completed'""",
    "run_started_at": f"""WITH {LOG}
        SELECT run_id, table_name, min(run_started_at) AS run_started_at
        FROM log GROUP BY run_id, table_name""",
    "state_after_reset": f"""WITH {LOG} SELECT * FROM log
        WHERE NOT (run_id = '{RESET_RUN}' AND table_name = '{RESET_TABLE}')""",
    "evolve_backfill": f"""WITH {LOG} SELECT * REPLACE ('{TABLE}' AS table_name) FROM log""",
    "evolve_nullable": f"""WITH {SCRIPTS}
        SELECT * REPLACE (CAST(NULL AS VARCHAR) AS stage_name) FROM held""",
    "key_check": """SELECT l_orderkey, l_linenumber, count(*) AS n_rows
        FROM lineitem GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1""",
    "key_check_widened": f"""WITH {LOG}
        SELECT run_id, CAST(NULL AS VARCHAR) AS table_name, step, status, count(*) AS n_rows
        FROM log GROUP BY run_id, step, status HAVING count(*) > 1
        UNION ALL
        SELECT run_id, table_name, step, status, count(*)
        FROM log GROUP BY run_id, table_name, step, status HAVING count(*) > 1""",
    "config_seed": f"""WITH {CONFIG}
        SELECT *, CAST(NULL AS VARCHAR) AS excluded_stream_id FROM seed""",
    "config_upsert": f"WITH {CONFIG} SELECT * FROM config",
    "config_resolved": f"WITH {CONFIG} SELECT * FROM resolved",
    "config_active": f"WITH {CONFIG} SELECT * EXCLUDE (is_active) FROM resolved WHERE is_active",
    "steps_upsert": f"""WITH {SCRIPTS}
        SELECT coalesce(h.step_number, g.step_number) AS step_number,
               coalesce(h.script_kind, g.script_kind) AS script_kind,
               coalesce(g.stage_name, h.stage_name) AS stage_name,
               coalesce(g.script_body, h.script_body) AS script_body,
               CASE WHEN h.step_number <> 1
                    THEN coalesce(h.use_parameterized_max_dop, g.use_parameterized_max_dop)
                    ELSE coalesce(g.use_parameterized_max_dop, h.use_parameterized_max_dop)
               END AS use_parameterized_max_dop,
               coalesce(g.description, h.description) AS description
        FROM held h FULL JOIN given g
          ON g.step_number = h.step_number AND g.script_kind = h.script_kind""",
    "queue_defs_upsert": f"WITH {CONFIG} SELECT * FROM queue_scripts",
    "template_bound": f"""WITH {CONFIG}
        SELECT q.table_name, replace(replace(replace(replace(replace(q.script_body,
               '[SourceTableFull]', c.source), '[TargetTableFull]', c.target),
               '[MetadataTableFull]', c.metadata), '[MetadataIdColumn]', c.metadata_id_column),
               '[MaxDOP]', '2') AS script_body
        FROM queue_scripts q JOIN resolved c ON c.table_name = q.table_name""",
    "template_roots": _forest("SELECT stream_id FROM step_1"),
}
