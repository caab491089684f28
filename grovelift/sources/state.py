"""Tables in which loads keep their configuration and progress."""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from datetime import datetime
from urllib.parse import quote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from grovelift import schemas as S
from grovelift.functions import canonical_value
from grovelift.operators.keys import require_key
from grovelift.operators.progress import queue_view, resume_state, run_started_at
from grovelift.operators.sizing import checkpointed
from grovelift.operators.upsert import upsert
from grovelift.sources.catalog import (
    add_table_column,
    create_table,
    drop_partition,
    drop_rows,
    overwrite_partition,
    partition_values,
    partitions_of,
    table_location,
    table_path,
)
from grovelift.sources.claims import Claims
from grovelift.sources.merged_ids import FAN_IN
from grovelift.sources.widen import widen_key

_VERSION = "version"


class StateStore:
    """State tables in one database.

    `progress`, `work_queue`, `resets` and the tables of work to do and done are
    partitioned by run and table, so a run reads and replaces only its own
    partitions. The keyed definition
    tables (`table_config`, `step_scripts`, `queue_scripts`) are rewritten as a
    new version on each upsert and read in their latest version, so that a
    writer that dies halfway loses nothing.
    """

    RUN_TABLES = {
        "progress": (S.PROGRESS_SCHEMA, ("run_id", "table_name", "attempt", "chunk")),
        "work_queue": (S.QUEUE_SCHEMA, ("run_id", "table_name", "attempt")),
        "resets": (S.RESET_SCHEMA, ("run_id", "table_name", "attempt")),
        "work_list": (S.WORK_SCHEMA, ("run_id", "table_name", "attempt", "round")),
        "work_rounds": (S.ROUND_SCHEMA, ("run_id", "table_name", "attempt", "round")),
        "copied": (S.COPIED_SCHEMA, ("run_id", "table_name", "attempt", "chunk")),
    }
    KEYED_TABLES = {
        "table_config": (S.CONFIG_SCHEMA, S.CONFIG_KEY),
        "step_scripts": (S.SCRIPT_SCHEMA, S.SCRIPT_KEY),
        "queue_scripts": (S.QUEUE_SCRIPT_SCHEMA, S.QUEUE_SCRIPT_KEY),
    }

    KEYS = {"progress": S.PROGRESS_KEY, "work_queue": S.QUEUE_KEY}

    def __init__(self, spark: SparkSession, database: str):
        self.spark = spark
        self.database = database

    def name(self, table: str) -> str:
        return f"{self.database}.{table}"

    # What rows from before a column was kept read as; other columns are NULL.
    BACKFILL = {
        "failure_number": 0,
        "queue_taken": 0,
        "use_parameterized_max_dop": False,
        "is_active": True,
    }

    def create(self, location: str | None = None) -> StateStore:
        """Create missing tables and add missing columns; safe to repeat."""
        self.spark.sql(f"CREATE DATABASE IF NOT EXISTS {table_path(self.database)}")
        tables = dict(self.RUN_TABLES)
        for table, (schema, _) in self.KEYED_TABLES.items():
            versioned = T.StructType([*schema.fields, T.StructField(_VERSION, T.IntegerType())])
            tables[table] = (versioned, (_VERSION,))
        for table, (schema, partitions) in tables.items():
            place = f"{location}/{table}" if location else None
            create_table(self.spark, self.name(table), schema, partitions, place)
            held = self.spark.table(table_path(self.name(table))).columns
            for f in [f for f in schema.fields if f.name not in held]:
                kind, default = f.dataType.simpleString(), self.BACKFILL.get(f.name)
                add_table_column(self.spark, self.name(table), f.name, kind, default)
        return self

    def widen(self, table: str, values: Mapping[str, object], location: str | None = None) -> bool:
        """Move the log or the queue, kept with fewer key columns, to the key it has now.

        `values` has what the stored rows lack, such as their table name. To be called
        before the first load; `location` is that of `create`. See `widen_key`.
        """
        schema, partitions = self.RUN_TABLES[table]
        place = f"{location}/{table}" if location else None
        given = {"attempt": 1, "chunk": 1} | self.BACKFILL | dict(values)
        given = {c: v for c, v in given.items() if c in schema.names}
        key = [*self.KEYS[table], "attempt"]
        return widen_key(self.spark, self.name(table), schema, partitions, key, given, place)

    # -- keyed definition tables

    def _version(self, table: str) -> int:
        values = partition_values(self.spark, self.name(table), _VERSION)
        return max((int(v) for v in values), default=0)

    def read(self, table: str) -> DataFrame:
        """A definition table in its latest version."""
        latest = F.col(_VERSION) == self._version(table)
        return self.spark.table(table_path(self.name(table))).where(latest).drop(_VERSION)

    def upsert(
        self,
        table: str,
        rows: DataFrame,
        update_cols: Iterable[str],
        defaults: Mapping[str, Column] | None = None,
        on_update: Mapping[str, Column] | None = None,
    ) -> None:
        schema, keys = self.KEYED_TABLES[table]
        require_key(rows, keys, f"rows for {table}")
        merged = upsert(self.read(table), rows, keys, update_cols, defaults, on_update)
        merged = checkpointed(merged)
        required = [f.name for f in schema.fields if not f.nullable]
        missing = merged.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in required]).first()
        for column in required:
            if missing[column]:
                raise ValueError(f"rows for {table}: {column} must have a value")
        version = self._version(table) + 1
        overwrite_partition(self.spark, self.name(table), {_VERSION: version}, merged)
        # The version before stays for readers that are still at it.
        for value in partition_values(self.spark, self.name(table), _VERSION):
            if int(value) < version - 1:
                drop_partition(self.spark, self.name(table), {_VERSION: int(value)})

    # -- progress, queue, reset

    def _run_rows(self, table: str, run_id: str, table_name: str, attempt: int) -> DataFrame:
        return self.spark.table(table_path(self.name(table))).where(
            (F.col("run_id") == run_id)
            & (F.col("table_name") == table_name)
            & (F.col("attempt") == attempt)
        )

    def attempt(self, run_id: str, table_name: str) -> int:
        """1, and one more for each reset of this run and table."""
        found = (
            self.spark.table(table_path(self.name("resets")))
            .where((F.col("run_id") == run_id) & (F.col("table_name") == table_name))
            .agg(F.max("attempt"))
            .first()[0]
        )
        return found or 1

    def progress(self, run_id: str, table_name: str) -> DataFrame:
        """The log of a run of a table, with the columns that callers read."""
        run_id = canonical_value(run_id)
        attempt = self.attempt(run_id, table_name)
        rows = self._run_rows("progress", run_id, table_name, attempt)
        return rows.select(*S.PROGRESS_COLUMNS)

    def queue(self, run_id: str, table_name: str) -> DataFrame:
        """The work queue of a run of a table, with its processed flag."""
        run_id = canonical_value(run_id)
        run = (run_id, table_name, self.attempt(run_id, table_name))
        _, drawn, _ = self.commit_marks(*run)
        return queue_view(self._run_rows("work_queue", *run), drawn)

    def started_at(self, run_id: str, table_name: str, attempt: int) -> datetime | None:
        row = run_started_at(self._run_rows("progress", run_id, table_name, attempt)).first()
        return row["run_started_at"] if row else None

    def resume_rows(self, run_id: str, table_name: str, attempt: int) -> dict[int, dict]:
        """What is done, per step: at most one row for each of three steps."""
        rows = resume_state(self._run_rows("progress", run_id, table_name, attempt)).collect()
        return {r["step"]: r.asDict() for r in rows}

    def commit_marks(self, run_id: str, table_name: str, attempt: int) -> tuple[int, int, int]:
        """Last chunk logged, queue rows drawn, failures so far."""
        row = (
            self._run_rows("progress", run_id, table_name, attempt)
            .agg(
                F.max(F.when(F.col("chunk") > 0, F.col("chunk"))),
                F.sum("queue_taken"),
                F.max("failure_number"),
            )
            .first()
        )
        return tuple(v or 0 for v in row)

    def write_progress(
        self, run_id: str, table_name: str, attempt: int, chunk: int, rows: DataFrame
    ) -> None:
        """Log one chunk. This is what commits it; repeating it changes nothing."""
        spec = {"run_id": run_id, "table_name": table_name, "attempt": attempt, "chunk": chunk}
        overwrite_partition(self.spark, self.name("progress"), spec, rows)

    def queued(self, run_id: str, table_name: str, attempt: int) -> DataFrame:
        return self._run_rows("work_queue", run_id, table_name, attempt).select(S.ID, "position")

    def write_queue(self, run_id: str, table_name: str, attempt: int, rows: DataFrame) -> None:
        spec = {"run_id": run_id, "table_name": table_name, "attempt": attempt}
        overwrite_partition(self.spark, self.name("work_queue"), spec, rows)

    # -- the work of a round, and what of it is done

    def claims(self, target: str) -> Claims:
        """Claims on a target, next to the state tables."""
        folder = table_location(self.spark, self.name("progress")).rstrip("/").rsplit("/", 1)[0]
        return Claims(self.spark, f"{folder}/_claims/{quote(target, safe='.')}")

    def work(self, run_id: str, table_name: str, attempt: int, round_: int) -> DataFrame:
        rows = self._run_rows("work_list", run_id, table_name, attempt)
        return rows.where(F.col("round") == round_)

    def round(self, run_id: str, table_name: str, attempt: int, round_: int) -> dict | None:
        """What a round was listed for; None if its list is not whole."""
        rows = self._run_rows("work_rounds", run_id, table_name, attempt)
        row = rows.where(F.col("round") == round_).first()
        return row.asDict() if row else None

    def write_round(
        self, run_id: str, table_name: str, attempt: int, round_: int,
        work: DataFrame, version: int, drawn: Mapping[int, int],
    ) -> None:
        """Keep the list of a round; the row in `work_rounds` makes it valid."""
        spec = {"run_id": run_id, "table_name": table_name, "attempt": attempt, "round": round_}
        overwrite_partition(self.spark, self.name("work_list"), spec, work)
        row = self.spark.range(1).select(
            F.lit(version).cast("long").alias("version"),
            *[F.lit(drawn.get(s, 0)).cast("long").alias(f"drawn_{s}") for s in S.STEPS],
        )
        overwrite_partition(self.spark, self.name("work_rounds"), spec, row)

    def drop_work(self, run_id: str, table_name: str, attempt: int, upto: int) -> None:
        """Remove the lists of rounds that are logged."""
        columns = ("run_id", "table_name", "attempt", "round")
        for table in ("work_list", "work_rounds"):
            for place in partitions_of(self.spark, self.name(table), columns):
                if place[:3] == (run_id, table_name, str(attempt)) and int(place[3]) <= upto:
                    spec = dict(zip(columns, (run_id, table_name, attempt, int(place[3])), strict=True))
                    drop_partition(self.spark, self.name(table), spec)

    def mark_copied(
        self, run_id: str, table_name: str, attempt: int, chunk: int,
        round_: int, parts: Iterable[int], written: Mapping[int, int],
    ) -> None:
        """Commit a chunk: from here on it counts as loaded."""
        spec = {"run_id": run_id, "table_name": table_name, "attempt": attempt, "chunk": chunk}
        rows = self.spark.createDataFrame([(p,) for p in parts], "part long").select(
            F.lit(round_).alias("round"),
            "part",
            *[F.lit(written.get(s, 0)).cast("long").alias(f"written_{s}") for s in S.STEPS],
            F.lit(None).cast("int").alias("merged_chunk"),
        )
        overwrite_partition(self.spark, self.name("copied"), spec, rows)

    def copied(self, run_id: str, table_name: str, attempt: int) -> DataFrame:
        """Parts of the rounds that are committed, with their chunk."""
        rows = self._run_rows("copied", run_id, table_name, attempt)
        rows = rows.withColumn("chunk", F.coalesce("merged_chunk", "chunk")).drop("merged_chunk")
        # A mark is there twice if merging was broken off.
        return rows.distinct()

    def merge_marks(self, run_id: str, table_name: str, attempt: int) -> None:
        """Put the marks of many chunks into one partition, below those of chunks.

        The marks of the chunks go when the merged ones are there, so none is ever missing.
        """
        columns = ("run_id", "table_name", "attempt", "chunk")
        own = (run_id, table_name, str(attempt))
        places = partitions_of(self.spark, self.name("copied"), columns)
        held = [int(p[3]) for p in places if p[:3] == own]
        chunks = sorted(c for c in held if c > 0)
        if len(chunks) < FAN_IN:
            return
        run = dict(zip(columns, (run_id, table_name, attempt), strict=False))
        marks = self._run_rows("copied", run_id, table_name, attempt).where(F.col("chunk").isin(chunks))
        marks = checkpointed(marks.withColumn("merged_chunk", F.col("chunk")).coalesce(1))
        spec = run | {"chunk": min(0, *held) - 1}
        overwrite_partition(self.spark, self.name("copied"), spec, marks)
        for chunk in chunks:
            drop_partition(self.spark, self.name("copied"), run | {"chunk": chunk})

    def reset(self, run_id: str, table_name: str, now: datetime) -> int:
        """Forget the log and queue of a run of a table; loaded rows stay.

        The row in `resets` starts a new attempt, which alone hides the old
        state; removing the old rows afterwards only frees their space, so a
        failure between the two does no harm.
        """
        old = self.attempt(run_id, table_name)
        row = self.spark.range(1).select(F.lit(now).cast("timestamp_ntz").alias("reset_at"))
        spec = {"run_id": run_id, "table_name": table_name, "attempt": old + 1}
        overwrite_partition(self.spark, self.name("resets"), spec, row)
        for table in ("progress", "work_queue", "work_list", "work_rounds", "copied"):
            held = {"run_id": run_id, "table_name": table_name}
            if not self._run_rows(table, run_id, table_name, old).isEmpty():
                drop_rows(self.spark, self.name(table), held)
        return old + 1
