"""The load of one table: roots, then missing parents, then children.

A round of a load first works on narrow columns only: it finds the rows of all
open steps, numbers them in id order and keeps that list as a state table, with
the source file of each row. Rows of neighbouring files make a part, which is
copied from its files alone, with keys of its own that are broadcast; so payload
is read once and moved by no join. Some parts at a time are written as one
target partition, a chunk, and marked as copied. When all parts are, the batches
are logged in id order.

A chunk that was written but not marked does not count as loaded. A resumed run
goes on with the parts of the kept list that are not marked.

Each chunk is opened and closed by a claim on the target (`sources.claims`), so of
two runs of one table at most one commits.

Rows that reach the source while a load runs are found by the next run, or by
the same run with `settle=True`.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterable
from dataclasses import dataclass, field
from datetime import datetime
from decimal import Decimal
from functools import reduce

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from grovelift.functions import canonical_value
from grovelift.operators.batching import (
    batch_log,
    batch_of,
    counted_log,
    number_rows,
    running_total,
)
from grovelift.operators.scope import scope_ids
from grovelift.operators.sizing import (
    BROADCAST_LIMIT_BYTES,
    KEY_BYTES,
    Size,
    checkpointed,
    own_folder,
)
from grovelift.operators.steps import fetch_rows, label_rows
from grovelift.plans.config import TableConfig, load_active
from grovelift.plans.scripts import label_by_scripts
from grovelift.schemas import (
    DEFAULT_BATCH_SIZE,
    DEFAULT_EXCLUDED_ID,
    FAILED,
    FAILURE_BATCH,
    FILE,
    FILE_COLUMNS,
    ID,
    MISSING_PARENTS,
    STEPS,
)
from grovelift.sources.claims import CLOSED, OPEN, Claim, TableBusy
from grovelift.sources.files import (
    TargetTable,
    read_allowed,
    read_metadata,
    read_source,
)
from grovelift.sources.state import StateStore

_LOG_ROWS_PER_FILE = 1_000_000
# Keys of a part, as they are broadcast; one file may hold more.
PART_BYTES = BROADCAST_LIMIT_BYTES // 2
# Parts, each with its broadcast, that one job copies.
CHUNK_PARTS = 8
# Of fewer wanted rows per source file the copies are gathered into fewer files.
ROWS_PER_FILE = 10_000


@dataclass
class RunResult:
    run_id: str
    table_name: str
    rows: dict[int, int]
    """Rows loaded by this call, per step."""


@dataclass
class Options:
    batch_size: int = DEFAULT_BATCH_SIZE
    excluded_id: str | None = DEFAULT_EXCLUDED_ID
    chunk_rows: int | None = None
    scripted: bool = False
    settle: bool = False
    guid_ids: bool = False
    take_over: bool = False
    clock: Callable[[], datetime] = datetime.now

    def __post_init__(self):
        if self.batch_size < 1:
            raise ValueError("batch_size must be at least 1")
        self.excluded_id = canonical_value(self.excluded_id)


@dataclass(frozen=True)
class _Part:
    number: int
    size: Size
    files: int
    """Files that hold its rows; 0 if not all are known."""
    id_sum: Decimal


@dataclass
class _Work:
    """The list of a round: rows as (id, step, position, file, part)."""

    round: int
    version: int
    """The last claim on the target when the list was made."""
    rows: DataFrame
    drawn: dict[int, int]
    """Positions per step; of queued ids that have left the source there is no row."""
    parts: list[_Part]


@dataclass
class _Load:
    state: StateStore
    config: TableConfig
    allowed: DataFrame
    run_id: str
    attempt: int
    started_at: datetime
    options: Options
    fresh: bool = False
    """Whether the run has a new id, so that nothing of it can be there."""
    step: int = 0
    batch_started_at: datetime | None = None
    rows: dict[int, int] = field(default_factory=lambda: dict.fromkeys(STEPS, 0))

    def __post_init__(self):
        self.spark = self.state.spark
        self.run = (self.run_id, self.config.table_name, self.attempt)
        self.target = TargetTable(self.spark, self.config.target)
        self.claims = self.state.claims(self.config.target)
        self.opened: Claim | None = None
        self.unmarked: int | None = None
        """A chunk that may be written and is not marked as copied."""
        self.round = self.queue_drawn = 0
        self.marks: list[dict] = []  # one per committed part
        self.last_batch = dict.fromkeys(STEPS, 0)
        self.total = dict.fromkeys(STEPS, 0)

    def execute(self) -> None:
        open_steps = list(STEPS)
        if not self.fresh:
            self.round, self.queue_drawn, _ = self.state.commit_marks(*self.run)
            for step, row in self.state.resume_rows(*self.run).items():
                self.last_batch[step] = row["batch_number"]
                self.total[step] = row["total_rows_inserted"]
                if row["completed"]:
                    open_steps.remove(step)
            self.marks = [r.asDict() for r in self.state.copied(*self.run).collect()]

        steps, settled = set(open_steps), not open_steps
        if open_steps:
            self._enter()
        while not settled:
            self.step, self.batch_started_at = open_steps[0], self.options.clock()
            work = self._kept(self.round + 1) or self._listed(steps, self.round + 1)
            settled = not self.options.settle or not any(work.drawn.values())
            self._copy(work)
            self._log_round(work, closing=open_steps if settled else [])
            self.state.merge_marks(*self.run)
            self.state.drop_work(*self.run, upto=self.round)
            # The queue is filled once per run; arrivals are looked for by the others.
            steps.discard(MISSING_PARENTS)
            self.spark.catalog.refreshTable(self.config.source)

    # -- claims on the target

    def _enter(self) -> None:
        """See that no other run is at the target, and clear what was not committed."""
        head = self.claims.head()
        own = head.of(self.run_id, self.attempt)
        if head.kind == OPEN and not own and not self.options.take_over:
            raise TableBusy(
                f"{self.config.target} is being loaded by run {head.run_id!r}; "
                "if that run has died, resume it or pass take_over=True"
            )
        if head.kind == OPEN:
            # From here on the one that opened it cannot close it.
            self.version = head.version + 1
            if not self.claims.make(Claim(self.version, CLOSED, self.run_id, self.attempt)):
                raise TableBusy(f"{self.config.target} is being loaded by another run")
            if not own and head.run_id:
                self.target.drop_chunk(head.run_id, head.attempt, head.chunk)
        self.version = self.claims.head().version
        marked = {m["chunk"] for m in self.marks}
        for chunk in sorted(self.target.chunks(*self.run[::2]) - marked):
            self.target.drop_chunk(self.run_id, self.attempt, chunk)
        self.target.complete_ids()
        if self.target.many_ids():
            self._open()
            self.target.merge_ids()
            self._close_claim()
            self.unmarked = None

    def _open(self) -> int:
        """Claim the next chunk; it has the number of the claim."""
        claim = Claim(self.version + 1, OPEN, self.run_id, self.attempt, self.version + 1)
        if not self.claims.make(claim):
            raise TableBusy(f"another run has loaded {self.config.target} meanwhile")
        self.opened, self.version, self.unmarked = claim, claim.version, claim.chunk
        return claim.chunk

    def _close_claim(self) -> None:
        claim = Claim(self.version + 1, CLOSED, self.run_id, self.attempt, self.opened.chunk)
        if not self.claims.make(claim):
            raise TableBusy(f"another run has taken over {self.config.target}")
        self.opened, self.version = None, claim.version

    def give_up(self) -> None:
        """After an error: take away what was not committed, and let other runs in."""
        if self.unmarked is not None:
            self.target.drop_chunk(self.run_id, self.attempt, self.unmarked)
        if self.opened is not None:
            self.claims.make(Claim(self.version + 1, CLOSED, self.run_id, self.attempt))

    # -- finding rows, on narrow columns

    def _kept(self, round_: int) -> _Work | None:
        """The list of a round that was begun, so that nothing is looked for again."""
        found = None if self.fresh else self.state.round(*self.run, round_)
        if found is None:
            return None
        rows = self.state.work(*self.run, round_)
        drawn = {s: found[f"drawn_{s}"] for s in STEPS}
        return _Work(round_, found["version"], rows, drawn, self._parts(rows))

    @staticmethod
    def _parts(rows: DataFrame) -> list[_Part]:
        """One row per part; a part has the keys of a broadcast, so there are not many."""
        found = rows.groupBy("part").agg(
            *_sizes(), F.count_distinct(FILE).alias("files"), F.count_if(F.col(FILE).isNull()).alias("loose")
        )
        return [
            _Part(r["part"], Size(r["n"], r["bytes"]), 0 if r["loose"] else r["files"], r["id_sum"])
            for r in found.orderBy("part").collect()
        ]

    def _listed(self, steps: set[int], round_: int) -> _Work:
        """Find and number the rows of the steps, and keep the list."""
        rows, queued = self._find(steps)
        per_file = checkpointed(
            rows.groupBy(FILE, "step").agg(*_sizes(), F.max("split").alias("split"))
        )
        steps_found = per_file.groupBy("step").agg(
            F.sum("n").alias("n"),
            F.sum("bytes").alias("bytes"),
            F.sum("id_sum").alias("id_sum"),
            F.max("split").alias("split"),
            F.count_if(F.col(FILE).isNull()).alias("loose"),
        )
        found = steps_found.collect()  # at most one row per step
        if any(r["split"] for r in found):
            raise ValueError("the source holds several rows with one id")
        drawn = {r["step"]: r["n"] for r in found}
        if queued is not None:
            drawn[MISSING_PARENTS] = queued.count()
        elif drawn.get(MISSING_PARENTS):
            self._fill_queue(rows)

        size = Size(sum(r["n"] for r in found), sum(r["bytes"] for r in found))
        limit = PART_BYTES
        if self.options.chunk_rows and size.rows:
            limit = min(limit, max(1, self.options.chunk_rows * size.bytes // size.rows))
        one = size.bytes <= limit
        if one:
            work = rows.select(ID, "step", "position", FILE, F.lit(0).cast("long").alias("part"))
        else:
            work = self._in_parts(rows, per_file, size, limit)
        self.state.write_round(*self.run, round_, work, self.version, drawn)
        rows = self.state.work(*self.run, round_)
        if not one:
            return _Work(round_, self.version, rows, drawn, self._parts(rows))
        files = 0 if any(r["loose"] for r in found) else per_file.select(FILE).distinct().count()
        part = _Part(0, size, files, sum((r["id_sum"] for r in found), Decimal(0)))
        return _Work(round_, self.version, rows, drawn, [part] if size.rows else [])

    def _find(self, steps: set[int]) -> tuple[DataFrame, DataFrame | None]:
        """The numbered rows, and the queue that step 2 goes by if it is filled already."""
        queued = None
        if MISSING_PARENTS in steps and not self.fresh:
            queue = self.state.queued(*self.run)
            if not queue.isEmpty():
                queued = queue.where(F.col("position") > self.queue_drawn)
        labels = self._label(steps, queued)
        if queued is None:
            return number_rows(labels, within="step"), None

        labels = checkpointed(labels)
        is_queued = F.col("step") == MISSING_PARENTS
        place = (F.col("position") - self.queue_drawn).alias("position")
        rows = number_rows(labels.where(~is_queued), within="step").unionByName(
            labels.where(is_queued).join(queued, ID).select(*labels.columns, place)
        )
        return rows, queued

    @staticmethod
    def _in_parts(rows: DataFrame, per_file: DataFrame, size: Size, limit: int) -> DataFrame:
        """Rows with their part: neighbouring files whose keys can be broadcast.

        Rows whose file is not known make parts by position.
        """
        wanted = [ID, "step", "position", FILE]
        width = max(1, limit * size.rows // size.bytes)
        span = F.floor((F.col("position") - 1) / width) * (len(STEPS) + 1) + F.col("step")
        loose = rows.where(F.col(FILE).isNull())
        loose = loose.select(*wanted, (-span).cast("long").alias("part"))
        files = per_file.where(F.col(FILE).isNotNull()).groupBy(FILE).agg(F.sum("bytes").alias("bytes"))
        files = running_total(files, FILE, "bytes", "upto")
        part = F.floor((F.col("upto") - F.col("bytes")) / limit).cast("long").alias("part")
        # One row per file that holds a wanted row.
        placed = rows.join(files.select(FILE, part), FILE).select(*wanted, "part")
        return placed.unionByName(loose).repartitionByRange("part").sortWithinPartitions("part")

    def _label(self, steps: set[int], queued: DataFrame | None) -> DataFrame:
        """(id, step, file, split) of the rows that the target lacks."""
        options, config = self.options, self.config
        source, held = self._source(), self.target.held_ids()
        meta = read_metadata(
            self.spark, config.metadata, config.metadata_id_column, options.guid_ids
        )
        if options.scripted:
            frames = {"src": source, "meta": meta, "allow": self.allowed, "tgt": held}
            args = {
                "metadata_id_column": config.metadata_id_column,
                "excluded_id": options.excluded_id or "",
                "run_id": self.run_id,
                "table_name": config.table_name,
                "batch_size": options.batch_size,
            }
            frames["src"] = source.drop(FILE)
            labels = label_by_scripts(self.state, config.table_name, frames, args, steps, queued)
            files = source.groupBy(ID).agg(F.min(FILE).alias("first"), F.max(FILE).alias(FILE))
            split = F.coalesce(F.col("first") < F.col(FILE), F.lit(False)).alias("split")
            return labels.join(files, ID, "left").select(*labels.columns, FILE, split)
        scope = scope_ids(meta, self.allowed, config.metadata_id_column)
        buckets = self.target.buckets()
        return label_rows(source, scope, held, options.excluded_id, steps, queued, buckets)

    def _source(self) -> DataFrame:
        return read_source(self.spark, self.config.source, self.options.guid_ids, with_file=True)

    def _fill_queue(self, rows: DataFrame) -> None:
        now = F.lit(self.options.clock()).cast("timestamp_ntz").alias("created_at")
        queue = rows.where(F.col("step") == MISSING_PARENTS).select(ID, "position", now)
        self.state.write_queue(*self.run, queue)

    # -- copying parts

    def _copy(self, work: _Work) -> None:
        """Copy the parts that are not marked as copied, some at a time."""
        done = {m["part"] for m in self._marks(work)}
        todo = [p for p in work.parts if p.number not in done]
        while todo:
            parts, rows = [], 0
            while todo and len(parts) < CHUNK_PARTS:
                rows += todo[0].size.rows
                if parts and self.options.chunk_rows and rows > self.options.chunk_rows:
                    break
                parts.append(todo.pop(0))
            chunk = self._open()
            written = self._write_rows(work, parts, chunk)
            self._close_claim()
            self._commit(work, parts, chunk, written)
            self.unmarked = None

    def _marks(self, work: _Work) -> list[dict]:
        return [m for m in self.marks if m["round"] == work.round]

    def _commit(self, work: _Work, parts: list[_Part], chunk: int, written: dict[int, int]) -> None:
        numbers = [p.number for p in parts]
        self.state.mark_copied(*self.run, chunk, work.round, numbers, written)
        sums = {f"written_{s}": written.get(s, 0) for s in STEPS}
        self.marks += [{"round": work.round, "part": p, "chunk": chunk, **sums} for p in numbers]

    def _keys(self, work: _Work, parts: list[_Part]) -> DataFrame:
        """(id, step, batch, part) of the rows to copy."""
        step = F.col("step")
        first = F.create_map(*[F.lit(v) for s in STEPS for v in (s, self.last_batch[s])])
        batch = first[step.cast("int")] + batch_of(F.col("position"), self.options.batch_size)
        rows = work.rows.where(F.col("part").isin([p.number for p in parts]))
        if self._others_came(work):
            rows = rows.join(self.target.held_ids(), ID, "left_anti")
        return rows.select(ID, step.alias("_step"), batch.cast("int").alias("_batch"), FILE, "part")

    def _others_came(self, work: _Work) -> bool:
        """Whether other runs have loaded rows since the list was made."""
        mine = len({m["chunk"] for m in self._marks(work)})
        # Two claims per chunk of this run, and the open one. A chunk that was given
        # up has made claims too; its rows are then looked for once more.
        return self.version - work.version > 2 * mine + 1

    def _write_rows(self, work: _Work, parts: list[_Part], chunk: int) -> dict[int, int]:
        """Write the rows of some parts as a chunk; gives the rows written per step.

        Rows are looked for in the files that had them when the list was made. If
        not all are there, the whole source is searched: it may have been
        rewritten. Ids that have left the source are not written.
        """
        keys = self._keys(work, parts)
        asked = sum(p.size.rows for p in parts), sum((p.id_sum for p in parts), Decimal(0))
        if self._others_came(work):
            keys = checkpointed(keys)
            asked = tuple(keys.agg(F.count(F.lit(1)), _id_sum()).first())
        written = {}
        for in_files in (True, False):
            rows = [self._rows_of(part, keys, in_files) for part in parts]
            found = Observation()
            rows = reduce(DataFrame.unionByName, rows).observe(
                found,
                F.count(F.lit(1)).alias("n"),
                _id_sum().alias("sum"),
                *[F.count_if(F.col("_step") == s).alias(f"step_{s}") for s in STEPS],
            )
            self.target.write_chunk(self.run_id, self.attempt, chunk, rows)
            written = {s: found.get[f"step_{s}"] for s in STEPS}
            # Equal numbers and sums of ids: no id is missing and none is there twice.
            if (found.get["n"], found.get["sum"]) == asked:
                return written
        if self.target.repeated_ids(self.run_id, self.attempt, chunk).head(1):
            raise ValueError("the source holds several rows with one id")
        return written

    def _rows_of(self, part: _Part, keys: DataFrame, in_files: bool) -> DataFrame:
        own, source = keys.where(F.col("part") == part.number), self._source()
        if in_files and part.files:
            files = [r[0] for r in own.select(FILE).distinct().collect()]
            source = source.where(F.col(FILE).isin(files))
        few_per_file = part.size.rows < ROWS_PER_FILE * max(1, part.files)
        return fetch_rows(source, own.drop(FILE, "part"), part.size, even_out=few_per_file)

    # -- the progress log

    def _log_round(self, work: _Work, closing: list[int]) -> None:
        """Log the batches of a round, and close its steps if it is the last one."""
        done = {m["chunk"]: m for m in self._marks(work)}
        written = {s: sum(m[f"written_{s}"] for m in done.values()) for s in STEPS}
        chunks, log = sorted(done), []
        for step in STEPS:
            if work.drawn.get(step):
                log.append(self._log(step, work.drawn[step], written[step], chunks))
                self.last_batch[step] += -(-work.drawn[step] // self.options.batch_size)
            if step in closing:
                log.append(self._close(step, self.last_batch[step]))
        if log:
            rows = reduce(DataFrame.unionByName, log)
            files = 1 + sum(work.drawn.values()) // self.options.batch_size // _LOG_ROWS_PER_FILE
            started = self.batch_started_at
            self._log_rows(rows.coalesce(files), work.round, started, failure=0, message=None)
        self.round = work.round

    def _log(self, step: int, n_rows: int, written: int, chunks: list[int]) -> DataFrame:
        size = self.options.batch_size
        at = {"first": self.last_batch[step] + 1, "base": self.total[step]}
        if written == n_rows:
            log = batch_log(self.spark, step, n_rows, size, close=False, **at)
        else:
            counts = self.target.chunk_counts(self.run_id, self.attempt, chunks)
            counts = checkpointed(counts.where(F.col("step") == step))
            log = counted_log(counts, self.spark, step, n_rows, size, **at)
        self.total[step] += written
        self.rows[step] += written
        return log

    def _close(self, step: int, last_batch: int) -> DataFrame:
        size, total = self.options.batch_size, self.total[step]
        return batch_log(self.spark, step, 0, size, first=last_batch + 1, base=total)

    def _log_rows(self, log, chunk, started, failure, message) -> None:
        def at(value: datetime):
            return F.lit(value).cast("timestamp_ntz")

        log = log.withColumns(
            {
                "run_started_at": at(self.started_at),
                "batch_started_at": at(started),
                "batch_completed_at": at(self.options.clock()),
                "error_message": F.lit(message).cast("string"),
                "failure_number": F.lit(failure),
            }
        )
        self.state.write_progress(*self.run, chunk, log)

    def log_failure(self, error: Exception) -> None:
        """A row of its own for each failure; a resumed run does not count it as a batch."""
        number = self.state.commit_marks(*self.run)[2] + 1
        row = self.spark.range(1).select(
            F.lit(self.step).cast("short").alias("step"),
            F.lit(FAILURE_BATCH).alias("batch_number"),
            F.lit(0).cast("long").alias("rows_inserted"),
            F.lit(self.total.get(self.step, 0)).cast("long").alias("total_rows_inserted"),
            F.lit(FAILED).alias("status"),
            F.lit(0).cast("long").alias("queue_taken"),
        )
        started = self.batch_started_at or self.options.clock()
        self._log_rows(row, -number, started, failure=number, message=str(error))


def _id_sum():
    """A sum of hashes of ids that does not depend on their order."""
    return F.coalesce(F.sum(F.xxhash64(ID).cast("decimal(38,0)")), F.lit(0).cast("decimal(38,0)"))


def _sizes() -> list:
    return [
        F.count(F.lit(1)).alias("n"),
        F.sum(F.octet_length(ID) + KEY_BYTES).alias("bytes"),
        _id_sum().alias("id_sum"),
    ]


def run_table(
    state: StateStore,
    table_name: str,
    allowed: str | DataFrame,
    *,
    run_id: str | None = None,
    reset: bool = False,
    **options,
) -> RunResult:
    """Load one configured table to completion.

    `allowed` is the allow-list, as a table name or a frame. Pass the `run_id`
    of an earlier call to resume it: finished steps are skipped and an open
    step goes on after its last logged batch. `reset` forgets the log and queue
    of that run first; rows already loaded stay, and so does its start time.

    Options: `batch_size` rows per logged batch; `excluded_id`, one id that is
    never loaded (None for none); `chunk_rows`, rows per commit, about, if a run
    should be resumable in smaller pieces (groups of source files);
    `scripted` to take the steps from the stored scripts; `settle` to look again
    until no new rows arrive; `guid_ids` if ids in the tables have several
    spellings of one GUID; `take_over` to go on although another run has not
    ended, which then cannot commit any more; `clock`. The excluded id and the
    run id are taken by value, in any spelling of a GUID.

    Of two runs of one table at the same time one fails with `TableBusy`, before
    it commits.
    """
    settings = Options(**options)
    config = load_active(state, table_name)
    if reset and run_id is None:
        raise ValueError("a reset needs the id of the run to reset")
    fresh = run_id is None
    run_id = canonical_value(run_id) or str(uuid.uuid4()).upper()
    attempt, started_at = 1, None
    if not fresh:
        attempt = state.attempt(run_id, table_name)
        started_at = state.started_at(run_id, table_name, attempt)
    started_at = started_at or settings.clock()
    if reset:
        attempt = state.reset(run_id, table_name, settings.clock())
    frame = read_allowed(state.spark, allowed) if isinstance(allowed, str) else allowed
    load = _Load(state, config, frame, run_id, attempt, started_at, settings, fresh)
    try:
        with own_folder(state.spark):
            load.execute()
    except Exception as error:
        for after in (load.give_up, lambda: load.log_failure(error)):
            try:
                after()
            except Exception as second:  # the first error is the one to show
                error.add_note(f"The failure could not be logged: {second}")
        raise
    return RunResult(run_id, table_name, load.rows)


def run_all(
    state: StateStore,
    table_names: Iterable[str],
    allowed: str | DataFrame,
    *,
    run_id: str | None = None,
    **options,
) -> list[RunResult]:
    """Load several tables under one run id, each to completion before the next."""
    run_id = canonical_value(run_id) or str(uuid.uuid4()).upper()
    return [run_table(state, n, allowed, run_id=run_id, **options) for n in table_names]
