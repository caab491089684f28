"""The tables a load reads and the table it writes."""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterable
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from grovelift.functions import canonical_id
from grovelift.schemas import (
    ALLOWED_OWNER,
    FILE,
    FILE_COLUMNS,
    ID,
    OWNER,
    PARENT,
    TARGET_SCHEMA,
)
from grovelift.sources.catalog import (
    create_table,
    drop_partition,
    is_external,
    overwrite_partition,
    partitions_of,
    table_location,
    table_path,
)
from grovelift.sources.merged_ids import FAN_IN, MergedIds, Place, level_of, next_place

INITIAL_RUN = "initial"


def _id(column: str, guid_ids: bool):
    return (canonical_id(column) if guid_ids else F.col(column)).alias(column)


def read_source(
    spark: SparkSession, name: str, guid_ids: bool = False, with_file: bool = False
) -> DataFrame:
    """Source rows with their parent path.

    Unused columns are pruned by the plan. With `guid_ids` ids are read in one
    spelling, at the price that conditions on them do not reach the files.
    `with_file` adds the file that holds the row, null for a source that is not
    made of files; a condition on it leaves out whole files.
    """
    rows = spark.table(table_path(name))
    columns = [_id(c, guid_ids) if c == ID else F.col(c) for c in [*FILE_COLUMNS, PARENT]]
    if not with_file:
        return rows.select(*columns)
    try:
        return rows.select(*columns, F.col("_metadata.file_path").alias(FILE))
    except AnalysisException:
        return rows.select(*columns, F.lit(None).cast("string").alias(FILE))


def read_metadata(
    spark: SparkSession, name: str, id_column: str, guid_ids: bool = False
) -> DataFrame:
    return spark.table(table_path(name)).select(_id(id_column, guid_ids), OWNER)


def read_allowed(spark: SparkSession, name: str) -> DataFrame:
    return spark.table(table_path(name)).select(ALLOWED_OWNER)


class TargetTable:
    """The table that receives rows, one partition per chunk of a run.

    Next to the 14 copied columns a row keeps the step and batch that brought
    it. Readers use `rows()`.

    A second table, `<name>_ids`, holds the ids of the same partitions, bucketed
    by id: what is new is found by an anti join with it that does not move it.
    Its partitions are written after, and dropped before, those of the target;
    `complete_ids` adds what a failure in between has left out. Many partitions
    of ids are merged into few (`merge_ids`).
    """

    PARTITIONS = ("_run_id", "_attempt", "_chunk")
    ID_BUCKETS = 16

    def __init__(self, spark: SparkSession, name: str):
        self.spark = spark
        self.name = name
        self.ids_name = f"{name}_ids"
        self.merged = MergedIds(spark, self.ids_name)

    def create(self, location: str | None = None, id_buckets: int = ID_BUCKETS) -> TargetTable:
        """Create both tables unless they exist.

        `id_buckets` should grow with the target: a bucket is joined by one task,
        and some tens of millions of ids in each are a good size.
        """
        place = [
            T.StructField("_run_id", T.StringType()),
            T.StructField("_attempt", T.IntegerType()),
            T.StructField("_chunk", T.IntegerType()),
        ]
        brought = [T.StructField("_step", T.ShortType()), T.StructField("_batch", T.IntegerType())]
        schema = T.StructType([*TARGET_SCHEMA.fields, *brought, *place])
        create_table(self.spark, self.name, schema, self.PARTITIONS, location)
        ids = T.StructType([TARGET_SCHEMA[ID], *place])
        ids_location = f"{location.rstrip('/')}_ids" if location else None
        create_table(
            self.spark, self.ids_name, ids, self.PARTITIONS, ids_location, buckets=(ID, id_buckets)
        )
        self.merged.create(f"{ids_location}_merged" if ids_location else None)
        return self

    def load_initial(self, rows: DataFrame, guid_ids: bool = False) -> None:
        """Take over rows that were in the target before the first run."""
        rows = rows.select(
            *[_id(c, guid_ids) if c == ID else F.col(c) for c in FILE_COLUMNS],
            F.lit(0).cast("short").alias("_step"),
            F.lit(0).alias("_batch"),
        )
        self.write_chunk(INITIAL_RUN, 0, 0, rows)

    def rows(self) -> DataFrame:
        return self.spark.table(table_path(self.name)).select(*FILE_COLUMNS)

    def _without_open_chunks(self, run_id: str, attempt: int, chunk: int) -> DataFrame:
        own = (F.col("_run_id") == run_id) & (F.col("_attempt") == attempt)
        return self.spark.table(table_path(self.name)).where(~own | (F.col("_chunk") < chunk))

    def committed_ids(self, run_id: str, attempt: int, chunk: int) -> DataFrame:
        """Ids held, without what this attempt wrote from this chunk on.

        The condition is on partition columns, so files of those chunks are not
        even listed for the scan.
        """
        return self._without_open_chunks(run_id, attempt, chunk).select(ID)

    # -- the table of ids

    def held_ids(self) -> DataFrame:
        """Ids held, in `buckets()` partitions by id."""
        return self.spark.table(table_path(self.ids_name)).select(ID)

    def buckets(self) -> int:
        rows = self.spark.sql(f"DESCRIBE EXTENDED {table_path(self.ids_name)}").collect()
        return next(int(r["data_type"]) for r in rows if r["col_name"] == "Num Buckets")

    def complete_ids(self) -> None:
        """Make the table of ids hold the chunks of the target and no others.

        A target from before this table was kept gets it here.
        """
        if not self.spark.catalog.tableExists(table_path(self.ids_name)):
            self.create()
        chunks_in = self._chunks_in()
        listed = partitions_of(self.spark, self.ids_name, self.PARTITIONS)
        for place in sorted(listed - chunks_in.keys()):
            drop_partition(self.spark, self.ids_name, self._spec(place))
        for place in sorted(chunks_in.keys() - listed):
            self._write_ids(place, chunks_in[place])

    def many_ids(self, fan_in: int = FAN_IN) -> bool:
        """Whether `merge_ids` would find something to do."""
        levels = Counter(level_of(p) for p in self._chunks_in() if p[0] != INITIAL_RUN)
        return max(levels.values(), default=0) >= fan_in

    def merge_ids(self, fan_in: int = FAN_IN) -> None:
        """Write many small partitions of ids anew as few larger ones.

        Nobody else may write to the target meanwhile. New partitions count from when
        the list of them is kept, and what they stand for goes after that; after a
        failure `complete_ids` takes away what is too much. The rows that were there
        before the first run stay as they are.
        """
        chunks_in = self._chunks_in()
        taken, level, merged = set(chunks_in), 0, False
        while level <= max(map(level_of, chunks_in), default=0):
            of_level = [p for p in chunks_in if level_of(p) == level and p[0] != INITIAL_RUN]
            if len(of_level) >= fan_in:
                chunks = [c for p in of_level for c in chunks_in.pop(p)]
                place = next_place(level + 1, taken)
                self._write_ids(place, chunks)
                chunks_in[place], merged = chunks, True
                taken.add(place)
            level += 1
        if not merged:
            return
        stands = {c: p for p, chunks in chunks_in.items() for c in chunks if level_of(p)}
        self.merged.create(self._merged_location())
        self.merged.write(stands)
        self.complete_ids()

    def _merged_location(self) -> str | None:
        """Next to the table of ids, if that has a place of its own."""
        if not is_external(self.spark, self.ids_name):
            return None
        return table_location(self.spark, self.ids_name).rstrip("/") + "_merged"

    def _chunks_in(self) -> dict[Place, list[Place]]:
        """Partitions that the table of ids must have, with the chunks that each stands for.

        If a merged chunk has left the target, those merged with it stand for themselves.
        """
        held = partitions_of(self.spark, self.name, self.PARTITIONS)
        merged = self.merged.read()
        broken = {to for chunk, to in merged.items() if chunk not in held}
        found: dict[Place, list[Place]] = {}
        for chunk in sorted(held):
            to = merged.get(chunk, chunk)
            found.setdefault(chunk if to in broken else to, []).append(chunk)
        return found

    def _spec(self, place: Place) -> dict:
        run_id, attempt, chunk = place
        return {"_run_id": run_id, "_attempt": int(attempt), "_chunk": int(chunk)}

    def _in(self, *places: Place) -> DataFrame:
        """Rows of some chunks, by conditions on partition columns alone."""
        runs: dict[tuple[str, int], list[int]] = {}
        for run_id, attempt, chunk in places:
            runs.setdefault((run_id, int(attempt)), []).append(int(chunk))
        own = [
            (F.col("_run_id") == run_id) & (F.col("_attempt") == attempt) & F.col("_chunk").isin(chunks)
            for (run_id, attempt), chunks in runs.items()
        ]
        return self.spark.table(table_path(self.name)).where(reduce(Column.__or__, own))

    def _write_ids(self, place: Place, chunks: Iterable[Place] = ()) -> None:
        """Write the ids of a chunk, or of several, as one partition."""
        ids = self._in(*(chunks or [place])).select(ID)
        ids = ids.repartition(self.buckets(), ID)  # a file per bucket
        overwrite_partition(self.spark, self.ids_name, self._spec(place), ids)

    # -- chunks

    def chunks(self, run_id: str, attempt: int) -> set[int]:
        """Chunks of an attempt that are there, committed or not."""
        held = partitions_of(self.spark, self.name, self.PARTITIONS)
        return {int(c) for run, number, c in held if (run, int(number)) == (run_id, attempt)}

    def repeated_ids(self, run_id: str, attempt: int, chunk: int) -> DataFrame:
        """Ids of a chunk that it holds more than once."""
        ids = self._in((run_id, str(attempt), str(chunk))).groupBy(ID).agg(F.count(F.lit(1)).alias("n"))
        return ids.where(F.col("n") > 1)

    def chunk_counts(self, run_id: str, attempt: int, chunks: list[int]) -> DataFrame:
        """Rows per (step, batch) of some chunks, from two narrow columns."""
        held = (F.col("_run_id") == run_id) & (F.col("_attempt") == attempt)
        return (
            self.spark.table(table_path(self.name))
            .where(held & F.col("_chunk").isin(chunks))
            .groupBy(F.col("_step").alias("step"), F.col("_batch").alias("batch_number"))
            .agg(F.count(F.lit(1)).alias("rows_inserted"))
        )

    def write_chunk(self, run_id: str, attempt: int, chunk: int, rows: DataFrame) -> None:
        """Make `rows` the content of a chunk, first in the target, then in the table of ids."""
        place = (run_id, str(attempt), str(chunk))
        overwrite_partition(self.spark, self.name, self._spec(place), rows)
        self._write_ids(place)

    def drop_chunk(self, run_id: str, attempt: int, chunk: int) -> None:
        """Take a chunk away that was not committed."""
        place = (run_id, str(attempt), str(chunk))
        for name in (self.ids_name, self.name):
            if place in partitions_of(self.spark, name, self.PARTITIONS):
                drop_partition(self.spark, name, self._spec(place))
