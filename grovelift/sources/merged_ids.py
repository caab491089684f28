"""Which partitions of a table of ids stand for several chunks of its target.

Each chunk of a target has a partition of ids of its own at first, with a file per
bucket. When there are `FAN_IN` of them they are written anew as one partition of level 1,
so many of these as one of level 2, and so on: an id is written once per level, and the
number of files grows with the logarithm of the number of chunks.

The list is kept in versions, of which the last one holds. A partition that it does
not name, and that is not a chunk's own, counts as not there.
"""

from __future__ import annotations

from pyspark.sql import SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from grovelift.sources.catalog import (
    create_table,
    drop_partition,
    overwrite_partition,
    partition_values,
    table_path,
)

FAN_IN = 16
# Values of the partition columns as texts: run, attempt, chunk.
Place = tuple[str, str, str]

_MERGED = "merged"
_VERSION = "version"
_FIELDS = [
    T.StructField("run_id", T.StringType()),
    *[T.StructField(c, T.IntegerType()) for c in ("attempt", "chunk", "level", "serial")],
]


def merged_place(level: int, serial: int) -> Place:
    """Where the ids of several chunks are; no run has attempts below 1."""
    return (_MERGED, str(-level), str(serial))


def level_of(place: Place) -> int:
    """0 for a chunk's own partition."""
    run_id, attempt, _ = place
    return -int(attempt) if run_id == _MERGED and int(attempt) < 0 else 0


def next_place(level: int, taken: set[Place]) -> Place:
    serials = [int(chunk) for run, attempt, chunk in taken if (run, attempt) == (_MERGED, str(-level))]
    return merged_place(level, max(serials, default=0) + 1)


class MergedIds:
    """The list of a table of ids: chunk to the partition that holds its ids."""

    def __init__(self, spark: SparkSession, ids_name: str):
        self.spark = spark
        self.name = f"{ids_name}_merged"

    def create(self, location: str | None = None) -> None:
        schema = T.StructType([*_FIELDS, T.StructField(_VERSION, T.IntegerType())])
        create_table(self.spark, self.name, schema, (_VERSION,), location)

    def _version(self) -> int:
        values = partition_values(self.spark, self.name, _VERSION)
        return max((int(v) for v in values), default=0)

    def read(self) -> dict[Place, Place]:
        """One entry per merged chunk, about as many as the target has partitions."""
        if not self.spark.catalog.tableExists(table_path(self.name)):
            return {}
        version = self._version()
        if not version:
            return {}
        rows = self.spark.table(table_path(self.name)).where(F.col(_VERSION) == version)
        return {
            (r["run_id"], str(r["attempt"]), str(r["chunk"])): merged_place(r["level"], r["serial"])
            for r in rows.collect()
        }

    def write(self, stands: dict[Place, Place]) -> None:
        """Make this the list."""
        rows = [
            (run_id, int(attempt), int(chunk), level_of(to), int(to[2]))
            for (run_id, attempt, chunk), to in sorted(stands.items())
        ]
        version = self._version() + 1
        kept = self.spark.createDataFrame(rows, T.StructType(_FIELDS)).coalesce(1)
        overwrite_partition(self.spark, self.name, {_VERSION: version}, kept)
        # The version before stays for readers that are still at it.
        for value in partition_values(self.spark, self.name, _VERSION):
            if int(value) < version - 1:
                drop_partition(self.spark, self.name, {_VERSION: int(value)})
