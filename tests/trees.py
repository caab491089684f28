"""Small file trees, and a database to load them in."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from grovelift.plans.config import upsert_config
from grovelift.schemas import FILE_COLUMNS, SOURCE_SCHEMA
from grovelift.sources.files import TargetTable
from grovelift.sources.state import StateStore

# id, path, parent path, owning unit ("-" means: no metadata row)
TREE = [
    ("a", "/1/", None, 1),
    ("b", "/2/", None, "-"),
    ("c", "/1/1/", "/1/", 1),
    ("d", "/2/1/", "/2/", 1),
    ("e", "/2/1/1/", "/2/1/", 1),
    ("f", "/3/1/1/", "/3/1/", 1),
    ("g", "/3/1/", "/3/", "-"),
    ("h", "/3/", None, "-"),
    ("x", "/4/", None, 1),
    ("i", "/4/1/", "/4/", 1),
    ("j", "/5/1/", "/5/", 1),
    ("k", "/5/", None, "-"),
    ("l", "/6/", None, 2),
    ("m", "/6/1/", "/6/", None),
    ("n", "/99/1/", "/99/", 1),
]
ALLOWED = [1, 3]
EXCLUDED = "x"
HELD = ["j"]

_AT = datetime(2020, 5, 17, 12, 30)


def file_row(id_, path, parent):
    flags = [False] * 7
    return (id_, f"payload of {id_}".encode(), f"name {id_}", path, _AT, _AT, _AT, *flags, parent)


def source_frame(spark: SparkSession, tree) -> DataFrame:
    return spark.createDataFrame([file_row(*node[:3]) for node in tree], SOURCE_SCHEMA)


def metadata_frame(spark: SparkSession, tree) -> DataFrame:
    rows = [(node[0], node[3]) for node in tree if node[3] != "-"]
    return spark.createDataFrame(rows, "file_id string, OwningBusinessUnit int")


def allowed_frame(spark: SparkSession, allowed) -> DataFrame:
    return spark.createDataFrame([(u,) for u in allowed], "businessunit int")


def id_frame(spark: SparkSession, ids) -> DataFrame:
    return spark.createDataFrame([(i,) for i in ids], "stream_id string")


def ids(df: DataFrame) -> list[str]:
    return sorted(r[0] for r in df.select("stream_id").collect())


class Lake:
    def __init__(self, spark: SparkSession, database: str):
        self.spark = spark
        self.database = database
        self.state = StateStore(spark, database).create()

    def name(self, table: str) -> str:
        return f"spark_catalog.{self.database}.{table}"

    def put(self, table: str, rows: DataFrame, mode: str = "overwrite") -> None:
        rows.write.mode(mode).saveAsTable(f"{self.database}.{table}")

    def config_rows(self, table: str, metadata: str = "meta") -> DataFrame:
        def place(role, name):
            return {
                f"{role}_database": "spark_catalog",
                f"{role}_schema": self.database,
                f"{role}_table": name,
            }

        row = {"table_name": table, "metadata_id_column": "file_id"}
        row |= place("source", f"{table}_src") | place("target", f"{table}_tgt")
        row |= place("metadata", f"{table}_{metadata}")
        return self.spark.range(1).select(*[F.lit(v).alias(k) for k, v in row.items()])

    def add_table(self, table: str, tree=TREE, allowed=ALLOWED, held=HELD) -> TargetTable:
        """Store a tree as the source of a configured table."""
        source = source_frame(self.spark, tree)
        self.put(f"{table}_src", source)
        self.put(f"{table}_meta", metadata_frame(self.spark, tree))
        self.put("allowed", allowed_frame(self.spark, allowed))
        upsert_config(self.state, self.config_rows(table), datetime(2026, 1, 1))
        target = TargetTable(self.spark, self.name(f"{table}_tgt")).create(id_buckets=2)
        target.load_initial(source.where(F.col("stream_id").isin(list(held))))
        return target

    def log(self, run_id: str, table: str) -> list[tuple]:
        """(step, batch, rows, total, status) of a run, in order."""
        rows = self.state.progress(run_id, table).collect()
        found = [
            (r.step, r.batch_number, r.rows_inserted, r.total_rows_inserted, r.status)
            for r in rows
        ]
        return sorted(found, key=lambda r: (r[0], r[4] == "Completed", r[1]))

    def held_columns(self, target: TargetTable) -> list[tuple]:
        rows = self.spark.table(target.name).select("stream_id", "_step", "_batch")
        return sorted(map(tuple, rows.collect()))


def copied(tree, keep) -> list[tuple]:
    """The 14 columns that a target must hold for the given ids."""
    return sorted(
        tuple(file_row(*n[:3])[: len(FILE_COLUMNS)]) for n in tree if n[0] in set(keep)
    )


