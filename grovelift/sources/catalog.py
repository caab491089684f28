"""Catalog tables of plain Parquet: creating, evolving, replacing a partition."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from typing import Any
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from grovelift.functions import quoted


def table_path(name: str) -> str:
    """A dotted table name with every part quoted."""
    return quoted(*name.split("."))


def literal(value: Any) -> str:
    if isinstance(value, str):
        return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"
    return str(value).lower() if isinstance(value, bool) else str(value)


def create_table(
    spark: SparkSession,
    name: str,
    schema: T.StructType,
    partitions: Sequence[str] = (),
    location: str | None = None,
    buckets: tuple[str, int] | None = None,
) -> None:
    """Create a Parquet table unless it exists; `buckets` is a column and a number.

    With a location the files outlive the catalog: a session that finds them
    there registers their partitions again.
    """
    columns = ", ".join(f"{quoted(f.name)} {f.dataType.simpleString()}" for f in schema.fields)
    text = f"CREATE TABLE IF NOT EXISTS {table_path(name)} ({columns}) USING parquet"
    if partitions:
        text += f" PARTITIONED BY ({', '.join(quoted(p) for p in partitions)})"
    if buckets:
        text += f" CLUSTERED BY ({quoted(buckets[0])}) INTO {buckets[1]} BUCKETS"
    if location:
        text += f" LOCATION {literal(location)}"
    spark.sql(text)
    if location and partitions:
        # Appending no rows makes the folder if it is not there yet.
        empty = spark.createDataFrame([], schema)
        empty.write.mode("append").partitionBy(*partitions).parquet(location)
        spark.sql(f"MSCK REPAIR TABLE {table_path(name)}")


def add_table_column(
    spark: SparkSession, name: str, column: str, data_type: str, default: Any = None
) -> bool:
    """Add a column to a stored table unless it is there.

    Rows already stored read as the default; no file is rewritten.
    """
    if column in spark.table(table_path(name)).columns:
        return False
    text = f"ALTER TABLE {table_path(name)} ADD COLUMNS ({quoted(column)} {data_type}"
    text += f" DEFAULT {literal(default)})" if default is not None else ")"
    spark.sql(text)
    return True


def partition_values(spark: SparkSession, name: str, column: str) -> list[str]:
    """Values of one partition column, from the catalog; no file is read."""
    rows = spark.sql(f"SHOW PARTITIONS {table_path(name)}").collect()
    prefix = column + "="
    found = {p[len(prefix) :] for r in rows for p in r[0].split("/") if p.startswith(prefix)}
    return sorted(found)


def partitions_of(spark: SparkSession, name: str, columns: Sequence[str]) -> set[tuple]:
    """All partitions as tuples of the values' texts, from the catalog; no file is read."""
    rows = spark.sql(f"SHOW PARTITIONS {table_path(name)}").collect()
    found = [dict(p.split("=", 1) for p in r[0].split("/")) for r in rows]
    return {tuple(unquote(values[c]) for c in columns) for values in found}


def table_location(spark: SparkSession, name: str) -> str:
    rows = spark.sql(f"DESCRIBE EXTENDED {table_path(name)}").collect()
    return next(r["data_type"] for r in rows if r["col_name"] == "Location")


def overwrite_partition(
    spark: SparkSession, name: str, partition: Mapping[str, Any], rows: DataFrame
) -> None:
    """Make `rows` the content of one partition, replacing what a failed write left.

    The static form also clears the partition when `rows` is empty, which
    dynamic overwriting would not.
    """
    spec = ", ".join(f"{quoted(k)} = {literal(v)}" for k, v in partition.items())
    columns = [c for c in spark.table(table_path(name)).columns if c not in partition]
    spark.sql(
        f"INSERT OVERWRITE TABLE {table_path(name)} PARTITION ({spec}) "
        f"SELECT {', '.join(quoted(c) for c in columns)} FROM {{rows}}",
        rows=rows,
    )


def drop_rows(spark: SparkSession, name: str, partition: Mapping[str, Any]) -> None:
    """Remove all partitions below a prefix of the partition columns.

    Tables with a location are external to Spark, which leaves their files to others;
    so folders of partitions are removed here.
    """
    spec = ", ".join(f"{quoted(k)} = {literal(v)}" for k, v in partition.items())
    if not is_external(spark, name):
        spark.sql(f"TRUNCATE TABLE {table_path(name)} PARTITION ({spec})")
        return
    location = table_location(spark, name).rstrip("/")
    path = spark._jvm.org.apache.hadoop.fs.Path
    for row in spark.sql(f"SHOW PARTITIONS {table_path(name)} PARTITION ({spec})").collect():
        folder = path(f"{location}/{row[0]}")
        folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)
    spark.catalog.refreshTable(table_path(name))


def is_external(spark: SparkSession, name: str) -> bool:
    rows = spark.sql(f"DESCRIBE EXTENDED {table_path(name)}").collect()
    return any(r["col_name"] == "Type" and r["data_type"] == "EXTERNAL" for r in rows)


def drop_partition(spark: SparkSession, name: str, partition: Mapping[str, Any]) -> None:
    """Remove one partition, its files and its entry in the catalog."""
    drop_rows(spark, name, partition)
    spec = ", ".join(f"{quoted(k)} = {literal(v)}" for k, v in partition.items())
    spark.sql(f"ALTER TABLE {table_path(name)} DROP IF EXISTS PARTITION ({spec})")
