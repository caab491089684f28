"""Moving a stored table to a key with more columns, with its rows.

The rows are written to a second folder in the layout of the wider key, and
checked there. Then the folders are switched: the old one is renamed away, which
decides that the new one counts, and the new one takes its place. What a crash
leaves behind tells how far it came, so the next call goes on from there: before
the first rename it starts over, after it the switch is finished. Renames of
folders must be whole, as they are on HDFS and local disks.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from grovelift.operators.keys import require_key
from grovelift.sources.catalog import create_table, table_path


def _default_place(spark: SparkSession, name: str) -> str:
    database, table = name.rsplit(".", 1)
    rows = spark.sql(f"DESCRIBE DATABASE {table_path(database)}").collect()
    folder = next(r["info_value"] for r in rows if r["info_name"] == "Location")
    return f"{folder.rstrip('/')}/{table}"


def _layout(files, folder) -> list[str]:
    """Names of the partition columns of a folder, from one path down; no file is read."""
    names = []
    while files.exists(folder):
        below = [f.getPath() for f in files.listStatus(folder) if f.isDirectory()]
        below = [p for p in below if "=" in p.getName()]
        if not below:
            break
        folder = below[0]
        names.append(folder.getName().split("=", 1)[0])
    return names


def _rename(files, old, new) -> None:
    if not files.rename(old, new):
        raise OSError(f"cannot rename {old} to {new}")


def _filled(rows: DataFrame, schema: T.StructType, values: Mapping[str, Any]) -> DataFrame:
    """Columns in the order of the schema; what is not there gets its value."""

    def column(field: T.StructField) -> Column:
        if field.name not in values:
            return F.col(field.name)
        value = values[field.name]
        value = value if isinstance(value, Column) else F.lit(value)
        return F.coalesce(F.col(field.name), value.cast(field.dataType)).alias(field.name)

    return rows.select(*map(column, schema.fields))


def widen_key(
    spark: SparkSession,
    name: str,
    schema: T.StructType,
    partitions: Sequence[str],
    key: Sequence[str],
    values: Mapping[str, Any],
    location: str | None = None,
) -> bool:
    """Give a stored table the columns, the partitions and the key that are stated.

    `values` has a value or a column expression for each column that the stored rows may
    lack. Returns False if the table has no rows or is in this layout already. Raises,
    with the table as it was, if the key would not be unique, or a column that needs a
    value has none. No other run may write to the table meanwhile.
    """
    place = location or _default_place(spark, name)
    path = spark._jvm.org.apache.hadoop.fs.Path
    own, narrow, wider = (path(place + end) for end in ("", "__narrow", "__wider"))
    files = own.getFileSystem(spark._jsc.hadoopConfiguration())
    if not files.exists(narrow):
        files.delete(wider, True)
        if _layout(files, own) in ([], list(partitions)):
            return False
        rows = _filled(spark.read.schema(schema).parquet(place), schema, values)
        require_key(rows, key, f"{name} with a wider key")
        required = [f.name for f in schema.fields if not f.nullable]
        counts = [F.count_if(F.col(c).isNull()).alias(c) for c in required]
        lacking = rows.agg(*counts).first().asDict()
        if any(lacking.values()):
            raise ValueError(f"{name}: {', '.join(c for c in lacking if lacking[c])} must have a value")
        rows.write.partitionBy(*partitions).parquet(wider.toString())
        moved = spark.read.schema(schema).parquet(wider.toString()).count()
        if moved != (n := rows.count()):
            raise RuntimeError(f"{name}: {n} rows became {moved} while they were moved")
        _rename(files, own, narrow)
    if files.exists(wider):
        # Dropping and making the table first: both may touch the folder of its rows.
        spark.sql(f"DROP TABLE IF EXISTS {table_path(name)}")
        files.delete(own, True)
        create_table(spark, name, schema, partitions, location)
        files.delete(own, True)
        _rename(files, wider, own)
    create_table(spark, name, schema, partitions, location)
    spark.sql(f"MSCK REPAIR TABLE {table_path(name)}")
    spark.catalog.refreshTable(table_path(name))
    files.delete(narrow, True)
    return True
