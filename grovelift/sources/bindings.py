"""The sample tables seen as file trees.

Each function returns the inputs of a load. Everything is derived from the
sample tables row by row or by joins; ids are natural keys, so no shuffle is
spent on numbering rows.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from grovelift.schemas import ALLOWED_OWNER, FILE_COLUMNS, ID, OWNER, PARENT

# Rows created before this day are in the target of the order forest already.
LOADED_BEFORE = "1996-01-01"
FOREST_EXCLUDED = "O1"
FOREST_REGION = "ASIA"
CHAIN_OWNER = "user"


@dataclass
class Inputs:
    source: DataFrame
    metadata: DataFrame
    id_column: str
    allowed: DataFrame
    target: DataFrame
    excluded_id: str | None


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _file(
    id_: Column, payload: Column, name: Column, path: Column, parent: Column, at: Column, is_dir: bool
) -> list[Column]:
    given = {
        ID: id_,
        "file_stream": F.encode(payload, "utf-8"),
        "name": name,
        "path_locator": path,
        PARENT: parent,
        "is_directory": F.lit(is_dir),
        "is_archive": F.lit(not is_dir),
    }
    return [
        given.get(c, at if c.endswith("_time") else F.lit(False)).alias(c)
        for c in [*FILE_COLUMNS, PARENT]
    ]


# concat_ws is never NULL, so Spark drops the NULL tests that joins on these
# ids and paths would add, and evaluates each id once.


def _folder(key: str) -> Column:
    return F.concat_ws("/", F.lit(""), key, F.lit(""))


def order_id() -> Column:
    return F.concat_ws("", F.lit("O"), "o_orderkey")


def item_tail() -> Column:
    day = F.unix_date(F.col("l_shipdate").cast("date"))
    return F.concat_ws("-", "l_linenumber", "l_partkey", "l_suppkey", day)


def item_id() -> Column:
    return F.concat_ws("-", F.concat_ws("", F.lit("L"), "l_orderkey"), item_tail())


def forest_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as directories, their line items as the files in them."""
    folder = _folder("o_orderkey")
    orders = table(spark, sf_dir, "orders").select(
        *_file(
            order_id(), F.col("o_orderpriority"), F.col("o_orderpriority"), folder,
            F.lit(None).cast("string"), F.col("o_orderdate"), True,
        )
    )
    parent = _folder("l_orderkey")
    items = table(spark, sf_dir, "lineitem").select(
        *_file(
            item_id(), F.col("l_returnflag"), F.col("l_returnflag"),
            F.concat_ws("", parent, item_tail(), F.lit("/")), parent, F.col("l_shipdate"), False,
        )
    )
    return orders.unionByName(items)


def forest_metadata(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The nation of the customer owns an order, that of the supplier an item."""
    customer = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    supplier = table(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey")
    orders = (
        table(spark, sf_dir, "orders")
        .join(customer, F.col("o_custkey") == F.col("c_custkey"))
        .select(order_id().alias("file_id"), F.col("c_nationkey").alias(OWNER))
    )
    items = (
        table(spark, sf_dir, "lineitem")
        .join(supplier, F.col("l_suppkey") == F.col("s_suppkey"))
        .select(item_id().alias("file_id"), F.col("s_nationkey").alias(OWNER))
    )
    return orders.unionByName(items)


def forest_allowed(spark: SparkSession, sf_dir: str) -> DataFrame:
    region = table(spark, sf_dir, "region").where(F.col("r_name") == FOREST_REGION)
    nation = table(spark, sf_dir, "nation")
    return nation.join(region, F.col("n_regionkey") == F.col("r_regionkey"), "left_semi").select(
        F.col("n_nationkey").alias(ALLOWED_OWNER)
    )


def forest(spark: SparkSession, sf_dir: str, loaded: Column | None = None) -> Inputs:
    """Orders and line items; an earlier load brought what was created by then."""
    source = forest_source(spark, sf_dir)
    if loaded is None:
        loaded = F.col("creation_time") < F.lit(LOADED_BEFORE).cast("timestamp_ntz")
    return Inputs(
        source=source,
        metadata=forest_metadata(spark, sf_dir),
        id_column="file_id",
        allowed=forest_allowed(spark, sf_dir),
        target=source.where(loaded).select(*FILE_COLUMNS),
        excluded_id=FOREST_EXCLUDED,
    )


def chain(spark: SparkSession, sf_dir: str) -> Inputs:
    """Conversations as deep trees: each turn lies below the turn before it."""
    turns = table(spark, sf_dir, "conversations")
    id_ = F.concat_ws("-", "conv_id", "turn")

    def path(turn: Column) -> Column:
        return F.concat_ws("/", F.lit(""), "conv_id", turn, F.lit(""))

    parent = F.when(F.col("turn") > 0, path(F.col("turn") - 1))
    at = F.lit("2026-01-01").cast("timestamp_ntz")
    source = turns.select(
        *_file(id_, F.col("text"), F.col("role"), path(F.col("turn")), parent, at, False)
    )
    owners = turns.where(F.col("role") == CHAIN_OWNER).select(F.col("role").alias(ALLOWED_OWNER))
    return Inputs(
        source=source,
        metadata=turns.select(id_.alias("turn_id"), F.col("role").alias(OWNER)),
        id_column="turn_id",
        allowed=owners.distinct(),
        target=source.where(F.lit(False)).select(*FILE_COLUMNS),
        excluded_id=None,
    )
