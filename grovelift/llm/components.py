"""Connected components of a graph given as pairs, as joins and minima."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from grovelift.llm.common import checkpointed, free_finished


def _minimum(edges: DataFrame) -> DataFrame:
    """Of each `u` the least of itself and its neighbours `v`."""
    return edges.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("u", "m"))


def _rows(frame: DataFrame, *rows: tuple) -> DataFrame:
    """(u, v) for each of the given pairs of columns, all from one pass over the frame."""
    pairs = [F.struct(F.col(u).alias("u"), F.col(v).alias("v")) for u, v in rows]
    return frame.select(F.explode(F.array(*pairs)).alias("e")).select("e.u", "e.v")


def _are_stars(edges: DataFrame) -> bool:
    """True if every larger end `u` has one edge and is nowhere a smaller end `v`.

    The rounds below leave such edges as they are, and come to an end only there.
    """
    larger = F.struct(F.col("u").alias("node"), F.lit(1).alias("up"), F.lit(0).alias("down"))
    smaller = F.struct(F.col("v").alias("node"), F.lit(0).alias("up"), F.lit(1).alias("down"))
    ends = edges.select(F.explode(F.array(larger, smaller)).alias("e")).select("e.*")
    nodes = ends.groupBy("node").agg(F.sum("up").alias("up"), F.max("down").alias("down"))
    return nodes.where(F.col("up") + F.col("down") > 1).where(F.col("up") > 0).isEmpty()


def components(pairs: DataFrame, first: str = "a", second: str = "b") -> DataFrame:
    """(node, component) of every node in a pair; a component is its least node.

    Alternates between linking the larger neighbours of each node to the least
    neighbour and linking each node with its smaller neighbours to the least of
    them, until every node points straight at the least of its component. A
    node with very many neighbours is combined before the shuffle.
    """
    ends = pairs.select(F.col(first).alias("u"), F.col(second).alias("v"))
    ends = ends.where(F.col("u").isNotNull() & F.col("v").isNotNull() & (F.col("u") != F.col("v")))
    # Every edge points from the larger to the smaller node.
    edges = ends.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    edges = checkpointed(edges.distinct())
    while not _are_stars(edges):
        both = _rows(edges, ("u", "v"), ("v", "u"))
        large = (
            both.join(_minimum(both), "u")
            .where(F.col("v") > F.col("u"))
            .select(F.col("v").alias("u"), F.col("m").alias("v"))
            .distinct()
        )
        near = large.join(_minimum(large), "u")
        small = _rows(near, ("v", "m"), ("u", "m")).where(F.col("u") != F.col("v")).distinct()
        edges = checkpointed(small)
        free_finished(edges.sparkSession)
    tops = edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(tops)
