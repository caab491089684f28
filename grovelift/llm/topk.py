"""Exact top-k inner products by a three-phase uniform threshold.

The columns of the vectors are cut into blocks, and each block gives every
candidate a partial score, as a node with a score list of its own would.

1. Each node gives the head of its local list. What it names is scored in full,
   which gives k real scores per query, and so a cutoff that is safe: the k-th
   best score cannot be lower.
2. The cutoff goes back to the nodes. A candidate whose partial scores all lie
   below cutoff / nodes cannot reach the cutoff; the others are collected.
3. Their missing parts are added, and the exact best k of these remain.

Queries and candidates meet in a grid of blocks with a fixed number of rows, so
that no task holds more than one block of each; a stated set of queries is
searched against all rows.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from grovelift.llm.common import checkpointed, usable_vector

K = 20
NODES = 4
QUERY_ROWS = 2048
CANDIDATE_ROWS = 8192
# Queries scored at once within a task: bounds the matrix of partial scores.
_STRIP = 128


def _matrix(column: pa.ChunkedArray, dim: int) -> np.ndarray:
    lists = column.combine_chunks()
    flat = lists.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return flat.reshape(len(lists), dim)


def _columns(dim: int, nodes: int) -> list[slice]:
    edges = np.linspace(0, dim, min(nodes, max(dim, 1)) + 1).astype(int)
    return [slice(a, b) for a, b in zip(edges[:-1], edges[1:], strict=True)]


def _partials(q: np.ndarray, x: np.ndarray, own: np.ndarray, parts: list[slice]):
    """Partial scores per node; the query's own rows are below everything."""
    scores = [q[:, p] @ x[:, p].T for p in parts]
    for s in scores:
        s[own] = -np.inf
    return scores


def _strips(queries: pa.Table, candidates: pa.Table, nodes: int):
    dim = queries["dim"][0].as_py()
    parts = _columns(dim, nodes)
    x, ids = _matrix(candidates["vector"], dim), candidates["vec_id"].to_numpy()
    q, query_ids = _matrix(queries["vector"], dim), queries["query_id"].to_numpy()
    for start in range(0, len(q), _STRIP):
        strip = slice(start, start + _STRIP)
        own = query_ids[strip, None] == ids[None, :]
        yield query_ids[strip], ids, _partials(q[strip], x, own, parts), strip


def _local_heads(k: int, nodes: int):
    def heads(_key, queries: pa.Table, candidates: pa.Table) -> pa.Table:
        out_ids, out_scores = [], []
        if queries.num_rows and candidates.num_rows:
            for query_ids, _, partial, _ in _strips(queries, candidates, nodes):
                n = min(k, partial[0].shape[1])
                named = np.concatenate(
                    [np.argpartition(-s, n - 1, axis=1)[:, :n] for s in partial], axis=1
                )
                named.sort(axis=1)
                total = np.take_along_axis(sum(partial), named, axis=1)
                # A candidate in the heads of several nodes counts once.
                total[:, 1:][named[:, 1:] == named[:, :-1]] = -np.inf
                total = -np.sort(-total, axis=1)[:, :n]
                row, column = np.nonzero(np.isfinite(total))
                out_ids.append(query_ids[row])
                out_scores.append(total[row, column])
        empty = np.zeros(0)
        ids = np.concatenate([empty, *out_ids]).astype(np.int64)
        scores = np.concatenate([empty, *out_scores]).astype(np.int64)
        return pa.table({"query_id": ids, "score": scores})

    return heads


def _above_cutoff(k: int, nodes: int):
    def collect(_key, queries: pa.Table, candidates: pa.Table) -> pa.Table:
        found = []
        if queries.num_rows and candidates.num_rows:
            # Without k known scores there is no cutoff, and everything is collected.
            cutoff = queries["cutoff"].to_numpy(zero_copy_only=False).astype(np.float64)
            cutoff = np.where(np.isnan(cutoff), -np.inf, cutoff)
            for query_ids, ids, partial, strip in _strips(queries, candidates, nodes):
                tau = cutoff[strip, None]
                reached = partial[0] * len(partial) >= tau
                for s in partial[1:]:
                    reached |= s * len(partial) >= tau
                row, column = np.nonzero(reached)
                total = sum(s[row, column] for s in partial)
                good = np.isfinite(total) & (total >= cutoff[strip][row])
                row, column, total = row[good], column[good], total[good]
                order = np.lexsort((ids[column], -total, row))
                row, column, total = row[order], column[order], total[order]
                first = np.searchsorted(row, row, side="left")
                best = np.arange(len(row)) - first < k
                found.append((query_ids[row[best]], ids[column[best]], total[best]))
        empty = (np.zeros(0, np.int64),) * 3
        q, v, s = (np.concatenate(c).astype(np.int64) for c in zip(empty, *found, strict=True))
        return pa.table({"query_id": q, "vec_id": v, "score": s})

    return collect


def exact_topk(
    candidates: DataFrame,
    queries: DataFrame,
    k: int = K,
    nodes: int = NODES,
    query_rows: int = QUERY_ROWS,
    candidate_rows: int = CANDIDATE_ROWS,
) -> DataFrame:
    """The k best candidates of each query: query_id, rank from 1, vec_id, score.

    `candidates` has `vec_id` long and `vector` array<long>, `queries` likewise;
    other columns are ignored. Scores are exact as long as they stay below 2^53.
    Ties go to the smaller vec_id. Candidates are all rows but those with the
    query's own id; a repeated row may be found repeatedly. Of queries with one
    id the smallest vector is used. Vectors meet vectors of their own length
    only, so empty ones meet empty ones, with score 0; rows without id or usable
    vector take no part. Without candidates a query has no rows.
    """
    usable = usable_vector("vector") & F.col("vec_id").isNotNull()
    vectors = candidates.where(usable).select("vec_id", "vector", F.size("vector").alias("dim"))
    asked = (
        queries.where(usable)
        .groupBy(F.col("vec_id").alias("query_id"))
        .agg(F.min("vector").alias("vector"))
        .withColumn("dim", F.size("vector"))
    )
    vectors, asked = checkpointed(vectors), checkpointed(asked)
    n_c = max(1, -(-vectors.count() // candidate_rows))
    n_q = max(1, -(-asked.count() // query_rows))

    # Blocks by position: many equal rows or ids fill all blocks alike.
    place = F.monotonically_increasing_id()
    grid_c = vectors.withColumn("cb", F.pmod(F.xxhash64(place), F.lit(n_c)).cast("int"))
    grid_c = grid_c.withColumn("qb", F.explode(F.sequence(F.lit(0), F.lit(n_q - 1))))
    block_q = F.pmod(F.xxhash64("query_id"), F.lit(n_q)).cast("int")
    cells = F.explode(F.sequence(F.lit(0), F.lit(n_c - 1)))
    keys = ("dim", "qb", "cb")

    def meet(left: DataFrame, task, schema: str) -> DataFrame:
        left = left.withColumn("qb", block_q).withColumn("cb", cells)
        return left.groupBy(*keys).cogroup(grid_c.groupBy(*keys)).applyInArrow(task, schema)

    heads = meet(asked, _local_heads(k, nodes), "query_id long, score long")
    best = Window.partitionBy("query_id").orderBy(F.desc("score"))
    cutoffs = (
        heads.withColumn("rank", F.row_number().over(best))
        .where(F.col("rank") <= k)
        .groupBy("query_id")
        .agg(F.min("score").alias("low"), F.count(F.lit(1)).alias("n"))
        .select("query_id", F.when(F.col("n") >= k, F.col("low")).alias("cutoff"))
    )
    asked = asked.join(cutoffs, "query_id", "left")
    collected = meet(asked, _above_cutoff(k, nodes), "query_id long, vec_id long, score long")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (
        collected.withColumn("rank", F.row_number().over(order))
        .where(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", "score")
    )


def quantised(embeddings: DataFrame, scale: int = 64) -> DataFrame:
    """vec_id and floor(scale * x) of each component; unusable vectors are left out."""
    whole = F.transform("embedding", lambda x: F.floor(F.lit(scale) * x.cast("double")))
    return embeddings.where(usable_vector("embedding")).select("vec_id", whole.alias("vector"))


def embedding_topk(embeddings: DataFrame, every: int = 20, k: int = K) -> DataFrame:
    """Rows whose id is divisible by `every` as queries, against all rows."""
    vectors = quantised(embeddings)
    return exact_topk(vectors, vectors.where(F.col("vec_id") % every == 0), k)
