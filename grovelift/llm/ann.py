"""Approximate nearest neighbours by an adaptive dimension scan within probed lists.

Vectors are scaled to length 1, rotated at random and put into the list of
their nearest centroid. A query probes the lists with the nearest centroids.
Within a list it looks at the rotated columns block by block: after t of d
columns the squared distance is estimated as d / t of the partial one, and a
candidate is abandoned once even an optimistic reading of that estimate lies
beyond the k-th distance so far. Survivors get their exact cosine from the
original vectors.

Centroids, and the number of lists to probe for a target recall, are fitted to a
bounded sample; every row is indexed. Lists, and the
queries of a list, are dealt out in chunks of bounded size, so a list that
holds a third of all rows is scanned by many tasks.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from grovelift.llm.common import checkpointed, usable_vector

K = 5
SAMPLE = 20_000
MOST_LISTS = 4_096
ROWS_PER_LIST = 200
TARGET_RECALL = 0.98
TUNING_QUERIES = 512
CHUNK_ROWS = 4_096
COLUMN_BLOCK = 16
# Optimism of the test: a true neighbour is abandoned with a chance that falls
# with the square of this.
EPSILON = 2.5
_FIRST_ROWS = 64
# Rows whose products with all centroids are held at once.
_STRIP = 256
_FOUND = "query_id long, vec_id long, score double"
# Further than the rounding of a cosine of unit vectors.
_ROUNDING = 1e-9


def unit(x: np.ndarray) -> np.ndarray:
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def _strips(x: np.ndarray) -> Iterator[slice]:
    return (slice(i, i + _STRIP) for i in range(0, len(x), _STRIP))


def _nearest(x: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    """The list of each vector; strip by strip, so that no matrix grows with both sides."""
    out = np.zeros(len(x), np.int64)
    for strip in _strips(x):
        out[strip] = np.argmax(x[strip] @ centroids.T, axis=1)
    return out


def cosines(rows: np.ndarray, q: np.ndarray) -> np.ndarray:
    """Cosines with `q`, each summed within its own row in one order: equal rows give equal values."""
    lengths = np.sqrt((rows * rows).sum(axis=1)) * np.sqrt((q * q).sum())
    return (rows * q).sum(axis=1) / lengths


def rotation(dim: int, seed: int = 0) -> np.ndarray:
    """A random rotation of the space, the same in every task."""
    q, r = np.linalg.qr(np.random.default_rng(seed).standard_normal((dim, dim)))
    return q * np.sign(np.diag(r))


def fit_centroids(sample: np.ndarray, n_lists: int, rounds: int = 8, seed: int = 0) -> np.ndarray:
    """Spherical k-means of unit vectors; a list that runs empty starts at a random vector."""
    rng = np.random.default_rng(seed)
    distinct = np.unique(sample, axis=0)
    centroids = distinct[rng.permutation(len(distinct))[:n_lists]]
    for _ in range(rounds):
        nearest = _nearest(sample, centroids)
        sums = np.zeros_like(centroids)
        np.add.at(sums, nearest, sample)
        norms = np.linalg.norm(sums, axis=1)
        empty = norms < 1e-12
        sums[empty] = sample[rng.integers(0, len(sample), int(empty.sum()))]
        centroids = unit(sums)
    return centroids


def tuned_probes(sample: np.ndarray, centroids: np.ndarray, k: int) -> int:
    """How many lists must be probed to meet the target recall among the sample.

    In the whole table neighbours are nearer than in a sample of it, and so are
    their lists; the number errs on the safe side.
    """
    asked = sample[:TUNING_QUERIES]
    near = asked @ sample.T
    near[np.arange(len(asked)), np.arange(len(asked))] = -np.inf
    k = min(k, len(sample) - 1)
    if k < 1:
        return 1
    best = np.argpartition(-near, k - 1, axis=1)[:, :k]
    home = _nearest(sample, centroids)[best]
    order = np.argsort(-(asked @ centroids.T), axis=1, kind="stable")
    place = np.argsort(order, axis=1)
    needed = np.take_along_axis(place, home, axis=1) + 1
    return int(np.quantile(needed, TARGET_RECALL, method="higher"))


def _matrix(column, dim: int) -> np.ndarray:
    lists = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return lists.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, dim)


def _assign(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        centroids = shared.value
        for batch in batches:
            x = unit(_matrix(batch.column("vector"), centroids.shape[1]))
            nearest = _nearest(x, centroids).astype(np.int32)
            columns = [batch.column("vec_id"), batch.column("vector"), pa.array(nearest)]
            yield pa.RecordBatch.from_arrays(columns, ["vec_id", "vector", "list"])

    return run


def _probe(shared, probes: int, least_rows: int):
    """Lists of each query, nearest first: so many, and on until they hold enough rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        centroids, sizes = shared.value
        for batch in batches:
            x = unit(_matrix(batch.column("vector"), centroids.shape[1]))
            for strip in _strips(x):
                order = np.argsort(-(x[strip] @ centroids.T), axis=1, kind="stable")
                held = np.cumsum(sizes[order], axis=1)
                n = np.maximum(probes, (held < least_rows).sum(axis=1) + 1)
                taken = np.arange(order.shape[1])[None, :] < n[:, None]
                row, place = np.nonzero(taken & (sizes[order] > 0))
                index = pa.array(row + strip.start)
                columns = [batch.column(c).take(index) for c in ("query_id", "vector")]
                lists = pa.array(order[row, place].astype(np.int32))
                yield pa.RecordBatch.from_arrays([*columns, lists], ["query_id", "vector", "list"])

    return run


def nearest_in_list(q, x, rotated_q, rotated_x, ids, own: int, k: int):
    """Rows of a list among which the k nearest to one query are, but for abandoned ones.

    The first rows are measured in full, the others block by block of columns
    against the k-th distance that those gave. Rows as near as the k-th, within
    rounding, are all returned: the exact measure and the ids tell them apart.
    """
    others = np.flatnonzero(ids != own)
    first, rest = others[:_FIRST_ROWS], others[_FIRST_ROWS:]
    dim = len(rotated_q)
    cosine = x[first] @ q
    if len(first) >= k and len(rest):
        limit = 2 - 2 * np.partition(cosine, len(cosine) - k)[len(cosine) - k]
        partial, scanned = np.zeros(len(rest)), 0
        while scanned < dim and len(rest):
            stop = min(scanned + COLUMN_BLOCK, dim)
            step = rotated_x[rest, scanned:stop] - rotated_q[scanned:stop]
            partial += np.einsum("ij,ij->i", step, step)
            scanned = stop
            slack = 1 + EPSILON / np.sqrt(scanned) if scanned < dim else 1
            alive = partial * (dim / scanned) <= max(limit, 0) * slack * slack + 1e-9
            rest, partial = rest[alive], partial[alive]
    rows = np.concatenate([first, rest])
    cosine = np.concatenate([cosine, x[rest] @ q])
    if len(rows) <= k:
        return rows
    return rows[cosine >= np.partition(cosine, len(rows) - k)[len(rows) - k] - _ROUNDING]


def _scan(k: int):
    def run(_key, queries: pa.Table, candidates: pa.Table) -> pa.Table:
        out = []
        if queries.num_rows and candidates.num_rows:
            dim = len(queries["vector"][0])
            turn = rotation(dim)
            ids = candidates["vec_id"].to_numpy()
            order = np.argsort(ids, kind="stable")
            ids, raw = ids[order], _matrix(candidates["vector"], dim)[order]
            asked = _matrix(queries["vector"], dim)
            x, q = unit(raw), unit(asked)
            rotated_x, rotated_q = x @ turn, q @ turn
            for i, own in enumerate(queries["query_id"].to_numpy()):
                rows = nearest_in_list(q[i], x, rotated_q[i], rotated_x, ids, own, k)
                exact = cosines(raw[rows], asked[i])
                best = np.lexsort((ids[rows], -exact))[:k]
                out.append((np.full(len(best), own), ids[rows][best], exact[best]))
        if not out:
            out = [(np.zeros(0), np.zeros(0), np.zeros(0))]
        query_id, vec_id, score = (np.concatenate(c) for c in zip(*out, strict=True))
        return pa.table(
            {
                "query_id": query_id.astype(np.int64),
                "vec_id": vec_id.astype(np.int64),
                "score": score.astype(np.float64),
            }
        )

    return run


def _chunks(counts: DataFrame, name: str) -> DataFrame:
    return counts.select("list", F.ceil(F.col("n") / CHUNK_ROWS).cast("int").alias(name))


def nearest_neighbours(candidates: DataFrame, queries: DataFrame, k: int = K) -> DataFrame:
    """query_id, rank from 1, vec_id, score: the k rows found with the largest cosine.

    Both frames have `vec_id` long and `vector` array<float or double>; other
    columns are ignored. Candidates are all rows but those with the query's own
    id; a repeated row may be found repeatedly, and of queries with one id the
    smallest vector is used. Ties go to the smaller vec_id. Rows without id,
    and vectors that are null, zero or not finite throughout, take no part.
    Vectors meet vectors of their own length only; each length has an index of
    its own. With fewer than k candidates all are returned, with none there are
    no rows.
    """
    spark = candidates.sparkSession
    length = F.aggregate("vector", F.lit(0.0), lambda s, x: s + x.cast("double") * x.cast("double"))
    usable = usable_vector("vector") & F.col("vec_id").isNotNull() & (length > 0)

    def taken(rows: DataFrame) -> DataFrame:
        return rows.where(usable).select("vec_id", F.col("vector").cast("array<double>").alias("vector"))

    vectors, asked = taken(candidates), taken(queries)
    asked = asked.groupBy(F.col("vec_id").alias("query_id")).agg(F.min("vector").alias("vector"))
    dims = vectors.groupBy(F.size("vector").alias("dim")).agg(F.count(F.lit(1)).alias("n"))
    found = [spark.createDataFrame([], _FOUND)]
    for row in dims.orderBy("dim").collect():  # one row per length
        same = F.size("vector") == row["dim"]
        found.append(_found_in_lists(vectors.where(same), asked.where(same), row["n"], k))
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (
        reduce(DataFrame.unionByName, found[1:] or found)
        .withColumn("rank", F.row_number().over(order))
        .where(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", "score")
    )


def _found_in_lists(vectors: DataFrame, asked: DataFrame, total: int, k: int) -> DataFrame:
    """query_id, vec_id and score of the k best of every chunk probed; vectors of one length."""
    spark = vectors.sparkSession
    # A sample by a hash of the id, at most SAMPLE vectors.
    sample = vectors.orderBy(F.xxhash64("vec_id"), "vec_id").limit(SAMPLE).select("vector").collect()
    sample = unit(np.array([r[0] for r in sample], dtype=np.float64))
    n_lists = min(MOST_LISTS, max(1, total // ROWS_PER_LIST))
    centroids = fit_centroids(sample, n_lists)
    shared = spark.sparkContext.broadcast(centroids)
    indexed = vectors.mapInArrow(_assign(shared), "vec_id long, vector array<double>, list int")
    indexed = checkpointed(indexed)

    sizes = np.zeros(len(centroids), np.int64)
    counts = indexed.groupBy("list").agg(F.count(F.lit(1)).alias("n"))
    for r in counts.collect():  # at most MOST_LISTS rows
        sizes[r["list"]] = r["n"]
    probes = tuned_probes(sample, centroids, k)
    shared_sizes = spark.sparkContext.broadcast((centroids, sizes))
    schema = "query_id long, vector array<double>, list int"
    # Enough rows for k neighbours, the query's own row aside.
    probed = checkpointed(asked.mapInArrow(_probe(shared_sizes, probes, 4 * k + 1), schema))

    n_c = _chunks(counts, "n_c")
    n_q = _chunks(probed.groupBy("list").agg(F.count(F.lit(1)).alias("n")), "n_q")
    cells = checkpointed(n_c.join(n_q, "list"))
    place = F.xxhash64(F.monotonically_increasing_id())

    def dealt(rows: DataFrame, own: str, n_own: str, other: str, n_other: str) -> DataFrame:
        rows = rows.join(F.broadcast(cells), "list")  # one row per list
        return rows.withColumn(own, F.pmod(place, F.col(n_own)).cast("int")).withColumn(
            other, F.explode(F.sequence(F.lit(0), F.col(n_other) - 1))
        )

    keys = ("list", "c", "q")
    left = dealt(probed, "q", "n_q", "c", "n_c").select("query_id", "vector", *keys)
    right = dealt(indexed, "c", "n_c", "q", "n_q").select("vec_id", "vector", *keys)
    return left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInArrow(_scan(k), _FOUND)


def embedding_neighbours(embeddings: DataFrame, every: int = 50, k: int = K) -> DataFrame:
    """Rows whose id is divisible by `every` as queries, against all rows."""
    vectors = embeddings.select("vec_id", F.col("embedding").alias("vector"))
    return nearest_neighbours(vectors, vectors.where(F.col("vec_id") % every == 0), k)
