from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from grovelift.llm.topk import embedding_topk, exact_topk, quantised


def brute(candidates, queries, k):
    """(query_id, rank, vec_id, score) by scoring every pair."""
    out = []
    for qid, q in queries:
        scored = [
            (-int(np.dot(q, v)), vid) for vid, v in candidates if vid != qid and len(v) == len(q)
        ]
        out += [(qid, r + 1, vid, -s) for r, (s, vid) in enumerate(sorted(scored)[:k])]
    return sorted(out)


def frame(spark, rows):
    return spark.createDataFrame(rows, "vec_id long, vector array<bigint>")


@pytest.mark.parametrize("dim, spread, n", [(6, 3, 120), (1, 2, 40), (16, 50, 200)])
def test_random_vectors(spark, dim, spread, n):
    rng = np.random.default_rng(dim)
    rows = [(i, rng.integers(-spread, spread + 1, dim).tolist()) for i in range(n)]
    queries = rows[::7]
    got = exact_topk(frame(spark, rows), frame(spark, queries), 5, query_rows=6, candidate_rows=37)
    assert sorted(map(tuple, got.collect())) == brute(rows, queries, 5)


def test_ties_go_to_the_smaller_id(spark):
    rows = [(i, [1, 1]) for i in range(30)]
    got = exact_topk(frame(spark, rows), frame(spark, rows[:1]), 4, candidate_rows=8).collect()
    assert sorted((r.rank, r.vec_id, r.score) for r in got) == [(i, i, 2) for i in range(1, 5)]


def test_fewer_candidates_than_k_and_repeated_rows(spark):
    rows = [(1, [1, 0]), (2, [2, 0]), (2, [2, 0]), (3, [0, 5])]
    got = exact_topk(frame(spark, rows), frame(spark, [(1, [1, 0]), (1, [1, 0])]), 5).collect()
    assert [tuple(r) for r in sorted(got)] == [(1, 1, 2, 2), (1, 2, 2, 2), (1, 3, 3, 0)]


def test_unusable_rows_take_no_part(spark):
    rows = [(1, [1, 1]), (2, None), (None, [9, 9]), (4, [1, None]), (5, [3]), (6, [2, 2])]
    got = exact_topk(frame(spark, rows), frame(spark, rows), 3).collect()
    assert sorted(tuple(r) for r in got) == [(1, 1, 6, 4), (6, 1, 1, 4)]


def test_empty_vectors_meet_each_other(spark):
    rows = [(1, []), (2, [5]), (3, []), (4, []), (5, [2])]
    got = exact_topk(frame(spark, rows), frame(spark, rows[:2]), 2).collect()
    assert sorted(map(tuple, got)) == brute(rows, rows[:2], 2)


def test_clashing_names_are_ignored(spark):
    rows = [(i, [i, -i]) for i in range(9)]
    df = frame(spark, rows)
    for name in ("dim", "qb", "cb", "query_id", "rank", "score", "cutoff"):
        df = df.withColumn(name, F.lit("x"))
    got = exact_topk(df, df.where("vec_id < 3"), 2).collect()
    assert sorted(map(tuple, got)) == brute(rows, rows[:3], 2)


def test_empty(spark):
    none = frame(spark, [])
    assert exact_topk(none, none).collect() == []
    assert exact_topk(none, frame(spark, [(1, [1])])).collect() == []


def test_quantised(spark):
    rows = [(1, [0.5, -0.01]), (2, [float("nan"), 1.0]), (3, [float("inf"), 1.0]), (4, [None, 1.0]), (5, None)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    assert [tuple(r) for r in quantised(df).collect()] == [(1, [32, -1])]


def test_embeddings(spark, table):
    rows = table("embeddings")
    got = sorted(map(tuple, embedding_topk(rows).collect()))
    held = [(r.vec_id, np.floor(64 * np.array(r.embedding, float)).astype(int)) for r in rows.collect()]
    assert got == brute(held, [h for h in held if h[0] % 20 == 0], 20)
