from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from grovelift.llm.ann import (
    embedding_neighbours,
    fit_centroids,
    nearest_in_list,
    nearest_neighbours,
    rotation,
    unit,
)

SCHEMA = "vec_id long, vector array<double>"


def exact(ids, x, qid, q, k):
    cosine = x @ q / np.linalg.norm(x, axis=1) / np.linalg.norm(q)
    order = [i for i in np.lexsort((ids, -cosine)) if ids[i] != qid][:k]
    return [int(ids[i]) for i in order], cosine[order]


def test_recall_and_scores_on_embeddings(table):
    rows = table("embeddings").collect()
    ids = np.array([r.vec_id for r in rows])
    x = np.array([r.embedding for r in rows], float)
    got = embedding_neighbours(table("embeddings")).toPandas()
    hits = total = 0
    for qid in ids[ids % 50 == 0]:
        own = got[got.query_id == qid].sort_values("rank")
        assert own["rank"].tolist() == [1, 2, 3, 4, 5]
        at = {int(i): n for n, i in enumerate(ids)}
        q = x[at[qid]]
        for r in own.itertuples():
            v = x[at[r.vec_id]]
            assert r.score == pytest.approx(v @ q / np.linalg.norm(v) / np.linalg.norm(q), abs=1e-12)
        best, _ = exact(ids, x, qid, q, 5)
        hits, total = hits + len(set(best) & set(own.vec_id)), total + 5
    assert hits / total >= 0.95


def test_scan_abandons_and_still_finds_the_nearest():
    rng = np.random.default_rng(5)
    x = unit(rng.standard_normal((3000, 64)))
    ids, turn = np.arange(3000), rotation(64)
    assert np.allclose(turn @ turn.T, np.eye(64))
    hits = 0
    for i in range(0, 3000, 100):
        rows = nearest_in_list(x[i], x, x[i] @ turn, x @ turn, ids, i, 5)
        assert len(rows) == 5
        hits += len(set(rows) & set(exact(ids, x, i, x[i], 5)[0]))
    assert hits / 150 >= 0.97


def test_centroids_of_few_vectors():
    same = np.tile(unit(np.ones((1, 4))), (50, 1))
    assert fit_centroids(same, 8).shape == (1, 4)


def test_common_vector_and_ties(spark):
    """Half of all rows hold one vector: ties go to the smaller ids."""
    rng = np.random.default_rng(0)
    rows = [(i, [1.0, 2.0, 3.0]) for i in range(400)]
    rows += [(400 + i, rng.standard_normal(3).tolist()) for i in range(400)]
    df = spark.createDataFrame(rows, SCHEMA)
    got = nearest_neighbours(df, df.where("vec_id = 0")).collect()
    assert [r.vec_id for r in sorted(got, key=lambda r: r.rank)] == [1, 2, 3, 4, 5]
    assert all(r.score == pytest.approx(1.0) for r in got)


@pytest.mark.parametrize("dim", [64, 100, 128])
def test_ties_of_many_copies(spark, dim):
    """Copies have equal scores in every chunk and list, so the smallest ids win."""
    rng = np.random.default_rng(dim)
    common = rng.standard_normal(dim).tolist()
    rows = [(i, common) for i in range(350)]
    rows += [(1000 + i, rng.standard_normal(dim).tolist()) for i in range(300)]
    df = spark.createDataFrame(rows, SCHEMA).repartition(5)
    got = nearest_neighbours(df, df.where("vec_id in (0, 7, 300)")).collect()
    for asked in (0, 7, 300):
        own = sorted((r.rank, r.vec_id, r.score) for r in got if r.query_id == asked)
        assert [i for _, i, _ in own] == [i for i in range(7) if i != asked][:5]
        assert len({s for *_, s in own}) == 1


def test_each_length_is_searched_by_itself(spark):
    rng = np.random.default_rng(1)
    rows = [(i, rng.standard_normal(4 if i % 3 else 9).tolist()) for i in range(60)]
    df = spark.createDataFrame(rows, SCHEMA)
    got = nearest_neighbours(df, df.where("vec_id < 4"), 3).collect()
    for asked in range(4):
        same = [(i, v) for i, v in rows if len(v) == len(rows[asked][1])]
        ids, x = np.array([i for i, _ in same]), np.array([v for _, v in same])
        best, _ = exact(ids, x, asked, np.array(rows[asked][1]), 3)
        assert [r.vec_id for r in sorted(got) if r.query_id == asked] == best


def test_few_and_unusable_rows(spark):
    rows = [
        (1, [1.0, 0.0]),
        (2, [2.0, 0.1]),
        (2, [2.0, 0.1]),
        (3, [0.0, 0.0]),
        (4, None),
        (5, [float("nan"), 1.0]),
        (6, [1.0]),
        (None, [1.0, 1.0]),
        (7, [0.0, 1.0]),
    ]
    df = spark.createDataFrame(rows, SCHEMA)
    got = sorted(nearest_neighbours(df, df.where("vec_id in (1, 3, 6)"), 5).collect())
    assert [(r.query_id, r.rank, r.vec_id) for r in got] == [(1, 1, 2), (1, 2, 2), (1, 3, 7)]
    # clashing names of other columns are ignored
    for name in ("query_id", "list", "c", "q", "n_c", "rank", "score"):
        df = df.withColumn(name, F.lit("x"))
    again = nearest_neighbours(df, df.where("vec_id in (1, 3, 6)"), 5).collect()
    assert sorted(again) == got


def test_empty(spark):
    none = spark.createDataFrame([], SCHEMA)
    assert nearest_neighbours(none, none).collect() == []
    assert nearest_neighbours(none, none).columns == ["query_id", "rank", "vec_id", "score"]
    some = spark.createDataFrame([(1, [1.0])], SCHEMA)
    assert nearest_neighbours(some, none).collect() == []
    assert nearest_neighbours(some, some).collect() == []
