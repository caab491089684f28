from __future__ import annotations

import zlib
from collections import Counter

import numpy as np
import pytest

from grovelift.llm.sharding import (
    communication_matrix,
    draw_hypergeometric,
    shard_rows,
    sharded_documents,
)


def test_matrix_has_exact_sums():
    sizes, capacities = [5, 0, 40, 13, 2], [20, 20, 20]
    matrix = np.array(communication_matrix(sizes, capacities, seed=3))
    assert matrix.sum(axis=1).tolist() == sizes
    assert matrix.sum(axis=0).tolist() == capacities
    assert matrix.min() >= 0


def test_draws_follow_the_distribution():
    rng = np.random.default_rng(1)
    draws = np.array([draw_hypergeometric(rng, 30, 70, 20) for _ in range(4000)])
    assert abs(draws.mean() - 6.0) < 0.1
    assert abs(draws.var() - 20 * 0.3 * 0.7 * 80 / 99) < 0.3


def test_draws_of_large_populations():
    rng = np.random.default_rng(1)
    good, bad, n = 4 * 10**9, 6 * 10**9, 10**6
    draws = [draw_hypergeometric(rng, good, bad, n) for _ in range(50)]
    assert all(abs(d - 400_000) < 6 * 490 for d in draws)


@pytest.mark.parametrize("good, bad, n, value", [(0, 5, 3, 0), (5, 0, 3, 3), (4, 4, 8, 4), (3, 3, 0, 0)])
def test_forced_draws(good, bad, n, value):
    assert draw_hypergeometric(np.random.default_rng(0), good, bad, n) == value


def test_documents(spark, table):
    rows = table("documents")
    out = sharded_documents(rows, 7).toPandas()
    sizes = out.groupby("shard").size()
    assert sizes.max() - sizes.min() <= 1 and len(sizes) == 7
    for _, shard in out.groupby("shard"):
        assert sorted(shard.slot) == list(range(len(shard)))
    texts = {r.doc_id: r.text.encode() for r in rows.toLocalIterator()}
    assert sorted(out.doc_id) == sorted(texts)
    for r in out.itertuples():
        assert out.at[r.Index, "size"] == len(texts[r.doc_id]) + 16
        assert r.text_crc32 == zlib.crc32(texts[r.doc_id])


def test_the_split_into_files_does_not_matter(table):
    rows = table("documents")
    one = sharded_documents(rows, 5).collect()
    other = sharded_documents(rows.repartition(7), 5).collect()
    assert sorted(one) == sorted(other)


def test_shards_are_mixed(spark):
    """Neighbours in the input are spread over shards and places."""
    out = shard_rows(spark.range(4000), 4, min_blocks=8).toPandas().sort_values("id")
    same = (out["shard"].values[1:] == out["shard"].values[:-1]).mean()
    assert 0.2 < same < 0.3
    assert abs(np.corrcoef(out.id, out.slot)[0, 1]) < 0.06


def test_repeated_rows_nulls_and_clashing_names(spark):
    rows = spark.createDataFrame(
        [(1, "a", 9)] * 50 + [(None, None, 9)] * 5 + [(2, "", 9)], "doc_id long, text string, shard int"
    )
    out = shard_rows(rows, 8)
    assert sorted(out.columns) == ["doc_id", "shard", "slot", "text"]
    found = out.collect()
    counts = Counter(r.shard for r in found)
    assert len(found) == 56 and set(counts.values()) == {7}
    assert Counter((r.doc_id, r.text) for r in found) == {(1, "a"): 50, (None, None): 5, (2, ""): 1}


def test_null_text_has_no_bytes(documents):
    (row,) = sharded_documents(documents([(1, None)]), 3).collect()
    assert (row["size"], row["text_crc32"], row["slot"], row["grown_shard"]) == (16, 0, 0, None)


def test_empty(documents):
    assert sharded_documents(documents([]), 3).collect() == []


def test_whole_rows_move(spark):
    """Rows arrive as they were, also very long ones and ones that differ by where a null stands."""
    rows = [(1, "a", None), (1, None, "a"), (2, "long " * 200_000, "x"), (2, "", None)] + [(3, "b", "c")] * 30
    frame = spark.createDataFrame(rows, "doc_id long, text string, slot_of string")
    out = shard_rows(frame, 4).collect()
    assert Counter((r.doc_id, r.text, r.slot_of) for r in out) == Counter(rows)
    assert sorted(Counter(r.shard for r in out).values()) == [8, 8, 9, 9]
    for shard in range(4):
        slots = sorted(r.slot for r in out if r.shard == shard)
        assert slots == list(range(len(slots)))
