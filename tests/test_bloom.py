"""The Bloom filter for key sets that are too large to broadcast."""

import pytest
from pyspark.sql import functions as F

from grovelift.operators import bloom, steps
from grovelift.operators.bloom import bloom_blocks, filter_words, maybe_in
from grovelift.operators.sizing import Size, join_by_keys
from grovelift.schemas import PARENT, PATH
from tests.test_plans import plan


def paths(spark, start, stop):
    number = F.col("id")
    return spark.range(start, stop, 1, 8).select(F.concat(F.lit("/"), number).alias("path"), number)


def test_all_keys_pass_and_few_others(spark):
    keys = paths(spark, 0, 50_000).select("path")
    rows = paths(spark, 0, 250_000)
    rows = rows.unionByName(
        spark.range(10).select(F.lit(None).cast("string").alias("path"), F.lit(-1).alias("id"))
    )
    own = F.count_if(F.col("id").between(0, 49_999)).alias("own")
    found = maybe_in(rows, keys, "path", 50_000).agg(own, F.count_if(F.col("path").isNull()), F.count("*"))
    n_own, n_null, n_all = found.first()
    assert (n_own, n_null) == (50_000, 0)
    assert n_all - n_own < 0.02 * 200_000


def test_every_word_has_its_place(spark):
    words = filter_words(3)
    blocks = bloom_blocks(paths(spark, 0, 3).select("path"), "path", words).collect()
    assert sum(len(b["_words"]) for b in blocks) == words
    assert sum(bin(w % 2**64).count("1") for b in blocks for w in b["_words"]) <= 12


def test_no_keys_let_nothing_pass(spark):
    none = paths(spark, 0, 0).select("path")
    assert maybe_in(paths(spark, 0, 1000), none, "path", 0).count() == 0


def test_size_is_bounded():
    assert 8 * filter_words(10**6) == pytest.approx(2 * 10**6, rel=0.01)
    assert 8 * filter_words(5 * 10**7) == bloom.FILTER_LIMIT_BYTES
    assert filter_words(10**9) == 0


def test_too_many_keys_leave_all_rows(spark, monkeypatch):
    monkeypatch.setattr(bloom, "FILTER_LIMIT_BYTES", 4096)
    rows, keys = paths(spark, 0, 100), paths(spark, 0, 10).select("path")
    assert maybe_in(rows, keys, "path", 10**6).count() == 100


def exchanged(df) -> int:
    """Rows that the exchange of the left side of the exact join has written."""
    df.write.format("noop").mode("overwrite").save()
    df.collect()
    node = df._jdf.queryExecution().executedPlan()
    while "SortMergeJoin" not in node.nodeName() and "ShuffledHashJoin" not in node.nodeName():
        node = node.children().head()
    node = node.children().head()
    while "Exchange" not in node.nodeName():
        node = node.children().head()
    return node.metrics().apply("shuffleRecordsWritten").value()


def test_parents_beyond_the_broadcast_limit(spark, monkeypatch):
    """A third of the files have one parent; hardly any unwanted row is shuffled."""
    monkeypatch.setattr(steps, "BROADCAST_LIMIT_BYTES", 0)
    monkeypatch.setattr(steps, "broadcast_if_small", lambda df, size: df)
    before = {}
    for key in ("autoBroadcastJoinThreshold", "adaptive.enabled"):
        before[key] = spark.conf.get(f"spark.sql.{key}")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        source = paths(spark, 0, 100_000).select(
            F.col("id").cast("string").alias("stream_id"), F.col("path").alias(PATH)
        )
        folder = F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id") % 2_000)
        scoped = spark.range(0, 30_000, 1, 8).select(F.concat(F.lit("/"), folder).alias(PARENT))
        found = steps._parents_of(source, scoped)
        assert sorted(int(r[0]) for r in found.select("stream_id").collect()) == list(range(2_000))
        # the filter is applied below the exchange by path
        text = plan(found)
        assert text.index("SortMergeJoin") < text.index("BroadcastHashJoin")
        assert 2_000 <= exchanged(found) < 2_000 + 0.02 * 98_000
    finally:
        for key, value in before.items():
            spark.conf.set(f"spark.sql.{key}", value)


def test_payload_beyond_the_hashes(spark):
    wide = paths(spark, 0, 20_000).withColumn("payload", F.repeat(F.lit("x"), 20))
    keys = paths(spark, 5_000, 9_000).select("path")
    # taken for more keys than hashes can be broadcast of
    found = join_by_keys(wide, keys, "path", Size(3_000_000, 300 * 2**20))
    assert sorted(r[0] for r in found.select("id").collect()) == list(range(5_000, 9_000))
    assert "_words" in plan(found)
