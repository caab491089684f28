"""Registered queries: their SQL, their columns and the pipeline."""

from __future__ import annotations

import duckdb
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as driver
import corpus_pipeline
from grovelift.llm.common import checkpointed
from grovelift.llm.langid import fit_on_folds, predict_languages
from grovelift.llm.queries import ORACLES, QUERIES
from grovelift.llm.toxicity import fit_toxicity
from tests.llm.test_neardup import brute
from tests.test_queries import TABLES, normal


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_against_sql(spark, sf_dir, name):
    connection = duckdb.connect()
    for t in TABLES.split():
        connection.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    expected = connection.execute(ORACLES[name]).df()
    got = QUERIES[name](spark, sf_dir).toPandas()
    assert len(got) > 0 and normal(got).equals(normal(expected))


def test_registered():
    numbers = {int(name[2:].split("_")[0]) for name in QUERIES}
    assert numbers == set(range(1, 14)) and len(QUERIES) == 13
    assert set(QUERIES) | {"pipeline"} <= set(driver.queries())


@pytest.fixture(scope="module")
def staged(spark):
    """What each stage of the pipeline gets and gives, at a scale with enough labels."""
    sf_dir = "/root/testdata/sf0.01"
    docs, out = spark.read.parquet(f"{sf_dir}/documents.parquet"), []
    for name, stage in corpus_pipeline.STAGES:
        given, docs = docs, checkpointed(stage(spark, docs, sf_dir))
        out.append((name, given, docs))
    return sf_dir, out


def test_stages_keep_the_columns_and_take_rows_away(staged):
    _, stages = staged
    assert [name for name, *_ in stages] == ["language", "toxicity", "near_dedup", "packing"]
    for _, given, docs in stages[:-1]:
        assert docs.schema.names == given.schema.names
        assert docs.exceptAll(given).count() == 0


def test_each_stage_against_its_decisions(spark, staged):
    """The rows that a stage gives follow from its own decisions on the rows it got."""
    sf_dir, stages = staged
    (_, given, docs) = stages[0]
    found = predict_languages(given, fit_on_folds(given), ["doc_id"]).select("row.*", "lang_pred", "score").collect()
    assert {r.doc_id for r in docs.collect()} == {r.doc_id for r in found if r.lang_pred != "und" and r.score > 0}
    (_, given, docs) = stages[1]
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    found = fit_toxicity(given, labels).score(given, ["doc_id"]).select("row.*", "score").collect()
    assert {r.doc_id for r in docs.collect()} == {r.doc_id for r in found if r.score < 0.5}
    assert docs.count() < given.count()
    (_, given, docs) = stages[2]
    rows = [(r.doc_id, r.text) for r in given.collect()]
    assert {r.doc_id for r in docs.collect()} == {i for i, _, _, kept in brute(rows, 5, 80) if kept}
    (_, given, docs) = stages[3]
    pieces = docs.groupBy("doc_id").agg(F.sum("length").alias("n"), F.max("doc_tokens").alias("m")).collect()
    assert {r.doc_id for r in pieces} == {r.doc_id for r in given.collect()}
    assert all(r.n == r.m for r in pieces)


def test_run_is_the_stages_in_order(spark, staged):
    sf_dir, stages = staged
    last = stages[-1][2].select("doc_id", "start", "length", "ids_crc32")
    got = corpus_pipeline.run(spark, sf_dir).select(*last.columns)
    assert sorted(got.collect()) == sorted(last.collect())


def test_stages_with_odd_rows(spark, documents, sf_dir):
    """Nulls, repeats, empty texts and columns with names that stages use themselves."""
    some = spark.read.parquet(f"{sf_dir}/documents.parquet").limit(60)
    rows = documents([(10_001, None), (10_002, ""), (None, "the and of " * 9), (10_003, "the and of it to")] * 2)
    odd = some.unionByName(rows)
    for name in ("score", "features", "row", "kept", "lang_pred", "margin", "n", "digest"):
        odd = odd.withColumn(name, F.lit(1))
    docs = odd
    for name, stage in corpus_pipeline.STAGES:
        docs = checkpointed(stage(spark, docs, sf_dir))
        if name != "packing":
            assert docs.columns == odd.columns
        if name == "near_dedup":
            held = [r.doc_id for r in docs.select("doc_id").collect()]
            assert len([i for i in held if i is not None]) == len({i for i in held if i is not None})
            assert held.count(None) == 2  # rows without id stay
    empty = odd.limit(0)
    for name, stage in corpus_pipeline.STAGES:
        empty = checkpointed(stage(spark, empty, sf_dir))
        assert empty.count() == 0
