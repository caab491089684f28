"""A corpus pipeline: language, toxicity, near duplicates, packing.

Each stage takes (spark, docs, sf_dir), where `docs` are the documents that the
stage before it kept, and returns the documents that go on; the last returns
the pieces of the packed sequences.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from grovelift.llm.common import checkpointed, table
from grovelift.llm.langid import UNDETERMINED, fit_on_folds, predict_languages
from grovelift.llm.neardup import BROADCAST_IDS, near_duplicates
from grovelift.llm.packing import pack_documents
from grovelift.llm.toxicity import fit_toxicity

TOXIC_SCORE = 0.5
# Rows that a Python worker gets at once: whole documents, some of them very long.
ROWS_PER_BATCH = 1_000


def _in_small_batches(spark: SparkSession) -> None:
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", ROWS_PER_BATCH)


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in languages that were learnt; those of which nothing can be told go.

    These are texts without a letter, and texts none of whose characters occurs
    in a learnt language (score 0). A text in several languages stays.
    """
    _in_small_batches(spark)
    predicted = predict_languages(docs, fit_on_folds(docs), docs.columns)
    told = (F.col("lang_pred") != UNDETERMINED) & (F.col("score") > 0)
    return predicted.where(told).select("row.*")


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are not toxic."""
    _in_small_batches(spark)
    model = fit_toxicity(docs, table(spark, sf_dir, "labels"))
    return model.score(docs, docs.columns).where(F.col("score") < TOXIC_SCORE).select("row.*")


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates: that with the smallest id.

    Shingles of five words, similarity 0.8. Of rows that repeat an id and text
    one stays; an id with several texts goes if none of them is kept. A row
    without id belongs to no group and stays.
    """
    _in_small_batches(spark)
    found = checkpointed(near_duplicates(docs)).where(F.col("doc_id").isNotNull())
    ids = found.groupBy("doc_id").agg(
        F.max(F.col("kept").cast("int")).alias("kept"), F.count(F.lit(1)).alias("n")
    )
    ids = checkpointed(ids.where("kept = 0 OR n > 1"))
    dropped = ids.where("kept = 0").select("doc_id")
    if dropped.count() <= BROADCAST_IDS:  # 8 bytes each; spares a shuffle of the texts
        dropped = F.broadcast(dropped)
    kept = docs.join(dropped, "doc_id", "left_anti").select(*docs.columns)
    repeated = ids.where("kept = 1 AND n > 1").select("doc_id")
    if repeated.isEmpty():
        return kept
    once = kept.join(repeated, "doc_id", "left_anti").select(*docs.columns)
    again = kept.join(repeated, "doc_id", "left_semi").select(*docs.columns)
    return once.unionByName(again.dropDuplicates(["doc_id", "text"]))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents and their places in sequences."""
    _in_small_batches(spark)
    return pack_documents(docs)


STAGES = [
    ("language", language),
    ("toxicity", toxicity),
    ("near_dedup", near_dedup),
    ("packing", packing),
]

# Trained models and a tokenizer cannot be stated in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of a folder of tables."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stage(spark, docs, sf_dir)
        if (name, stage) != STAGES[-1]:
            docs = checkpointed(docs)
    return docs
