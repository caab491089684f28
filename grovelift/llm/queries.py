"""One query per operator of this package, over its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from grovelift.llm.ann import embedding_neighbours
from grovelift.llm.common import table
from grovelift.llm.divergence import oracle_sql as divergence_sql
from grovelift.llm.divergence import source_divergence
from grovelift.llm.langid import identify_languages
from grovelift.llm.licenses import oracle_sql as license_sql
from grovelift.llm.licenses import scan_licenses
from grovelift.llm.merkle import audited_manifest
from grovelift.llm.merkle import oracle_sql as merkle_sql
from grovelift.llm.neardup import near_duplicates
from grovelift.llm.outliers import judge_documents
from grovelift.llm.packing import packed_sequences, piece_digests
from grovelift.llm.quality import classify_quality
from grovelift.llm.sentencepiece_codec import encoded_digests
from grovelift.llm.sharding import sharded_documents
from grovelift.llm.topk import embedding_topk
from grovelift.llm.toxicity import classify_toxicity

Query = Callable[[SparkSession, str], DataFrame]


def op1_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encoded_digests(table(spark, sf_dir, "documents"))


def op2_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharded_documents(table(spark, sf_dir, "documents"))


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return classify_toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op4_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan_licenses(table(spark, sf_dir, "documents"))


def op5_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"), words=3, percent=85)


def op6_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_neighbours(table(spark, sf_dir, "embeddings"))


def op7_exact_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_topk(table(spark, sf_dir, "embeddings"))


def op8_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return piece_digests(packed_sequences(table(spark, sf_dir, "documents")))


def op9_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return identify_languages(table(spark, sf_dir, "documents"))


def op10_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return classify_quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op11_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audited_manifest(table(spark, sf_dir, "documents"))


def op12_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return source_divergence(table(spark, sf_dir, "documents"))


def op13_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge_documents(table(spark, sf_dir, "documents"))


QUERIES: dict[str, Query] = {
    f.__name__: f
    for f in (
        op1_sentencepiece,
        op2_sharding,
        op3_toxicity,
        op4_license_scan,
        op5_minhash,
        op6_nearest_neighbours,
        op7_exact_topk,
        op8_packing,
        op9_language_id,
        op10_quality,
        op11_merkle_manifest,
        op12_source_divergence,
        op13_quality_rules,
    )
}

ORACLES: dict[str, str] = {
    "op4_license_scan": license_sql(),
    "op5_minhash": r"""
        WITH RECURSIVE words AS MATERIALIZED (
          SELECT doc_id, [x FOR x IN string_split_regex(
                   translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                             'abcdefghijklmnopqrstuvwxyz'),
                   '[\x20\x09-\x0D]+') IF x <> ''] AS w
          FROM documents
        ), sets AS MATERIALIZED (
          SELECT doc_id, list_distinct(CASE
                   WHEN len(w) >= 3
                   THEN [w[i] || ' ' || w[i + 1] || ' ' || w[i + 2]
                         FOR i IN range(1, len(w) - 1)]
                   WHEN len(w) > 0 THEN [array_to_string(w, ' ')]
                   ELSE [] END) AS items
          FROM words
        ), items AS MATERIALIZED (
          SELECT doc_id, len(items) AS n, unnest(items) AS item FROM sets
        ), links AS MATERIALIZED (
          SELECT a.doc_id AS x, b.doc_id AS y
          FROM items AS a JOIN items AS b ON a.item = b.item AND a.doc_id <> b.doc_id
          GROUP BY a.doc_id, b.doc_id, a.n, b.n
          HAVING count(*) * 100 >= (a.n + b.n - count(*)) * 85
        ), reach AS (
          SELECT doc_id, doc_id AS other FROM sets
          UNION
          SELECT reach.doc_id, links.y FROM reach JOIN links ON reach.other = links.x
        ), least AS (SELECT doc_id, min(other) AS component_id FROM reach GROUP BY doc_id)
        SELECT doc_id, len(items)::BIGINT AS n_shingles, component_id,
               doc_id = component_id AS kept
        FROM sets JOIN least USING (doc_id)
    """,
    "op7_exact_topk": """
        WITH v AS MATERIALIZED (
          SELECT vec_id, [floor(64 * x::DOUBLE) FOR x IN embedding] AS e
          FROM embeddings
          WHERE embedding IS NOT NULL AND vec_id IS NOT NULL
            AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0
        ), scored AS (
          SELECT q.vec_id AS query_id, v.vec_id,
                 CASE WHEN len(q.e) = 0 THEN 0 ELSE list_inner_product(q.e, v.e) END::BIGINT
                   AS score
          FROM v AS q JOIN v ON q.vec_id % 20 = 0 AND q.vec_id <> v.vec_id
                            AND len(q.e) = len(v.e)
        ), ranked AS (
          SELECT *, row_number() OVER (
            PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank
          FROM scored
        )
        SELECT query_id, rank::INT AS rank, vec_id, score FROM ranked WHERE rank <= 20
    """,
    "op11_merkle_manifest": merkle_sql(),
    "op12_source_divergence": divergence_sql(),
}
