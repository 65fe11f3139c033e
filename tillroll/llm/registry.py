"""The queries of the operators, each over its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillroll.llm import (
    id_files, license_scan, lm_score, mixing, packing, quality, repeats, resampling, simhash, span_prints, spelling,
    token_counts, topk_search,
)
from tillroll.llm.common import table


def op1_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return quality.grade_documents(docs, quality.fit(docs, table(spark, sf_dir, "labels")))


def op2_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm_score.score_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op3_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(table(spark, sf_dir, "documents"), "byte_bpe_50k.json", end_id=1, capacity=2048)


def op4_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return mixing.mix_documents(docs, mixing.fit(docs, table(spark, sf_dir, "labels")))


def op5_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.scan(table(spark, sf_dir, "documents"), license_scan.known_digests(spark))


def op6_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.count_tokens(table(spark, sf_dir, "documents"), "byte_bpe_50k.json", limit=512)


def op7_id_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return id_files.read_ids(*id_files.write_ids(table(spark, sf_dir, "documents"), "word_bpe_49k.json", end_id=2))


def op8_span_prints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return span_prints.fingerprint_documents(table(spark, sf_dir, "documents"))


def op9_topk_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk_search.top_k(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0, k=5)


def op10_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"), shingle=4, max_bits=4)


def op11_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.group_variants(table(spark, sf_dir, "documents"), least=6, times=5, ratio=5)


def op12_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    drawn = resampling.resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), percent=5, least_words=20, seed=42)
    return drawn.select("doc_id", "n_features", "weight", "score", "rank")


def op13_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = repeats.remove_repeats(table(spark, sf_dir, "documents"), window=20)
    return kept.select("doc_id", "n_words", "n_removed", F.sha2("text", 256).alias("kept_sha256"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (
        op1_quality, op2_lm_score, op3_packing, op4_mixing, op5_license_scan, op6_token_counts, op7_id_files,
        op8_span_prints, op9_topk_search, op10_simhash, op11_spelling, op12_resampling, op13_repeats,
    )
}

# Exact integers throughout; lists end with the shorter one, as only vectors of one length are compared.
_TOPK_SQL = """
WITH v AS (
  SELECT vec_id, row_number() OVER () AS row, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS v
  FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), pairs AS (
  SELECT q.vec_id AS query_id, q.row AS query_row, c.vec_id,
         coalesce(list_sum(list_transform(range(1, len(q.v) + 1), lambda i: q.v[i] * c.v[i])), 0)::BIGINT AS score
  FROM v q JOIN v c ON len(q.v) = len(c.v) AND q.row <> c.row
  WHERE q.vec_id % 50 = 0
), ranked AS (
  SELECT query_id, row_number() OVER (PARTITION BY query_id, query_row ORDER BY score DESC, vec_id)::INTEGER AS rank, vec_id, score
  FROM pairs
)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 5
"""

ORACLE_SQL: dict[str, str] = {
    "op5_license_scan": license_scan.oracle_sql(),
    "op9_topk_search": _TOPK_SQL,
}
