"""The registered queries of the operators and their SQL, as far as SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sitegauge.llm import (
    chat,
    decontaminate,
    divergence,
    languages,
    lm_scoring,
    near_dedup,
    packing,
    quality,
    repeats,
    secrets_scan,
    threshold_clusters,
    topk,
    url_filters,
)
from sitegauge.llm.common import table


def op1_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return languages.identify(table(spark, sf_dir, "documents"))


def op2_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.near_duplicates(table(spark, sf_dir, "documents"))


def op3_chat_perspectives(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat.digest(chat.perspectives(table(spark, sf_dir, "conversations")))


def op4_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    packed = packing.packed_documents(table(spark, sf_dir, "documents"))
    return packed.select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


def op5_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.score(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op6_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = url_filters.judge(table(spark, sf_dir, "pages"))
    return judged.select("page_id", "host", "path", "rule", "verdict")


def op7_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets_scan.digest(secrets_scan.scan(table(spark, sf_dir, "documents")))


def op8_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, items = table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")
    return decontaminate.digest(decontaminate.passages(docs, items))


def op9_exact_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.top_k(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0, k=5)


def op10_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm_scoring.score(table(spark, sf_dir, "documents"))


def op11_centroid_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return threshold_clusters.cluster(table(spark, sf_dir, "embeddings"))


def op12_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.audit(table(spark, sf_dir, "documents"))


def op13_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeats.without_repeats(table(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_language_id": op1_language_id,
    "op2_minhash_near_dedup": op2_minhash_near_dedup,
    "op3_chat_perspectives": op3_chat_perspectives,
    "op4_best_fit_packing": op4_best_fit_packing,
    "op5_quality_rules": op5_quality_rules,
    "op6_url_filters": op6_url_filters,
    "op7_secret_scan": op7_secret_scan,
    "op8_benchmark_decontamination": op8_benchmark_decontamination,
    "op9_exact_top_k": op9_exact_top_k,
    "op10_lm_scoring": op10_lm_scoring,
    "op11_centroid_clusters": op11_centroid_clusters,
    "op12_source_divergence": op12_source_divergence,
    "op13_suffix_array_dedup": op13_suffix_array_dedup,
}

TOP_K = """
WITH flat AS (
  SELECT vec_id, embedding FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0),
whole AS MATERIALIZED (
  SELECT vec_id, [floor(CAST(x AS DOUBLE) * 256) FOR x IN embedding] AS v FROM flat),
scored AS (
  SELECT q.vec_id AS query_id, c.vec_id, CAST(list_dot_product(q.v, c.v) AS BIGINT) AS score
  FROM whole q JOIN whole c ON q.vec_id <> c.vec_id WHERE q.vec_id % 50 = 0),
placed AS (
  SELECT query_id, vec_id, score,
         CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM scored)
SELECT query_id, rank, vec_id, score FROM placed WHERE rank <= 5"""

ORACLES: dict[str, str] = {
    "op2_minhash_near_dedup": near_dedup.ORACLE,
    "op3_chat_perspectives": chat.oracle(),
    "op6_url_filters": url_filters.oracle(),
    "op8_benchmark_decontamination": decontaminate.ORACLE,
    "op9_exact_top_k": TOP_K,
    "op11_centroid_clusters": threshold_clusters.oracle(),
    "op12_source_divergence": divergence.ORACLE,
    "op13_suffix_array_dedup": repeats.ORACLE,
}
