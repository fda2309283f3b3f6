"""Registered queries: each operator over its whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lexiloom.llm import (
    clusters, decontaminate, html, language, mixing, near_dedup, outliers, packing, quality, secrets, substrings, toxicity, tries,
)


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def op1_robust_outliers(spark: SparkSession, sf: str) -> DataFrame:
    return outliers.robust_outliers(table(spark, sf, "documents"))


def op2_substring_dedup(spark: SparkSession, sf: str) -> DataFrame:
    done = substrings.drop_repeats(table(spark, sf, "documents"))
    return done.select("doc_id", "n_words", "n_removed", "kept_sha256")


def op3_secret_scan(spark: SparkSession, sf: str) -> DataFrame:
    return secrets.secret_report(table(spark, sf, "documents"))


def op4_near_dedup(spark: SparkSession, sf: str) -> DataFrame:
    found = near_dedup.near_duplicates(table(spark, sf, "documents"))
    return found.select("doc_id", "n_shingles", "component_id", "kept")


def op5_benchmark_decontamination(spark: SparkSession, sf: str) -> DataFrame:
    return decontaminate.contamination(table(spark, sf, "documents"), table(spark, sf, "benchmark"))


def op6_quality_classifier(spark: SparkSession, sf: str) -> DataFrame:
    return quality.score_quality(table(spark, sf, "documents"), table(spark, sf, "labels"))


def op7_toxicity(spark: SparkSession, sf: str) -> DataFrame:
    return toxicity.score_toxicity(table(spark, sf, "documents"), table(spark, sf, "labels"))


def op8_language_id(spark: SparkSession, sf: str) -> DataFrame:
    return language.language_report(table(spark, sf, "documents"))


def op9_source_mixing(spark: SparkSession, sf: str) -> DataFrame:
    mixed = mixing.mix_sources(table(spark, sf, "documents"))
    return mixed.select("doc_id", "size", "source_size", "target", "taken")


def op10_html_extraction(spark: SparkSession, sf: str) -> DataFrame:
    return html.extract_text(table(spark, sf, "pages"))


def op11_cost_packing(spark: SparkSession, sf: str) -> DataFrame:
    import public_tokenizers

    packed = packing.pack_documents(table(spark, sf, "documents"), public_tokenizers.path("word_bpe_49k.json"))
    return packed.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


def op12_prefix_trie(spark: SparkSession, sf: str) -> DataFrame:
    return tries.prefix_trie(table(spark, sf, "conversations"))


def op13_centroid_clustering(spark: SparkSession, sf: str) -> DataFrame:
    return clusters.cluster_vectors(table(spark, sf, "embeddings"))


QUERIES = {
    "op1_robust_outliers": op1_robust_outliers,
    "op2_substring_dedup": op2_substring_dedup,
    "op3_secret_scan": op3_secret_scan,
    "op4_near_dedup": op4_near_dedup,
    "op5_benchmark_decontamination": op5_benchmark_decontamination,
    "op6_quality_classifier": op6_quality_classifier,
    "op7_toxicity": op7_toxicity,
    "op8_language_id": op8_language_id,
    "op9_source_mixing": op9_source_mixing,
    "op10_html_extraction": op10_html_extraction,
    "op11_cost_packing": op11_cost_packing,
    "op12_prefix_trie": op12_prefix_trie,
    "op13_centroid_clustering": op13_centroid_clustering,
}
