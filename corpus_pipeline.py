"""A corpus for training: language ID, near-dedup, decontamination, secrets, mixing.

Each stage takes (spark, docs, sf_dir) and its result is written and read again as
the next stage's documents. All but the last return the columns of documents.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from lexiloom.llm import decontaminate, language, mixing, near_dedup, secrets
from lexiloom.session import stage, staging
from lexiloom.sources.writers import write_table

# Hundredths of similarity from which on documents are near copies.
PERCENT = 80

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without documents that no language's centroids are near to.

    Null texts and texts without a letter go; equal texts stay or go together.
    """
    return language.with_known_language(docs)


def one_of_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies, of a similarity of 0.8 or more.

    Null texts and texts without words stay. Of copies that are equal in id and text
    one stays; repeated and null ids do not join what is not alike.
    """
    return near_dedup.one_of_each(docs, percent=PERCENT)


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without documents that hold a window of a benchmark item.

    Null and empty texts hold none and stay, as all do where the benchmark is empty.
    """
    return decontaminate.without_benchmark(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def masked_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with every secret masked; null and empty texts as they are."""
    return secrets.mask_secrets(docs)


def mixed_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """How many words of each document the mix takes; none of a null or empty text.

    A null source is a source of its own, null ids are rows like others.
    """
    mixed = mixing.mix_sources(docs)
    return mixed.select("doc_id", "source", "size", "source_size", "target", "taken")


STAGES: list[tuple[str, Stage]] = [
    ("language_id", known_language),
    ("near_dedup", one_of_near_copies),
    ("benchmark_decontamination", without_benchmark),
    ("secret_scan", masked_secrets),
    ("source_mixing", mixed_sources),
]


def run(spark: SparkSession, sf_dir: str, out: str | None = None) -> DataFrame:
    """The mix of the cleaned documents: how many words it takes of each.

    With ``out`` the cleaned documents are delivered as a table, ``out``/documents,
    with the mix beside them, ``out``/mix, and the tables staged on the way are
    removed; without it they stay under the shared folder, as the result reads
    them. Each stage takes nulls, empty and very long texts, ties, repeated rows and
    columns of any name as it says; no documents give no rows.
    """
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    if out is None:
        return STAGES[-1][1](spark, _cleaned(spark, docs, sf_dir), sf_dir)
    with staging(spark):
        write_table(_cleaned(spark, docs, sf_dir), f"{out}/documents")
        cleaned = spark.read.schema(docs.schema).parquet(f"{out}/documents")
        write_table(STAGES[-1][1](spark, cleaned, sf_dir), f"{out}/mix")
    return spark.read.parquet(f"{out}/mix")


def _cleaned(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    for name, step in STAGES[:-1]:
        docs = stage(step(spark, docs, sf_dir), f"pipeline-{name}")
    return docs


# Language ID is a trained model, which SQL cannot express.
ORACLE_SQL = None

QUERIES = {"pipeline": run}
SQL: dict[str, str] = {}
