"""What the physical plans must and must not hold."""

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as registered
from lexiloom.catalog import fixtures
from lexiloom.operators import dictionary, pairs, translation
from lexiloom.operators.engines import Glossary, TranslatorEngine, WordSwap
from lexiloom.sources import readers
from tests.conftest import plan_of

SF = "/root/testdata/sf0.001"

# Written out or streamed before they return; their plan is the read-back.
NARROW = [
    "sense_tag_filter",
    "dict_definitions",
    "ascii_no_han",
    "is_integer_text",
    "split_sentences",
    "chunk_words",
    "segment_markup",
    "reassemble",
    "build_prompt",
    "detect_flag",
    "filter_no_detection",
    "export_manifest",
    "asset_table",
    "with_index",
    "slice_by_index",
    "lexicon_translate",
    "translate_column",
    "translate_markup",
    "embed_text",
    "scan_split",
]


@pytest.mark.parametrize("name", NARROW)
def test_no_shuffle(spark, name):
    assert "Exchange" not in plan_of(registered.queries()[name](spark, SF))


@pytest.mark.parametrize(
    "name", ["pair_fields", "score_pairs", "dedup_pairs", "dedup_pairs_ranked", "resume_antijoin", "contiguous_prefix"]
)
def test_no_cartesian_product(spark, name):
    plan = plan_of(registered.queries()[name](spark, SF))
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan


def test_language_filter_reaches_the_scan(spark, folder):
    entries = fixtures.dictionary_entries(spark, SF).drop("doc_id")
    entries.write.parquet(f"{folder}/entries")
    stored = dictionary.select_entries(spark.read.parquet(f"{folder}/entries"))
    plan = plan_of(dictionary.definitions(stored))
    assert "EqualTo(lang_code,es)" in plan and "In(pos, [" in plan
    # Of the nested senses only what is used is read.
    assert "form_of" not in plan.split("ReadSchema")[1]


def test_split_reaches_the_scan(spark):
    plan = plan_of(readers.scan_split(spark, f"{SF}/documents.parquet", split=("lang", "es")))
    assert "PushedFilters: [IsNotNull(lang), EqualTo(lang,es)]" in plan


@pytest.mark.parametrize("together, key", [(1, "batch_id"), (100, "_group")])
def test_similar_pairs_shuffle_once(spark, together, key):
    sentences = spark.read.parquet(f"{SF}/embeddings.parquet").select(
        F.col("vec_id").alias("idx"), F.lit("t").alias("text"), "embedding"
    )
    plan = plan_of(pairs.similar_pairs(sentences, together=together))
    body = "\n".join(line for line in plan.splitlines() if "SinglePartition" not in line)
    assert body.count(f"Exchange hashpartitioning({key}") == 1
    assert body.count("Exchange") == 1


def test_sampling_is_not_repeated_by_inferred_filters(spark):
    rows = spark.read.parquet(f"{SF}/embeddings.parquet").select(F.col("vec_id").alias("idx"))
    assert plan_of(pairs.sample_pairs(rows)).count("md5(") == 10


def test_ranked_dedup_trims_before_the_shuffle(spark):
    assert plan_of(registered.queries()["dedup_pairs_ranked"](spark, SF)).count("WindowGroupLimit") == 2


@pytest.mark.parametrize("keep", ["ok", "quarantined"])
def test_a_costly_translator_runs_once_per_row(spark, keep):
    engine = TranslatorEngine(lambda: WordSwap({"a": "b"}), on_error="quarantine")
    done = translation.translate_pairs(fixtures.pair_rows(spark, SF), engine)
    assert plan_of(done.filter(F.col("status") == keep)).count("ArrowEvalPython") == 1


def test_glossary_stays_in_the_jvm(spark):
    done = translation.translate_pairs(fixtures.pair_rows(spark, SF), Glossary({"a": "b"}))
    assert "Python" not in plan_of(done)


def test_only_needed_columns_are_read(spark):
    plan = plan_of(registered.queries()["lexicon_translate"](spark, SF))
    assert "ReadSchema: struct<doc_id:bigint,text:string>" in plan
