"""Inputs that fixtures made from whole tables do not have: gaps, NULLs, broken files."""

import pytest
from pyspark.sql import functions as F

from lexiloom import session
from lexiloom.functions import names
from lexiloom.functions.vectors import batch_cosine
from lexiloom.operators import detection, engines, export, indexing, pairs, translation
from lexiloom.operators.engines import Glossary, TranslatorEngine, WordSwap
from lexiloom.plans import jobs
from lexiloom.schemas import SCORED_PAIRS
from lexiloom.sources import readers, writers
from tests.test_runs import FakeSession

NATIVE = Glossary({"the": "el"})


@pytest.fixture
def gapped(spark):
    rows = [(i, f"t{i}", [float(i), 1.0]) for i in range(39) if i not in (7, 20, 21, 22)]
    return spark.createDataFrame(rows, "idx bigint, text string, embedding array<float>")


def test_pairs_over_gapped_ids_have_their_own_texts(gapped):
    found = pairs.similar_pairs(gapped, block_size=20, partners=30).collect()
    assert len(found) == 19 * 18 // 2 + 16 * 15 // 2
    assert all((r.sentence1, r.sentence2) == (f"t{r.idx1}", f"t{r.idx2}") for r in found)
    assert all(r.idx1 // 20 == r.idx2 // 20 for r in found)


def test_sampling_by_number_refuses_gaps(gapped):
    with pytest.raises(Exception, match="without gaps"):
        pairs.sample_pairs(gapped, block_size=20).collect()


def test_missing_vectors_have_no_score(spark, gapped):
    rows = spark.createDataFrame(
        [([1.0, 0.0], [1.0, 0.0]), (None, [1.0, 0.0]), ([1.0, 0.0], None), (None, None), ([0.0, 2.0], [0.0, 1.0])],
        "a array<float>, b array<float>",
    )
    assert [r[0] for r in rows.select(batch_cosine(F.col("a"), F.col("b"))).collect()] == [1.0, None, None, None, 1.0]
    holed = gapped.withColumn("embedding", F.when(F.col("idx") % 2 == 0, F.col("embedding")))
    for r in pairs.similar_pairs(holed, block_size=20, partners=30).collect():
        assert (r.similarity is None) == (r.idx1 % 2 == 1 or r.idx2 % 2 == 1)


def test_uneven_vectors_are_an_error(spark):
    rows = spark.createDataFrame([([1.0], [1.0]), ([1.0, 2.0], [1.0])], "a array<float>, b array<float>")
    with pytest.raises(Exception, match="different lengths"):
        rows.coalesce(1).select(batch_cosine(F.col("a"), F.col("b"))).collect()


@pytest.mark.parametrize(
    "name, number",
    [
        ("/batch_7_8/out/x.parquet", 0),
        ("/batch_7_8/batch=batch_100_200/part-0.parquet", 100),
        ("/a/batch=batch_1_2/pairs_batch_30_40.parquet", 30),
        ("pairs_batch_5_9", 5),
    ],
)
def test_batch_numbers_come_from_the_end_of_the_path(value, name, number):
    assert value(names.batch_number(F.lit(name))) == number


def test_files_that_cannot_be_read_are_named(spark, folder):
    rows = spark.createDataFrame([(0, 1, 2, "a", "b", 0.5), (1, 3, 4, "c", "d", 0.5)], "batch_id long, " + SCORED_PAIRS)
    writers.write_batches(rows.coalesce(1), f"{folder}/b", size=10, gather=False)
    broken = next(p for p in __import__("pathlib").Path(folder, "b", "batch=batch_10_20").iterdir() if p.suffix == ".parquet")
    broken.write_bytes(b"no parquet")
    (found,) = readers.skipped_files(spark, f"{folder}/b", SCORED_PAIRS).collect()
    assert found.file == f"file:{broken}"
    assert jobs.consolidate(spark, f"{folder}/b", f"{folder}/csv").first().files_skipped == 1


def test_csv_keeps_outer_white_space(spark, folder):
    rows = [(1, " x"), (2, "y \t"), (3, "  "), (4, 'q" ,\n z ')]
    writers.write_csv(spark.createDataFrame(rows, "n int, t string"), f"{folder}/c")
    read = spark.read.options(**writers.CSV_READ_OPTIONS).schema("n int, t string").csv(f"{folder}/c")
    assert sorted(map(tuple, read.collect())) == rows


def test_rows_without_a_text_are_kept_and_have_a_status(spark):
    df = spark.createDataFrame([(1, "the", "x"), (2, None, "y"), (3, "", "z")], "id long, text string, more string")
    direct = translation.translate_column(df, "text", NATIVE)
    once = translation.translate_distinct(df, "text", NATIVE, "id")
    columns = ["id", "text", "more", "translation", "status", "reason"]
    assert sorted(map(tuple, once.select(columns).collect())) == sorted(map(tuple, direct.select(columns).collect()))
    table = spark.createDataFrame([("the", "el")], "word string, target string")
    found = translation.translate_by_glossary_table(df, "text", table, "id")
    assert sorted(map(tuple, found.collect())) == [(1, "el"), (2, None), (3, "")]


def test_texts_translated_once_give_the_same_rows(spark):
    class Picky:
        def translate(self, texts):
            if any("bad" in t for t in texts):
                raise engines.RowRejected("bad text")
            return [f"<{t}>" for t in texts]

    engine = TranslatorEngine(Picky, on_error="quarantine", call_size=1)
    pair = [(0, ["a", "b"]), (1, ["a", "a"]), (2, ["bad", "worse bad"]), (3, ["a"]), (4, None), (5, ["", "bad"])]
    df = spark.createDataFrame(pair, "index bigint, set array<string>")
    plain, once = (translation.translate_pairs(df, engine, distinct=d) for d in (False, True))
    assert sorted(map(repr, once.select(plain.columns).collect())) == sorted(map(repr, plain.collect()))
    sets = [(0, ("a", ["b"], ["a", None, "c"])), (1, ("a", ["b"], [])), (2, ("a", [], ["c"])), (3, ("a", ["a"], ["bad"])), (4, None)]
    df = spark.createDataFrame(sets, "index bigint, set struct<query: string, pos: array<string>, neg: array<string>>")
    plain, once = (translation.translate_triplets(df, engine, distinct=d) for d in (False, True))
    assert sorted(map(repr, once.select(plain.columns).collect())) == sorted(map(repr, plain.collect()))


def test_a_second_run_adds_nothing(spark, folder):
    texts = spark.range(4).select(F.col("id").alias("index"), F.concat(F.lit("<b>the"), "id", F.lit("</b>")).alias("text"))
    for _ in range(2):
        assert jobs.markup_corpus(texts, f"{folder}/m", NATIVE).count() == 4
    csv = spark.read.options(**writers.CSV_READ_OPTIONS).csv(f"{folder}/m/csv")
    assert [r[0] for r in csv.collect()] == [f"<b>the{i}</b>" for i in range(4)]
    asked = spark.createDataFrame([("the", "<Thought>the</Thought><Output>the</Output>")], "prompt string, response string")
    for _ in range(2):
        assert jobs.reasoning_corpus([asked], f"{folder}/r", NATIVE).count() == 1


def test_jobs_on_no_rows_give_empty_tables(spark, folder):
    none = spark.createDataFrame([], "index bigint, set array<string>")
    assert jobs.pair_corpus(none, f"{folder}/p", NATIVE).collect() == []
    some = spark.createDataFrame([(0, ["the", "the"])], none.schema)
    assert jobs.pair_corpus(some, f"{folder}/q", NATIVE, skip=5).collect() == []
    assert jobs.pair_corpus(some, f"{folder}/q", NATIVE).count() == 1
    texts = spark.createDataFrame([], "index bigint, text string")
    assert jobs.markup_corpus(texts, f"{folder}/m", NATIVE).collect() == []


def test_pairs_of_an_earlier_run_are_gone(spark, gapped, folder):
    options = {"block_size": 10, "partners": 20, "blocks_per_folder": 1}
    jobs.sentence_similarity(gapped, f"{folder}/s", **options)
    few = jobs.sentence_similarity(gapped.filter("idx < 7"), f"{folder}/s", **options)
    assert few.count() == 7 * 6 // 2


class Failing:
    def __call__(self, payload):
        raise MemoryError("no room")


def test_a_failing_detector_stops_the_job(spark):
    rows = spark.createDataFrame([("a", [b"x"])], "id string, images array<binary>")
    with pytest.raises(Exception, match="no room"):
        detection.without_detections(rows, outside=Failing).collect()


def test_paths_match_in_any_spelling(spark, tmp_path):
    (tmp_path / "han.txt").write_bytes("漢".encode())
    files = readers.scan_binary(spark, str(tmp_path), "*.txt")
    spelled = [f"{start}{tmp_path}/han.txt" for start in ("", "file:", "file://")]
    rows = spark.createDataFrame([(i, [p]) for i, p in enumerate(spelled)] + [(9, ["/absent"])], "id int, images array<string>")
    assert [r.id for r in detection.without_detections_by_path(rows, files, "id").collect()] == [9]
    assert [r.path for r in detection.paths_without_file(rows, files).collect()] == ["file:/absent"]


def test_manifest_limit_counts_numbers_by_value(spark):
    rows = spark.createDataFrame([(i, [b"x"], "p", "a", "0") for i in ("10", "2", "b")], "id string, images array<binary>, problem string, answer string, pass string")
    assert [r.id for r in export.manifest(rows, limit=2).collect()] == ["2", "10"]


def test_glossaries_of_any_size_agree(spark, monkeypatch):
    df = spark.createDataFrame([(1, "the cat"), (2, None), (3, "")], "id int, text string")
    native = df.select("id", NATIVE.text(F.col("text")).alias("t")).collect()
    monkeypatch.setattr(engines, "LITERAL_GLOSSARY", 0)
    assert df.select("id", NATIVE.text(F.col("text")).alias("t")).collect() == native


def test_dictionary_job_keeps_broken_lines(spark, folder):
    line = '{"word":"casa","lang_code":"es","pos":"noun","senses":[{"glosses":["house"]}]}'
    spark.createDataFrame([(line,), ("{no json",)], "value string").coalesce(1).write.text(f"{folder}/in")
    words, _ = jobs.dictionary_from_lines(spark, f"{folder}/in", f"{folder}/out")
    assert [tuple(r) for r in words.collect()] == [("casa", "house")]
    assert [r.corrupt for r in spark.read.parquet(f"{folder}/out/quarantine").collect()] == ["{no json"]


def test_many_files_are_numbered_without_moving_rows(spark, folder):
    spark.range(0, 500, 1, 30).write.parquet(f"{folder}/many")
    rows = indexing.read_indexed(spark, f"{folder}/many")
    assert sorted(r["index"] for r in rows.collect()) == list(range(500))
    plan = rows._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" not in plan and "Exchange hashpartitioning(id" not in plan


def test_staged_tables_go_with_their_owner(spark, folder):
    before = session.stage(spark.range(3), "kept")
    with session.staging(spark):
        session.stage(spark.range(5), "dropped").write.parquet(f"{folder}/out")
        gone = spark.sparkContext.getLocalProperty(session.OWNER)
        assert writers.exists(spark, gone)
    assert not writers.exists(spark, gone)
    assert before.count() == 3 and spark.read.parquet(f"{folder}/out").count() == 5


def test_only_a_session_on_this_machine_may_make_its_own_folder():
    for master in ("local-cluster[2,1,1024]", "localhost:7077", "yarn"):
        with pytest.raises(RuntimeError):
            session.shared_folder(FakeSession(None, master))


def test_outside_translator_of_nothing(spark):
    engine = TranslatorEngine(lambda: WordSwap({"the": "el"}))
    none = spark.createDataFrame([], "id int, text string")
    assert translation.translate_distinct(none, "text", engine, "id").collect() == []
