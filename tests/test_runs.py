import threading

import pytest
from pyspark.sql import functions as F

from lexiloom import session
from lexiloom.operators import indexing, translation
from lexiloom.operators.engines import Glossary, TranslatorEngine, WordSwap
from lexiloom.plans import jobs
from lexiloom.streaming.incremental import follow, run_incremental, run_to_end

WORDS = {"the": "el"}
NATIVE = Glossary(WORDS)
LIMITED = TranslatorEngine(lambda: WordSwap(WORDS, 3), on_error="quarantine")


def paq(spark, n=12):
    words = F.array_join(F.array_repeat(F.lit("the"), (F.col("id") % 5 + 1).cast("int")), " ")
    return spark.range(n).select(F.col("id").alias("index"), F.array(words, F.lit("a")).alias("set"))


def test_index_over_many_files_is_dense_and_in_file_order(spark, folder):
    spark.range(0, 1000, 1, 7).write.parquet(f"{folder}/many")
    indexed = indexing.read_indexed(spark, f"{folder}/many")
    assert indexed.filter(F.col("index") != F.col("id")).count() == 0
    assert indexed.count() == 1000
    filtered = indexed.filter("id % 10 = 3").filter(F.col("index") != F.col("id"))
    assert filtered.count() == 0


def test_part_numbers_are_ordered_as_numbers(spark):
    paths = ["d/part-100000-x.parquet", "d/part-99999-x.parquet", "c/z.parquet", "d/a.parquet"]
    counts = spark.createDataFrame([(p, 10) for p in paths], "_file string, _rows bigint")
    before = {r._file: r._before for r in indexing._file_offsets(counts).collect()}
    assert sorted(before, key=before.get) == [
        "c/z.parquet",
        "d/a.parquet",
        "d/part-99999-x.parquet",
        "d/part-100000-x.parquet",
    ]


def test_order_index(spark):
    df = spark.range(500).select(F.xxhash64("id").alias("k"), "id")
    indexed = indexing.with_order_index(df, "k").orderBy("index").collect()
    assert [r["index"] for r in indexed] == list(range(500))
    assert [r.k for r in indexed] == sorted(r.k for r in indexed)


def test_slices(spark):
    df = spark.range(10).toDF("index")
    take = lambda *a: sorted(r[0] for r in indexing.slice_by_index(df, *a).collect())
    assert take(3, 4) == [3, 4, 5, 6]
    assert take(8) == [8, 9]
    assert take(0, 0) == []


@pytest.mark.parametrize(
    "present, start, expected",
    [
        ([0, 1, 2, 4, 5], 0, [0, 1, 2]),
        ([1, 2], 0, []),
        ([1, 2, 5], 1, [1, 2]),
        ([0, 1, 2], 0, [0, 1, 2]),
        ([], 0, []),
        ([0, 1, 7, 8], 7, [7, 8]),
    ],
)
def test_prefix(spark, present, start, expected):
    df = spark.createDataFrame([(i,) for i in present], "index bigint")
    got = indexing.contiguous_prefix(df, start).collect()
    assert sorted(r[0] for r in got) == expected


def test_resume_point(spark):
    df = spark.createDataFrame([(3,), (9,)], "index bigint")
    assert tuple(indexing.resume_point(df).first()) == (9, 10)
    assert tuple(indexing.resume_point(df.filter("false")).first()) == (None, 0)


def test_resumed_run_equals_single_run(spark, folder):
    rows = paq(spark)
    jobs.pair_corpus(rows, f"{folder}/resumed", LIMITED, skip=0, max_rows=7)
    jobs.pair_corpus(rows, f"{folder}/resumed", LIMITED)
    resumed = jobs.pair_corpus(rows, f"{folder}/resumed", NATIVE).collect()
    single = jobs.pair_corpus(rows, f"{folder}/single", NATIVE).collect()
    assert resumed == single
    assert [r["index"] for r in single] == list(range(12))
    # Nothing is left to do, so one more run adds no row.
    before = spark.read.parquet(f"{folder}/resumed").count()
    jobs.pair_corpus(rows, f"{folder}/resumed", NATIVE)
    assert spark.read.parquet(f"{folder}/resumed").count() == before


def test_audit_tells_the_last_outcome(spark, folder):
    rows = paq(spark)
    jobs.pair_corpus(rows, f"{folder}/run", LIMITED)
    jobs.pair_corpus(rows, f"{folder}/run", NATIVE)
    last = jobs.last_outcomes(spark.read.parquet(f"{folder}/run"))
    assert {(r["index"], r.status) for r in last.collect()} == {(i, "ok") for i in range(12)}


def test_markup_job_limits_by_ordinal(spark, folder):
    df = spark.range(5).select(F.col("id").alias("index"), F.lit("<b>the</b>").alias("text"))
    written = jobs.markup_corpus(df, f"{folder}/m", NATIVE, max_samples=2)
    assert [(r["index"], r.translation) for r in written.orderBy("index").collect()] == [
        (0, "<b>el</b>"),
        (1, "<b>el</b>"),
    ]


def test_reasoning_job_needs_an_ordinal_to_limit(spark, folder):
    df = spark.createDataFrame([("p", "r")], "prompt string, response string")
    with pytest.raises(ValueError):
        jobs.reasoning_corpus([df], f"{folder}/r", NATIVE, max_samples=1)


def test_stream_resumes_and_appends_new_files_only(spark, folder):
    def add(lo, hi):
        spark.range(lo, hi).write.mode("append").parquet(f"{folder}/in")

    def run(**options):
        stream = follow(spark, f"{folder}/in", "id bigint", files_per_trigger=1)
        run_to_end(stream, lambda d: d.filter("id >= 0"), f"{folder}/out", f"{folder}/cp", **options)
        return spark.read.parquet(f"{folder}/out").count()

    add(0, 10)
    assert run() == 10
    assert run() == 10
    add(10, 15)
    assert run() == 15


def test_micro_batches_by_size(spark, folder):
    spark.range(0, 400, 1, 4).write.parquet(f"{folder}/in")
    stream = follow(spark, f"{folder}/in", "id bigint", bytes_per_trigger=1000)
    query = run_incremental(stream, lambda d: d, f"{folder}/out", f"{folder}/cp")
    query.awaitTermination()
    assert spark.read.parquet(f"{folder}/out").count() == 400
    assert len([p for p in query.recentProgress if p["numInputRows"]]) > 1


def test_stream_by_time_flushes_while_it_runs(spark, folder):
    spark.range(4).write.parquet(f"{folder}/in")
    query = run_incremental(
        follow(spark, f"{folder}/in", "id bigint"),
        lambda d: d.withColumn("status", F.lit("ok")),
        f"{folder}/out",
        f"{folder}/cp",
        every="1 second",
        partition_by="status",
    )
    query.processAllAvailable()
    assert query.isActive
    assert spark.read.parquet(f"{folder}/out").filter("status = 'ok'").count() == 4
    query.stop()


def test_stream_with_an_outside_translator(spark, folder):
    spark.range(3).select("id", F.lit("the").alias("text")).write.parquet(f"{folder}/in")
    run_to_end(
        follow(spark, f"{folder}/in", "id bigint, text string"),
        lambda d: translation.translate_column(d, "text", LIMITED),
        f"{folder}/out",
        f"{folder}/cp",
    )
    assert {r.translation for r in spark.read.parquet(f"{folder}/out").collect()} == {"el"}


class FakeContext:
    def __init__(self, master):
        self.master, self.made = master, None

    def setCheckpointDir(self, path):
        self.made = path

    def getCheckpointDir(self):
        return self.made

    def getLocalProperty(self, name):
        return None


class FakeSession:
    def __init__(self, named, master):
        self.conf = {"spark.checkpoint.dir": named} if named else {}
        self.sparkContext = FakeContext(master)


def test_shared_folder():
    assert session.shared_folder(FakeSession("hdfs://x/cp/", "yarn")) == "hdfs://x/cp"
    with pytest.raises(RuntimeError):
        session.shared_folder(FakeSession(None, "yarn"))
    alone = FakeSession(None, "local[2]")
    assert session.shared_folder(alone) == session.shared_folder(alone) == alone.sparkContext.made


def test_folders_are_new_each_time(spark):
    assert session.new_folder(spark, "x") != session.new_folder(spark, "x")


def test_owners_of_staged_tables_leave_each_other_alone(spark):
    begun, ended, seen = threading.Event(), threading.Event(), []

    def other():
        with session.staging(spark):
            table = session.stage(spark.range(5), "other")
            begun.set()
            ended.wait(60)
            seen.append(table.count())

    thread = threading.Thread(target=other)
    thread.start()
    begun.wait(60)
    with session.staging(spark):
        mine = session.stage(spark.range(3), "mine")
        with session.staging(spark):
            inner = session.stage(spark.range(2), "inner")
        assert mine.count() == 3
        with pytest.raises(Exception, match="not exist"):
            inner.count()
    ended.set()
    thread.join()
    assert seen == [5]
    with pytest.raises(Exception, match="not exist"):
        mine.count()
    assert session.stage(spark.range(4), "free").count() == 4
