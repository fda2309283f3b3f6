"""Ordered, timed and replaced outputs of streams; the log of single rows."""

import pytest
from pyspark.sql import functions as F

from lexiloom.operators import translation
from lexiloom.operators.engines import TranslatorEngine, WordSwap, wall_clock
from lexiloom.plans import jobs
from lexiloom.streaming.flushes import flush_batches, flush_every, forget_commit, read_flushes, read_log
from lexiloom.streaming.incremental import follow, run_to_end
from lexiloom.streaming.ordered import gap_free, in_order

SCHEMA = "index bigint, text string"


def arrive(spark, folder, rows):
    spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").parquet(f"{folder}/in")


def release(spark, folder, **options):
    stream = follow(spark, f"{folder}/in", SCHEMA, files_per_trigger=1)
    run_to_end(stream, lambda s: in_order(s, **options), f"{folder}/out", f"{folder}/cp")
    return {(r["index"], r.text) for r in spark.read.schema(SCHEMA).parquet(f"{folder}/out").collect()}


def test_rows_wait_for_those_before_them(spark, folder):
    arrive(spark, folder, [(3, "d"), (1, "b"), (None, "?"), (11, "l"), (-1, "x")])
    assert release(spark, folder, range_rows=10) == set()
    # Row 0 lets 0 and 1 go, 10 lets 10 and 11 go; 3 waits for 2. A second 1 changes nothing.
    arrive(spark, folder, [(0, "a"), (1, "again"), (10, "k")])
    first = release(spark, folder, range_rows=10)
    assert first == {(0, "a"), (1, "b"), (10, "k"), (11, "l")}
    out = spark.read.schema(SCHEMA).parquet(f"{folder}/out")
    assert {r["index"] for r in gap_free(out, range_rows=10).collect()} == {0, 1}
    arrive(spark, folder, [(2, "c"), (0, "late"), *[(i, "y") for i in range(4, 10)]])
    assert release(spark, folder, range_rows=10) == first | {(2, "c"), (3, "d")} | {(i, "y") for i in range(4, 10)}
    assert {r["index"] for r in gap_free(spark.read.schema(SCHEMA).parquet(f"{folder}/out"), range_rows=10).collect()} == set(range(12))


def test_release_from_a_start(spark, folder):
    arrive(spark, folder, [(i, "t") for i in (7, 5, 6, 3, 9, 8)])
    assert {i for i, _ in release(spark, folder, start=5, range_rows=4)} == {5, 6, 7, 8, 9}
    out = spark.read.schema(SCHEMA).parquet(f"{folder}/out")
    assert gap_free(out, start=5, range_rows=4).count() == 5


@pytest.mark.parametrize("n", [1, 40])
def test_released_rows_lie_in_order(spark, folder, n):
    """In one file, and so in one task, each range is a gap-free rising run."""
    shuffled = sorted(range(n), key=lambda i: hash(str(i) * 3) % 97)
    arrive(spark, folder, [(i, "t") for i in shuffled])
    release(spark, folder, range_rows=16)
    rows = spark.read.schema(SCHEMA).parquet(f"{folder}/out").select("index", F.col("_metadata.file_path").alias("f"), F.col("_metadata.row_index").alias("r"))
    for part in range(-(-n // 16)):
        found = [r["index"] for r in rows.filter(F.floor(F.col("index") / 16) == part).orderBy("f", "r").collect()]
        assert found == list(range(part * 16, min(n, part * 16 + 16)))


def test_flushes_are_logged_once_each(spark, folder):
    spark.range(0, 60, 1, 3).select(F.col("id").alias("index"), F.lit("t").alias("text")).write.parquet(f"{folder}/in")

    def run():
        stream = follow(spark, f"{folder}/in", SCHEMA, files_per_trigger=1)
        return flush_every(stream, lambda s: s, f"{folder}/out", f"{folder}/cp", f"{folder}/log", "200 milliseconds")

    assert [(r.flush, r.rows) for r in run().orderBy("flush").collect()] == [(0, 20), (1, 20), (2, 20)]
    arrive(spark, folder, [(60, "t")])
    assert [(r.flush, r.rows) for r in run().orderBy("flush").collect()][3:] == [(3, 1)]
    assert all(r.millis > 0 and r.flushed_at.endswith("Z") for r in read_log(spark, f"{folder}/log").collect())
    flushed = read_flushes(spark, f"{folder}/out", SCHEMA).collect()
    assert sorted(r["index"] for r in flushed) == list(range(61))
    assert [sum(r.batch == b for r in flushed) for b in range(4)] == [20, 20, 20, 1]


def test_a_batch_played_again_replaces_itself(spark, folder):
    """Also where the second time has fewer rows, or none."""
    spark.range(0, 20, 1, 2).select(F.col("id").alias("index"), F.lit("t").alias("text")).write.parquet(f"{folder}/in")

    def run(kept):
        stream = follow(spark, f"{folder}/in", SCHEMA, files_per_trigger=1)
        flush_batches(stream, lambda s: s.filter(kept), f"{folder}/out", f"{folder}/cp").awaitTermination()
        rows = read_flushes(spark, f"{folder}/out", SCHEMA).collect()
        return [sorted(r["index"] for r in rows if r.batch == b) for b in (0, 1)]

    first, second = run("true")
    assert sorted(first + second) == list(range(20)) and len(second) == 10
    forget_commit(spark, f"{folder}/cp", 1)
    assert run("true") == [first, second]
    forget_commit(spark, f"{folder}/cp", 1)
    assert run(F.col("index") != second[3]) == [first, second[:3] + second[4:]]
    forget_commit(spark, f"{folder}/cp", 1)
    assert run("false") == [first, []]
    with pytest.raises(FileNotFoundError):
        forget_commit(spark, f"{folder}/cp", 9)


class Slow(WordSwap):
    def __init__(self):
        super().__init__({"the": "el"}, 3)


def test_each_row_has_its_times(spark, folder):
    """Through a whole job: the written rows of both runs carry their times."""
    engine = TranslatorEngine(Slow, on_error="quarantine", clock=wall_clock)
    words = F.array_join(F.array_repeat(F.lit("the"), (F.col("id") % 5 + 1).cast("int")), " ")
    rows = spark.range(0, 12, 1, 3).select(F.col("id").alias("index"), F.when(F.col("id") != 7, F.array(words, F.lit("a"))).alias("set"))
    good = jobs.pair_corpus(rows, f"{folder}/rows", engine)
    assert [r["index"] for r in good.collect()] == [i for i in range(12) if i % 5 < 3 and i != 7]
    log = translation.run_log(spark.read.parquet(f"{folder}/rows")).collect()
    assert len(log) == 24 and all(r.delta >= 0 and r.waited >= 0 for r in log)
    by_row = {}
    for r in sorted(log, key=lambda r: r.event != translation.PICKED_UP):
        by_row.setdefault(r["index"], []).append(r)
    for index, (begun, ended) in by_row.items():
        assert begun.event == translation.PICKED_UP and begun.delta == 0 and begun.time <= ended.time
        outcome = "missing field" if index == 7 else "RowRejected" if index % 5 >= 3 else translation.DONE
        assert outcome in ended.event


def test_log_of_nothing(spark):
    engine = TranslatorEngine(Slow, clock=wall_clock)
    empty = spark.createDataFrame([], "index bigint, set array<string>")
    assert translation.run_log(translation.translate_pairs(empty, engine)).collect() == []
