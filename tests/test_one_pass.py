"""Jobs that read their input once, and outputs that are told by their footers."""

import os
import threading

import pytest
from pyspark.sql import functions as F

from lexiloom.operators import detection
from lexiloom.plans import jobs
from lexiloom.schemas import IMAGE_ROWS, SCORED_PAIRS
from lexiloom.sources import readers, writers

SCHEMA = "idx1 bigint, idx2 bigint, text string"


def numbers(spark, n, path):
    rows = spark.range(n).select(F.col("id").alias("idx1"), F.col("id").alias("idx2"), F.sha2(F.col("id").cast("string"), 256).alias("text"))
    rows.coalesce(1).write.option("parquet.block.size", 100_000).option("parquet.page.size", 10_000).parquet(path)


def part_of(folder):
    (name,) = [n for n in os.listdir(folder) if n.endswith(".parquet")]
    return f"{folder}/{name}"


@pytest.fixture
def batches(spark, folder):
    """A whole file, an empty one, a truncated one, one broken half way, one that is no Parquet."""
    path = f"{folder}/b"
    numbers(spark, 30_000, f"{path}/batch=batch_0_10")
    numbers(spark, 0, f"{path}/batch=batch_10_20")
    with open(part_of(f"{path}/batch=batch_0_10"), "rb") as whole:
        raw = whole.read()
    half = len(raw) // 2
    for number, content in ((20, raw[:half]), (30, raw[:half] + b"\xff" * (half // 2) + raw[half + half // 2 :]), (40, b"junk")):
        os.makedirs(f"{path}/batch=batch_{number}_{number + 10}")
        with open(f"{path}/batch=batch_{number}_{number + 10}/broken.parquet", "wb") as file:
            file.write(content)
    return path


def test_broken_files_are_named_and_empty_ones_are_not(spark, batches):
    found = {r.file.split("batch=")[1]: (r.rows, r.read) for r in readers.skipped_files(spark, batches, SCHEMA).collect()}
    assert found.keys() == {f"batch_{n}_{n + 10}/broken.parquet" for n in (20, 30, 40)}
    assert found["batch_20_30/broken.parquet"] == found["batch_40_50/broken.parquet"] == (None, 0)
    rows, read = found["batch_30_40/broken.parquet"]
    assert rows == 30_000 and 0 < read < rows
    told = {r.file.split("batch=")[1].split("/")[0]: r.rows for r in readers.file_rows(spark, batches).collect()}
    assert told == {"batch_0_10": 30_000, "batch_10_20": 0, "batch_20_30": None, "batch_30_40": 30_000, "batch_40_50": None}


def pairs_in(spark, path):
    rows = [(1, 2, "a", "b", 0.5, 0), (2, 1, "b", "a", 0.5, 0), (3, 3, "c", "c", 1.0, 1), (5, 4, "e", "d", 0.1, 1), (1, 2, "a", "b", 0.5, 2)]
    writers.write_batches(spark.createDataFrame(rows, SCORED_PAIRS + ", batch_id bigint"), path, size=10)


def test_consolidation_reads_its_batches_once(spark, folder, monkeypatch):
    pairs_in(spark, f"{folder}/b")
    monkeypatch.setattr(readers, "skipped_files", lambda *a: pytest.fail("read again"))
    monkeypatch.setattr(jobs.pairs, "pair_dedup_stats", lambda *a: pytest.fail("counted again"))
    stats = jobs.consolidate(spark, f"{folder}/b", f"{folder}/csv").first()
    assert stats.asDict() == {"initial_pairs": 5, "self_pairs_removed": 1, "duplicates_removed": 2, "final_pairs": 2, "files_skipped": 0}
    written = spark.read.options(**writers.CSV_READ_OPTIONS).csv(f"{folder}/csv")
    assert sorted((r.idx1, r.idx2) for r in written.collect()) == [("1", "2"), ("5", "4")]
    assert spark.read.parquet(f"{folder}/csv-skipped").count() == 0


def test_consolidation_names_what_it_could_not_read(spark, folder):
    pairs_in(spark, f"{folder}/b")
    os.makedirs(f"{folder}/b/batch=batch_90_100")
    with open(f"{folder}/b/batch=batch_90_100/x.parquet", "wb") as file:
        file.write(b"junk")
    stats = jobs.consolidate(spark, f"{folder}/b", f"{folder}/csv").first()
    assert (stats.initial_pairs, stats.final_pairs, stats.files_skipped) == (5, 2, 1)
    (named,) = spark.read.parquet(f"{folder}/csv-skipped").collect()
    assert named.file.endswith("batch=batch_90_100/x.parquet")


def test_consolidation_of_nothing(spark, folder):
    spark.createDataFrame([], SCORED_PAIRS).write.parquet(f"{folder}/b")
    assert tuple(jobs.consolidate(spark, f"{folder}/b", f"{folder}/csv").first()) == (0, 0, 0, 0, 0)


def test_counts_that_cannot_be_right_are_taken_again(spark, folder, monkeypatch):
    """As when a task was redone after its executor was lost, and so counted twice."""
    pairs_in(spark, f"{folder}/b")

    class Twice(jobs.Observation):
        @property
        def get(self):
            return {k: v and 2 * v for k, v in super().get.items()}

    monkeypatch.setattr(jobs, "Observation", Twice)
    stats = jobs.consolidate(spark, f"{folder}/b", f"{folder}/csv").first()
    assert tuple(stats) == (5, 1, 2, 2, 0)
    rows = spark.createDataFrame([("a", [b"x"], "p", "1", "0"), ("b", None, "p", "1", "0")], IMAGE_ROWS)
    jobs.clean_images(rows, f"{folder}/i")
    assert tuple(spark.read.parquet(f"{folder}/i/totals").first()) == (1, 1, 0, 1)


def test_images_are_read_once(spark, folder):
    """The detector is asked once for each payload, whatever is written."""
    asked = spark.sparkContext.accumulator(0)

    class Counting:
        def __call__(self, payload):
            asked.add(1)
            return payload == b"bad"

    rows = spark.createDataFrame([(str(i), [b"bad" if i % 3 else b"good"], "p", "1", "0") for i in range(30)], IMAGE_ROWS)
    assert tuple(jobs.clean_images(rows, f"{folder}/i", outside=Counting).first()) == (1, 10)
    assert asked.value == 30


def test_nothing_kept_is_still_published(spark, folder):
    rows = spark.createDataFrame([("a", ["漢".encode()], "p", "1", "0")], IMAGE_ROWS)
    assert tuple(jobs.clean_images(rows, f"{folder}/i").first()) == (1, 0)
    assert writers.read_published(spark, f"{folder}/i/published", rows.schema).collect() == []
    assert spark.read.schema(rows.schema).parquet(f"{folder}/i/rows/outcome={detection.KEPT}").count() == 0


def test_publishing_writes_no_payload(spark, folder):
    numbers(spark, 5_000, f"{folder}/t")
    writers.publish_table(spark, f"{folder}/t", f"{folder}/p").collect()
    size = sum(os.path.getsize(os.path.join(d, f)) for d, _, names in os.walk(f"{folder}/p") for f in names)
    assert size < 5_000 < os.path.getsize(part_of(f"{folder}/t"))
    assert writers.read_published(spark, f"{folder}/p", SCHEMA).count() == 5_000


def test_publishers_at_once_get_a_version_each(spark, folder):
    tables = [f"{folder}/t{n}" for n in range(4)]
    for n, table in enumerate(tables):
        numbers(spark, n + 1, table)
    together, found = threading.Barrier(len(tables)), []

    def publish(table):
        together.wait()
        found.append(tuple(writers.publish_table(spark, table, f"{folder}/p").first()))

    threads = [threading.Thread(target=publish, args=(t,)) for t in tables]
    for t in threads:
        t.start()
    for t in threads:
        t.join()
    assert sorted(v for v, _ in found) == [1, 2, 3, 4] and sorted(r for _, r in found) == [1, 2, 3, 4]
    assert all(writers.read_published(spark, f"{folder}/p", SCHEMA, v).count() == r for v, r in found)
    assert not [n for n in os.listdir(f"{folder}/p") if n.startswith(".staged")]


def test_a_table_with_a_broken_file_is_not_published(spark, batches, folder):
    with pytest.raises(Exception, match="no footer in"):
        writers.publish_table(spark, batches, f"{folder}/p")
    assert writers.last_version(spark, f"{folder}/p") == 0


def test_a_file_that_fails_its_checksum_is_named(spark, folder):
    """Spark cannot even read its bytes, as the writer's checksum lies beside it."""
    numbers(spark, 10, f"{folder}/t/batch=batch_0_10")
    numbers(spark, 10, f"{folder}/t/batch=batch_10_20")
    broken = part_of(f"{folder}/t/batch=batch_10_20")
    with open(broken, "wb") as file:
        file.write(b"no parquet")
    told = {r.file.split("batch=")[1].split("/")[0]: r.rows for r in readers.file_rows(spark, f"{folder}/t").collect()}
    assert told == {"batch_0_10": 10, "batch_10_20": None}
    (named,) = readers.skipped_files(spark, f"{folder}/t", SCHEMA).collect()
    assert named.file == f"file:{broken}"
