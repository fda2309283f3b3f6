from pathlib import Path

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from lexiloom.catalog import images
from lexiloom.operators import detection, export
from lexiloom.plans import jobs
from lexiloom.schemas import IMAGE_ROWS, conform
from lexiloom.sources import readers, writers
from tests.conftest import plan_of

HAN, PLAIN = "漢".encode(), b"plain"


@pytest.fixture
def rows(spark):
    return spark.createDataFrame(
        [
            ("a", [PLAIN, HAN], "p\nq", "1", "0"),
            ("b", [PLAIN, None], None, None, None),
            ("c", [], "no images", "2", "1"),
            ("d", None, "null images", "3", "1"),
            ("e", [None, HAN, PLAIN], "x", "4", "1"),
            ("f", [b"\xff\xfe"], 'say "hi", you', "5", "1"),
        ],
        IMAGE_ROWS,
    )


class Detector:
    def __call__(self, payload):
        try:
            return "漢" in payload.decode("utf-8")
        except UnicodeDecodeError:  # payload f
            raise detection.Unreadable


def ids(df):
    return sorted(r.id for r in df.select("id").collect())


def test_all_forms_keep_the_same_rows(rows):
    assert ids(detection.without_detections(rows)) == ["b", "c", "f"]
    assert ids(detection.without_detections(rows, outside=Detector)) == ["b", "c", "f"]
    assert ids(detection.without_detections_anti(rows, "id")) == ["b", "c", "f"]


def test_rows_that_name_files(spark, tmp_path):
    (tmp_path / "han.txt").write_bytes(HAN)
    (tmp_path / "plain.txt").write_bytes(PLAIN)
    (tmp_path / "broken.txt").write_bytes(b"\xff")
    at = {n: f"file:{tmp_path}/{n}.txt" for n in ("han", "plain", "broken", "absent")}
    named = spark.createDataFrame(
        [("a", [at["plain"], at["han"]]), ("b", [at["plain"]]), ("c", []), ("d", None), ("e", [at["absent"], at["broken"]])]
        + [(f"h{i}", [at["han"]]) for i in range(200)],
        "id string, images array<string>",
    )
    files = readers.scan_binary(spark, str(tmp_path), "*.txt")
    for detector in ({}, {"outside": Detector}):
        kept = detection.without_detections_by_path(named, files, "id", **detector)
        assert ids(kept) == ["b", "c", "e"]


def test_stats(rows):
    assert tuple(detection.detection_stats(rows).first()) == (5, 3, 2)


def test_missing_column_is_an_error(rows):
    with pytest.raises(ValueError):
        detection.without_detections(rows.drop("images"))


def test_python_detector_stops_at_the_first_hit():
    seen = []

    def detect(payload):
        seen.append(payload)
        return payload == b"2"

    assert detection._row_hit(detect, [b"1", b"2", b"3"]) is True
    assert seen == [b"1", b"2"]
    assert detection._row_hit(detect, None) is False


def test_manifest(rows):
    lines = {r.id: r for r in export.manifest(rows, "PNG").collect()}
    assert sorted(lines) == ["a", "b", "e", "f"]
    assert lines["a"].image_filenames == "a_0.png||a_1.png"
    assert lines["a"].problem == "p q"
    assert (lines["b"].problem, lines["b"].answer, lines["b"]["pass"]) == ("", "", "")


def test_limit_counts_written_rows(rows):
    assert ids(export.manifest(rows.filter("id >= 'c'"), limit=2)) == ["e", "f"]


def test_assets_bear_the_manifest_names(rows):
    named = {r.image_filename: r.payload for r in export.asset_table(rows).collect()}
    listed = [n for r in export.manifest(rows).collect() for n in r.image_filenames.split("||")]
    assert sorted(named) == sorted(listed)
    assert bytes(named["a_1.png"]) == HAN


def test_job(spark, rows, folder):
    published = jobs.clean_images(rows, f"{folder}/out", outside=Detector).first()
    assert tuple(published) == (1, 3)
    csv = spark.read.options(**writers.CSV_READ_OPTIONS).csv(f"{folder}/out/manifest")
    assert ids(csv) == ["b", "f"]
    written = spark.read.parquet(f"{folder}/out/rows")
    assert ids(written.filter("outcome = 'without_list'")) == ["d"] and written.count() == 4
    assert spark.read.parquet(f"{folder}/out/totals").first().asDict() == {"scanned": 5, "kept": 3, "dropped": 2, "without_list": 1}
    assert ids(writers.read_published(spark, f"{folder}/out/published", rows.schema)) == ["b", "c", "f"]
    assert csv.filter("id = 'f'").first().problem == 'say "hi", you'


def test_job_counts_scanned_rows_by_ordinal(spark, rows, folder):
    numbered = rows.withColumn("index", F.ascii("id") - F.ascii(F.lit("a")))
    published = jobs.clean_images(numbered, f"{folder}/out", outside=Detector, max_rows=3).first()
    assert tuple(published) == (1, 2)


def test_empty_result_is_still_a_table(spark, rows, folder):
    writers.write_table(rows.filter("false"), f"{folder}/empty")
    assert spark.read.parquet(f"{folder}/empty").columns == rows.columns


def test_second_write_is_refused(rows, folder):
    writers.write_csv(export.manifest(rows), f"{folder}/m", overwrite=False)
    with pytest.raises(AnalysisException, match="PATH_ALREADY_EXISTS"):
        writers.write_csv(export.manifest(rows), f"{folder}/m", overwrite=False)


def test_versions_count_up(rows, folder):
    got = [tuple(writers.publish(rows.limit(n), f"{folder}/pub").first()) for n in (2, 3)]
    assert got == [(1, 2), (2, 3)]


def test_payloads_from_files(spark, tmp_path):
    (tmp_path / "x.bin").write_bytes(HAN)
    (tmp_path / "y.txt").write_bytes(PLAIN)
    (row,) = readers.scan_binary(spark, str(tmp_path), "*.bin").collect()
    assert (row.length, bytes(row.payload)) == (len(HAN), HAN)


def test_unreadable_batch_files_are_passed_over_and_named(spark, tmp_path):
    path = str(tmp_path / "batches")
    schema = "idx1 bigint, idx2 bigint"
    pairs = spark.createDataFrame([(0, 1, 0), (2, 3, 1)], schema + ", batch_id bigint")
    writers.write_batches(pairs, path, size=10)
    (tmp_path / "batches" / "batch=batch_20_30").mkdir()
    (tmp_path / "batches" / "batch=batch_20_30" / "junk.parquet").write_bytes(b"junk")
    rows = readers.read_batches(spark, path, schema).collect()
    assert sorted((r.idx1, r.batch_no) for r in rows) == [(0, 0), (2, 10)]
    assert [r.file for r in readers.skipped_files(spark, path, schema).collect()] == [
        f"file:{tmp_path}/batches/batch=batch_20_30/junk.parquet"
    ]


def test_contract_names_what_is_missing(rows):
    with pytest.raises(ValueError, match="absent"):
        conform(rows, ["id", "absent"])


def test_sources_with_two_layouts(spark):
    first = spark.createDataFrame([("p", "r")], "prompt string, response string")
    second = spark.createDataFrame([("i", "o")], "instruction string, output string")
    half = spark.createDataFrame([("x",)], "instruction string")
    assert readers.normalize_columns(half).columns == ["instruction"]
    rows = readers.union_sources(first, second).collect()
    assert sorted(map(tuple, rows)) == [("i", "o"), ("p", "r")]


def test_csv_keeps_line_breaks_quotes_and_lists(spark, folder):
    df = spark.createDataFrame([(1, 'a "b"\n, c', ["x", "y"])], "i int, t string, l array<string>")
    writers.write_csv(df, f"{folder}/c")
    (row,) = spark.read.options(**writers.CSV_READ_OPTIONS).csv(f"{folder}/c").collect()
    assert tuple(row) == ("1", 'a "b"\n, c', '["x","y"]')


def test_output_size(spark, rows, folder):
    writers.write_table(rows.repartition(3), f"{folder}/t")
    size = writers.output_size(spark, f"{folder}/t").first()
    assert size.files >= 1 and size.megabytes >= 0


def test_native_detector_needs_no_shuffle(rows):
    from tests.conftest import plan_of

    plan = plan_of(detection.without_detections(rows, outside=Detector).select(F.col("id")))
    assert "Exchange" not in plan


def test_a_file_for_each_row(spark, folder):
    """In a folder for each task, without a file of checksums for each."""
    rows = spark.createDataFrame([("a\nb",), ("",), (None,), ("漢",), ("a\nb",)], "value string").repartition(3)
    writers.write_files(rows, f"{folder}/files")
    names = [p.relative_to(f"{folder}/files").parts for p in Path(folder, "files").rglob("*") if p.is_file()]
    assert len(names) == 5 and all(len(n) == 2 and n[0].startswith("folder=") and n[1].startswith("part-") for n in names)
    read = readers.scan_binary(spark, f"{folder}/files", "part-*").collect()
    assert sorted(bytes(r.payload).decode() for r in read) == ["\n", "\n", "a\nb\n", "a\nb\n", "漢\n"]
    writers.write_files(rows.limit(0), f"{folder}/none")
    assert readers.scan_binary(spark, f"{folder}/none", "part-*").count() == 0


def test_page_files_are_opened_in_few_tasks_and_once_for_their_names(spark, folder):
    pages = [(i, f"u{i}", "x 漢" if i % 10 == 4 else f"text {i}") for i in range(100)]
    spark.createDataFrame(pages, "page_id bigint, url string, html string").write.parquet(f"{folder}/pages.parquet")
    found = images.scan_binary(spark, folder)
    assert found.rdd.getNumPartitions() <= 16 and found.count() == 100
    kept = images.filter_by_path(spark, folder)
    assert "binaryFile" not in plan_of(kept)
    assert sorted(r.page_id for r in kept.collect()) == [i for i in range(100) if i % 10 not in (4, 5)]
