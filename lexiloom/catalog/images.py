"""Registered queries: payload filters, exports, table and CSV outputs."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lexiloom.catalog import fixtures
from lexiloom.catalog.sql import IMAGES, planted
from lexiloom.operators import detection, export
from lexiloom.plans import jobs
from lexiloom.session import new_folder, stage
from lexiloom.sources import readers, writers

LIMIT = 20
# Page files that a task writes or opens.
TASK_FILES = 1000
PUBLIC_COLUMNS = ["id", "problem", "answer", "pass"]
MANIFEST_SCHEMA = "id STRING, image_filenames STRING, problem STRING, answer STRING, pass STRING"


class HanPayload:
    """A detector as an outside model would be: one payload in, yes or no out."""

    def __call__(self, payload: bytes) -> bool:
        try:
            text = payload.decode("utf-8")
        except UnicodeDecodeError as broken:
            raise detection.Unreadable from broken
        return any("一" <= letter <= "鿿" for letter in text)


def detect_flag(spark: SparkSession, sf: str) -> DataFrame:
    flagged = detection.flag_detections(fixtures.image_rows(spark, sf), outside=HanPayload)
    return flagged.select("id", "detected")


def filter_no_detection(spark: SparkSession, sf: str) -> DataFrame:
    kept = detection.without_detections(fixtures.image_rows(spark, sf))
    return kept.select(*PUBLIC_COLUMNS, F.size("images").cast("bigint").alias("images"))


def filter_no_detection_anti(spark: SparkSession, sf: str) -> DataFrame:
    """By the numbers of rows with a hit; no payload row is shuffled."""
    numbered = fixtures.image_rows(spark, sf).withColumn("number", F.col("id").cast("bigint"))
    kept = detection.without_detections_anti(numbered, "number")
    return kept.select(*PUBLIC_COLUMNS, F.size("images").cast("bigint").alias("images"))


def filter_stats(spark: SparkSession, sf: str) -> DataFrame:
    return detection.detection_stats(fixtures.image_rows(spark, sf))


def export_manifest(spark: SparkSession, sf: str) -> DataFrame:
    return export.manifest(fixtures.image_rows(spark, sf))


def export_limit(spark: SparkSession, sf: str) -> DataFrame:
    return export.manifest(fixtures.image_rows(spark, sf), limit=LIMIT)


def asset_table(spark: SparkSession, sf: str) -> DataFrame:
    assets = export.asset_table(fixtures.image_rows(spark, sf))
    size = F.coalesce(F.octet_length("payload"), F.lit(0)).cast("bigint")
    return assets.select("image_filename", size.alias("bytes"), F.sha2("payload", 256).alias("sha256"))


def write_table(spark: SparkSession, sf: str) -> DataFrame:
    path = new_folder(spark, "table")
    writers.write_table(detection.without_detections(fixtures.image_rows(spark, sf)), path)
    return spark.read.parquet(path).select(*PUBLIC_COLUMNS)


def write_csv(spark: SparkSession, sf: str) -> DataFrame:
    """Documents, line breaks and outer white space and all, to CSV and back."""
    path = new_folder(spark, "csv")
    spaced = F.concat(F.lit("  "), "text", F.lit(" \t")).alias("text")
    writers.write_csv(fixtures.table(spark, sf, "documents").select("doc_id", spaced, "lang"), path)
    schema = "doc_id BIGINT, text STRING, lang STRING"
    return spark.read.options(**writers.CSV_READ_OPTIONS).schema(schema).csv(path)


def write_guard(spark: SparkSession, sf: str) -> DataFrame:
    """A second write is refused and the first one stays whole."""
    path = new_folder(spark, "guarded")
    pages = fixtures.table(spark, sf, "pages").select("page_id", "url")
    writers.write_table(pages, path, overwrite=False)
    try:
        writers.write_table(pages, path, overwrite=False)
        refused = False
    except AnalysisException:
        refused = True
    return spark.read.parquet(path).select(F.lit(refused).alias("refused"), "page_id", "url")


def publish(spark: SparkSession, sf: str) -> DataFrame:
    """Two versions, with the rows of each: two tables, published by their files."""
    path = new_folder(spark, "published")
    rows = fixtures.image_rows(spark, sf)
    writers.write_table(rows, f"{path}/all")
    writers.write_table(detection.without_detections(rows), f"{path}/clean")
    versions = [writers.publish_table(spark, f"{path}/{name}", f"{path}/versions") for name in ("all", "clean")]
    return versions[0].union(versions[1])


def scan_split(spark: SparkSession, sf: str) -> DataFrame:
    return readers.scan_split(spark, f"{sf}/documents.parquet", split=("lang", "es"))


def scan_jsonl(spark: SparkSession, sf: str) -> DataFrame:
    """Two JSON-lines folders read as one source."""
    path = new_folder(spark, "jsonl")
    docs = fixtures.table(spark, sf, "documents").select("doc_id", "lang", "text")
    spanish = F.col("lang") == "es"
    docs.filter(spanish).write.json(f"{path}/first")
    docs.filter(~spanish).write.json(f"{path}/second")
    return readers.scan_jsonl(
        spark, [f"{path}/first", f"{path}/second"], "doc_id BIGINT, lang STRING, text STRING"
    )


def scan_binary(spark: SparkSession, sf: str) -> DataFrame:
    """Every page as a file of its own, opened again and told by its digest."""
    files = _page_files(spark, sf)
    return files.select(_page_of("payload"), "length", F.sha2("payload", 256).alias("sha256"))


def _page_files(spark: SparkSession, sf: str) -> DataFrame:
    """A file per page, opened again: the page's id on the first line, then its text.

    Spark takes a file for 4 MB, so a task of its own choice opens few of them.
    """
    path = new_folder(spark, "page-files")
    value = F.concat(F.col("page_id").cast("string"), F.lit("\n"), fixtures.planted(F.col("html")))
    pages = fixtures.table(spark, sf, "pages").select(value.alias("value"))
    tasks = max(16, -(-pages.count() // TASK_FILES))
    writers.write_files(pages.repartition(tasks), path)
    return readers.scan_binary(spark, path, "part-*").coalesce(tasks)


def _page_of(payload: str) -> Column:
    return F.substring_index(F.col(payload).cast("string"), "\n", 1).cast("bigint").alias("page_id")


def filter_by_path(spark: SparkSession, sf: str) -> DataFrame:
    """Rows that name files, without those whose file has a Han letter.

    Every row names its own page's file and that of the page before it, in a
    different spelling.
    """
    files = _page_files(spark, sf)
    own = stage(files.select(_page_of("payload"), "path"), "page-paths")
    before = own.select((F.col("page_id") + 1).alias("page_id"), F.regexp_replace("path", "^file:/+", "/").alias("earlier"))
    rows = own.join(before, "page_id", "left").select("page_id", F.array_compact(F.array("path", "earlier")).alias("images"))
    return detection.without_detections_by_path(rows, files, "page_id", outside=HanPayload).select("page_id")


def job_k12(spark: SparkSession, sf: str) -> DataFrame:
    """Filter, save, manifest, assets, publish; returns the manifest as written."""
    path = new_folder(spark, "images")
    jobs.clean_images(fixtures.image_rows(spark, sf), path, outside=HanPayload)
    read = spark.read.options(**writers.CSV_READ_OPTIONS).schema(MANIFEST_SCHEMA)
    return read.csv(f"{path}/manifest")


QUERIES = {
    "detect_flag": detect_flag,
    "filter_no_detection": filter_no_detection,
    "filter_no_detection_anti": filter_no_detection_anti,
    "filter_stats": filter_stats,
    "export_manifest": export_manifest,
    "export_limit": export_limit,
    "asset_table": asset_table,
    "write_table": write_table,
    "write_csv": write_csv,
    "write_guard": write_guard,
    "publish": publish,
    "scan_split": scan_split,
    "scan_jsonl": scan_jsonl,
    "scan_binary": scan_binary,
    "filter_by_path": filter_by_path,
    "job_k12": job_k12,
}

_NAMES = """array_to_string(list_transform(range(0, len(images)),
    lambda i: id || '_' || i || '.png'), '||')"""


def _manifest(source: str) -> str:
    return f"""SELECT id, {_NAMES} AS image_filenames, replace(problem, chr(10), ' ') AS problem,
  answer, pass FROM {source} WHERE len(images) > 0"""


_KEPT = """SELECT id, problem, answer, pass, CAST(len(images) AS BIGINT) AS images
FROM flagged WHERE NOT detected"""

SQL = {
    "detect_flag": f"WITH {IMAGES} SELECT id, detected FROM flagged",
    "filter_no_detection": f"WITH {IMAGES} {_KEPT}",
    "filter_no_detection_anti": f"WITH {IMAGES} {_KEPT}",
    "filter_stats": f"""WITH {IMAGES}
SELECT count(*) AS scanned, count(*) FILTER (NOT detected) AS kept,
  count(*) FILTER (detected) AS dropped FROM flagged""",
    "export_manifest": f"WITH {IMAGES} {_manifest('k12')}",
    "export_limit": f"WITH {IMAGES} {_manifest('k12')} ORDER BY CAST(id AS BIGINT) LIMIT {LIMIT}",
    "asset_table": f"""WITH {IMAGES},
placed AS (SELECT id, unnest(images) AS payload, generate_subscripts(images, 1) - 1 AS i FROM k12)
SELECT id || '_' || i || '.png' AS image_filename, CAST(coalesce(strlen(payload), 0) AS BIGINT) AS bytes,
  sha256(payload) AS sha256 FROM placed""",
    "write_table": f"WITH {IMAGES} SELECT id, problem, answer, pass FROM flagged WHERE NOT detected",
    "write_csv": "SELECT doc_id, '  ' || text || ' ' || chr(9) AS text, lang FROM documents",
    "write_guard": "SELECT TRUE AS refused, page_id, url FROM pages",
    "publish": f"""WITH {IMAGES}
SELECT CAST(1 AS BIGINT) AS version, count(*) AS rows FROM flagged
UNION ALL SELECT CAST(2 AS BIGINT), count(*) FROM flagged WHERE NOT detected""",
    "scan_split": "SELECT * FROM documents WHERE lang = 'es'",
    "scan_jsonl": "SELECT doc_id, lang, text FROM documents",
    "scan_binary": f"""SELECT page_id, CAST(strlen(page_id || chr(10) || {planted('html')}) + 1 AS BIGINT) AS length,
  sha256(page_id || chr(10) || {planted('html')} || chr(10)) AS sha256 FROM pages""",
    "filter_by_path": f"""SELECT a.page_id FROM pages a LEFT JOIN pages b ON b.page_id = a.page_id - 1
WHERE NOT contains({planted('a.html')}, '漢') AND NOT contains({planted("coalesce(b.html, '')")}, '漢')""",
    "job_k12": f"WITH {IMAGES} {_manifest('flagged')} AND NOT detected",
}
