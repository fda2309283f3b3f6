"""Readers: dataset splits, JSON lines, batch outputs, binary payloads."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
import pyarrow.parquet as pq
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lexiloom.functions.names import batch_number

# How one layout's columns map to another's.
PROMPT_NAMES = {"instruction": "prompt", "output": "response"}


def scan_split(
    spark: SparkSession,
    path: str,
    schema: str | None = None,
    split: tuple[str, str] | None = None,
) -> DataFrame:
    """A stored table, or its part where a column has a value.

    ``split`` is (column, value); it reaches the scan as a partition or row
    group filter.
    """
    reader = spark.read.schema(schema) if schema else spark.read
    df = reader.parquet(path)
    return df.filter(F.col(split[0]) == split[1]) if split else df


def scan_jsonl(spark: SparkSession, paths: str | list[str], schema: str) -> DataFrame:
    """JSON lines from one or many files, with an explicit schema."""
    return spark.read.schema(schema).json(paths)


def scan_dictionary(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """JSON lines with undecodable bytes removed; bad lines keep their text.

    A line that is not JSON has its text in ``corrupt`` and NULL elsewhere.
    """
    layout = T.StructType.fromDDL(schema).add("corrupt", "string")
    raw = F.col("value")
    clean = F.when(F.is_valid_utf8(raw), raw).otherwise(
        F.regexp_replace(F.make_valid_utf8(raw), "\uFFFD", "")
    )
    parsed = F.from_json(clean, layout, {"columnNameOfCorruptRecord": "corrupt"})
    return spark.read.text(path).select(parsed.alias("entry")).select("entry.*")


def split_corrupt(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Parsed rows and quarantined lines."""
    good = df.filter(F.col("corrupt").isNull()).drop("corrupt")
    return good, df.filter(F.col("corrupt").isNotNull()).select("corrupt")


def read_batches(spark: SparkSession, path: str, schema: str, pattern: str = "*.parquet") -> DataFrame:
    """All partial outputs under ``path`` with the number of their batch.

    Unreadable files are passed over; ``skipped_files`` names them.
    """
    df = (
        spark.read.schema(schema)
        .option("pathGlobFilter", pattern)
        .option("recursiveFileLookup", "true")
        .option("ignoreCorruptFiles", "true")
        .parquet(path)
    )
    return df.withColumn("batch_no", batch_number(F.col("_metadata.file_path")))


def file_rows(spark: SparkSession, path: str, pattern: str = "*.parquet") -> DataFrame:
    """(file, rows): how many rows the footer of each file under ``path`` tells of.

    NULL where there is no footer to read. Footers with rows are read by a scan of
    no columns; only files without any are opened as a whole, on executors, to
    tell empty ones from broken ones.
    """
    binary = spark.read.format("binaryFile").option("pathGlobFilter", pattern).option("recursiveFileLookup", "true")
    # A file of which not even the bytes can be read is passed over here, and so has no rows told.
    listed = binary.option("ignoreCorruptFiles", "true").load(path)
    scan = spark.read.schema("_none INT").option("pathGlobFilter", pattern).option("recursiveFileLookup", "true")
    filled = scan.option("ignoreCorruptFiles", "true").parquet(path).groupBy(_address(F.col("_metadata.file_path")).alias("file"))
    counts = filled.agg(F.count(F.lit(1)).alias("rows"))
    bare = listed.select("path", _address(F.col("path")).alias("file")).join(counts, "file", "left_anti")
    opened = listed.join(bare.select("path"), "path", "left_semi").select(_address(F.col("path")).alias("file"), "content")
    told = opened.mapInArrow(_footers, "file string, rows long")
    return counts.unionByName(bare.select("file").join(told, "file", "left"))


def _footers(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = []
        for content in batch.column("content"):
            try:
                rows.append(pq.read_metadata(pa.BufferReader(content.as_buffer())).num_rows)
            except (pa.ArrowInvalid, OSError):
                rows.append(None)
        yield pa.RecordBatch.from_arrays([batch.column("file"), pa.array(rows, pa.int64())], ["file", "rows"])


def file_mark(path: Column) -> Column:
    """A number for a file's address; sums of them tell rows of which files were read."""
    return F.xxhash64(_address(path)).cast("decimal(20,0)")


def skipped_files(spark: SparkSession, path: str, schema: str, pattern: str = "*.parquet") -> DataFrame:
    """(file, rows, read): files under ``path`` of which not every row could be read.

    ``rows`` is by the file's footer, NULL without one; a sound file without rows
    is none of them. Files of different batch folders often share a name, so
    files are told apart by their whole address.
    """
    whole = read_batches(spark, path, schema, pattern)
    # One for each row, by way of all its values: a plain count would read no page.
    one = F.pmod(F.xxhash64(*[F.col(f"`{name}`") for name in whole.columns]), F.lit(1)) + 1
    counts = whole.groupBy(_address(F.col("_metadata.file_path")).alias("file")).agg(F.sum(one).alias("read"))
    both = file_rows(spark, path, pattern).join(counts, "file", "left")
    found = both.select("file", "rows", F.coalesce("read", F.lit(0)).cast("bigint").alias("read"))
    return found.filter(F.col("rows").isNull() | (F.col("read") < F.col("rows")))


def _address(path: Column) -> Column:
    """One spelling for a file's address, however a reader writes it."""
    return F.replace(F.regexp_replace(path, r"^(\w+):/+", "$1:/"), F.lit("%20"), F.lit(" "))


def scan_binary(spark: SparkSession, path: str, pattern: str = "*") -> DataFrame:
    """Files as (path, length, payload); the payload is read only where used."""
    return (
        spark.read.format("binaryFile")
        .option("pathGlobFilter", pattern)
        .option("recursiveFileLookup", "true")
        .load(path)
        .select("path", "length", F.col("content").alias("payload"))
    )


def normalize_columns(df: DataFrame, names: dict[str, str] = PROMPT_NAMES) -> DataFrame:
    """Rename when every old name is there; otherwise leave the table as it is."""
    return df.withColumnsRenamed(names) if set(names) <= set(df.columns) else df


def union_sources(first: DataFrame, *others: DataFrame) -> DataFrame:
    """All rows of all sources, columns matched by name after renaming."""
    together = normalize_columns(first)
    for other in others:
        together = together.unionByName(normalize_columns(other), allowMissingColumns=True)
    return together
