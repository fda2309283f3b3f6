"""Row ordinals, slices by ordinal and resumption."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lexiloom.session import new_folder
from lexiloom.sources.readers import file_mark
from lexiloom.sources.writers import is_file


def _file_offsets(counts: DataFrame) -> DataFrame:
    """Running row count before each file; one row per file, never per data row.

    Order: folder, then the writer's part number where the name has one (it is
    not zero-padded beyond five digits), then path.
    """
    order = Window.orderBy(
        F.regexp_replace("_file", r"[^/]*\z", ""),
        F.regexp_extract("_file", r"part-(\d+)[^/]*\z", 1).try_cast("bigint").asc_nulls_first(),
        "_file",
    )
    before = F.sum("_rows").over(order) - F.col("_rows")
    return counts.select("_file", before.alias("_before"))


def read_indexed(spark: SparkSession, *paths: str, name: str = "index") -> DataFrame:
    """Parquet rows with their position over all files, from 0 without gaps.

    The place of a row inside its file comes from the reader, so the data is
    neither shuffled nor sorted, and a repeated task gives the same numbers.
    What is broadcast is the hash of each file's address and its offset, 16
    bytes a file: for a million files 16 MB. Two files with one hash stop the
    job.
    """
    df = spark.read.parquet(*paths)
    place = F.col("_metadata.row_index")
    if len(paths) == 1 and is_file(spark, paths[0]):
        return df.select(place.alias(name), "*")
    counts = df.groupBy(F.col("_metadata.file_path").alias("_file")).agg(
        F.count(F.lit(1)).alias("_rows")
    )
    address = F.xxhash64("_file")
    alike = F.raise_error(F.lit("two files have one address hash")).cast("bigint")
    offsets = (
        _file_offsets(counts)
        .groupBy(address.alias("_hash"))
        .agg(F.when(F.count(F.lit(1)) == 1, F.min("_before")).otherwise(alike).alias("_before"))
    )
    rows = df.select("*", F.xxhash64("_metadata.file_path").alias("_hash"), place.alias("_place"))
    return rows.join(F.broadcast(offsets), "_hash").select(
        (F.col("_before") + F.col("_place")).alias(name), *[F.col(f"`{c}`") for c in df.columns]
    )


def number_rows(df: DataFrame, files: DataFrame, name: str = "index") -> DataFrame:
    """Rows of many files with their position over all of them, from 0.

    ``files`` is a written table of ``readers.file_rows``. The same as ``read_indexed``
    for a scan that is there already and may pass over files: these leave gaps. A row
    of a file that is not told of is an error.
    """
    alike = F.raise_error(F.lit("two files have one address hash"))
    offsets = (
        _file_offsets(files.filter("rows > 0").select(F.col("file").alias("_file"), F.col("rows").alias("_rows")))
        .groupBy(file_mark(F.col("_file")).alias("_file_mark"))
        .agg(F.when(F.count(F.lit(1)) == 1, F.min("_before")).otherwise(alike.cast("bigint")).alias("_before"))
    )
    unknown = F.raise_error(F.lit("rows of a file that was not listed")).cast("bigint")
    placed = df.select("*", file_mark(F.col("_metadata.file_path")).alias("_file_mark"), F.col("_metadata.row_index").alias("_place"))
    number = F.coalesce(F.col("_before"), unknown) + F.col("_place")
    return placed.join(F.broadcast(offsets), "_file_mark", "left").select(*[F.col(f"`{c}`") for c in df.columns], number.alias(name))


def with_order_index(df: DataFrame, *keys: str, name: str = "index") -> DataFrame:
    """Position in the order of ``keys`` (unique together), from 0 without gaps.

    Range-partitioned sort, written once to the shared folder; positions are
    then taken from the written files, so they stay the same on any re-run.
    """
    spark = df.sparkSession
    path = new_folder(spark, "ordered")
    df.repartitionByRange(*keys).sortWithinPartitions(*keys).write.parquet(path)
    return read_indexed(spark, path, name=name)


def slice_by_index(
    df: DataFrame, skip: int = 0, max_rows: int | None = None, index: str = "index"
) -> DataFrame:
    """Rows ``skip .. skip + max_rows - 1`` by ordinal: a range filter, no limit."""
    chosen = F.col(index) >= skip
    if max_rows is not None:
        chosen = chosen & (F.col(index) < skip + max_rows)
    return df.filter(chosen)


def resume_point(done: DataFrame, index: str = "index") -> DataFrame:
    """The highest ordinal already written and the next one to do, as one row."""
    last = F.max(index)
    return done.agg(
        last.cast("bigint").alias("last_index"),
        F.coalesce(last + 1, F.lit(0)).cast("bigint").alias("next_index"),
    )


def pending(df: DataFrame, done: DataFrame, index: str = "index") -> DataFrame:
    """Rows whose ordinal is not in ``done`` yet."""
    return df.join(done.select(index), index, "left_anti")


def contiguous_prefix(df: DataFrame, start: int = 0, index: str = "index") -> DataFrame:
    """Rows from ``start`` up to the first missing ordinal.

    The gap is found by an anti-join of each ordinal's successor, not by a
    window over all rows.
    """
    present = df.select(F.col(index).alias("_present"))
    wanted = df.select((F.col(index) + 1).alias("_wanted")).union(
        df.sparkSession.range(start, start + 1).toDF("_wanted")
    )
    gap = (
        wanted.filter(F.col("_wanted") >= start)
        .join(present, F.col("_wanted") == F.col("_present"), "left_anti")
        .agg(F.min("_wanted"))
        .scalar()
    )
    return df.filter((F.col(index) >= start) & (F.col(index) < gap))
