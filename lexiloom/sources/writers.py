"""Writers. Spark's commit protocol makes each one all or nothing."""

from __future__ import annotations

import errno
import os
import shutil
import uuid
from collections.abc import Callable, Iterator
from functools import reduce

import pyarrow as pa
from py4j.protocol import Py4JJavaError
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from lexiloom.functions.names import batch_name
from lexiloom.schemas import lists_as_json
from lexiloom.session import new_folder
from lexiloom.sources.readers import file_rows

# CSV dialect, quotes doubled and only where needed, no trimming.
CSV_OPTIONS = {
    "header": "true",
    "quote": '"',
    "escape": '"',
    "emptyValue": "",
    "ignoreLeadingWhiteSpace": "false",
    "ignoreTrailingWhiteSpace": "false",
}
# What a version number is taken with on a local disk.
CLAIM = ".claim-"
CSV_READ_OPTIONS = {**CSV_OPTIONS, "multiLine": "true"}


def _mode(overwrite: bool) -> str:
    return "overwrite" if overwrite else "errorifexists"


def write_table(df: DataFrame, path: str, overwrite: bool = True, partition_by: str | None = None) -> None:
    """A Parquet table; an empty result still carries its schema, unless it is partitioned."""
    writer = df.write.mode(_mode(overwrite))
    (writer.partitionBy(partition_by) if partition_by else writer).parquet(path)


def write_csv(df: DataFrame, path: str, overwrite: bool = True) -> None:
    """CSV with a header; array columns become JSON text.

    CSV cannot tell an empty text from NULL, so Parquet stays the source of
    truth and this is for hand-off. Without ``overwrite`` an existing path is
    an error.
    """
    lists_as_json(df).write.mode(_mode(overwrite)).options(**CSV_OPTIONS).csv(path)


def write_batches(
    df: DataFrame,
    path: str,
    batch: str = "batch_id",
    size: int = 1000,
    gather: bool = True,
    only: bool = False,
) -> None:
    """One folder per batch, named after its rows; a re-run replaces only its own.

    With ``only``, folders of other batches under ``path`` go as well.

    ``gather`` brings the rows of a batch together first, so that small batches
    are one file each and an outsized one is split over several tasks. Leave it
    out where the rows already lie by batch.
    """
    first = F.col(batch) * size
    named = df.withColumn("batch", batch_name(first, first + size)).drop(batch)
    if gather:
        named = named.hint("rebalance", "batch")
    (
        named.write.mode("overwrite")
        .option("partitionOverwriteMode", "static" if only else "dynamic")
        .partitionBy("batch")
        .parquet(path)
    )


def write_files(df: DataFrame, path: str) -> None:
    """A text file for each row of a one-column table, in a folder for each task.

    A folder is committed by one rename, whatever the number of its files, and folders
    are listed by tasks. On a local disk the tasks write the files themselves: through
    Hadoop each would cost two processes that set its rights.
    """
    spark = df.sparkSession
    files, where = _filesystem(spark, path)
    if files.getUri().getScheme() != "file":
        placed = df.withColumn("folder", F.spark_partition_id())
        placed.write.option("maxRecordsPerFile", 1).partitionBy("folder").text(path)
        return
    files.mkdirs(where)
    values = df.select(F.col(f"`{df.columns[0]}`").cast("binary").alias("value"))
    values.mapInArrow(_local_files(where.toUri().getPath()), "files long").agg(F.sum("files")).collect()


def write_lines(df: DataFrame, path: str, files: int) -> None:
    """A one-column table as text in that many files (fewer if it has fewer rows).

    Rows are dealt in turn where they lie, with no shuffle, to a staged table that is
    compressed more than shuffled rows are: the one task that writes a file reads that.
    """
    turn = F.pmod(F.spark_partition_id() + F.monotonically_increasing_id(), F.lit(files))
    staged = new_folder(df.sparkSession, "dealt")
    df.withColumn("_file", turn).write.option("compression", "zstd").partitionBy("_file").parquet(staged)
    dealt = df.sparkSession.read.schema(StructType([*df.schema, StructField("_file", LongType())])).parquet(staged)
    rows = lambda n: dealt.filter(F.col("_file") == n).select(*[F.col(f"`{c}`") for c in df.columns])
    # Spark unites tables of one partition to one partition; a scan without files is of none.
    reduce(DataFrame.union, [rows(n).coalesce(1) for n in range(files)], rows(files)).write.text(path)


def _local_files(root: str) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Writes the rows of a task under a hidden name; the first attempt to end names the folder."""

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get()
        part, done = task.partitionId(), 0
        staged = f"{root}/.folder-{part}-{task.taskAttemptId()}"
        os.makedirs(staged)
        for batch in batches:
            for value in batch.column(0):
                with open(f"{staged}/part-{part:05d}-{done:06d}.txt", "wb") as file:
                    file.write((value.as_py() or b"") + b"\n")
                done += 1
        try:
            os.rename(staged, f"{root}/folder={part}")
        except OSError as taken:
            if taken.errno not in (errno.EEXIST, errno.ENOTEMPTY):
                raise
            shutil.rmtree(staged)
        yield pa.RecordBatch.from_arrays([pa.array([done], pa.int64())], ["files"])

    return write


def append_run(df: DataFrame, path: str) -> None:
    """Adds one run's rows, good and quarantined apart, with the time of the run."""
    (
        df.withColumn("processed_at", F.current_timestamp())
        .write.mode("append")
        .partitionBy("status")
        .parquet(path)
    )


def publish(df: DataFrame, target: str) -> DataFrame:
    """Writes ``df`` beside the records under ``target`` and publishes that table."""
    table = f"{target}/tables/{uuid.uuid4().hex}"
    write_table(df, table, overwrite=False)
    return publish_table(df.sparkSession, table, target)


def publish_table(spark: SparkSession, table: str, target: str) -> DataFrame:
    """A new version under ``target`` that holds the files of a written table.

    Returns (version, rows). What is written is a record, (file, rows) for each
    file by its footer; no row is read or copied, so ``table`` has to stay as it
    is. The record gets its number by one rename that fails where the number is
    taken: of two publishers at once each gets a version of its own, and readers
    (``read_published``) never see half a record. Where renaming does not fail so, on
    a local disk, the number is first taken by making a folder, which does; a number
    whose publisher died in between stays free. A file without a footer is an error.
    """
    staged = f"{target}/.staged-{uuid.uuid4().hex}"
    broken = F.raise_error(F.concat(F.lit("no footer in "), "file")).cast("bigint")
    files = file_rows(spark, table).select("file", F.coalesce("rows", broken).alias("rows"))
    files.coalesce(1).write.parquet(staged)  # a line for each file
    while True:
        version = max(last_version(spark, target), last_version(spark, target, CLAIM)) + 1
        if _claimed(spark, f"{target}/{CLAIM}{version}") and _renamed(spark, staged, f"{target}/version={version}"):
            break
    total = F.coalesce(F.sum("rows"), F.lit(0)).alias("rows")
    return published_files(spark, target, version).agg(total).select(F.lit(version).cast("bigint").alias("version"), "rows")


def published_files(spark: SparkSession, target: str, version: int | None = None) -> DataFrame:
    """(file, rows) of a version, by default the last one."""
    number = version or last_version(spark, target)
    return spark.read.schema("file STRING, rows BIGINT").parquet(f"{target}/version={number}")


def read_published(spark: SparkSession, target: str, schema: str | StructType, version: int | None = None) -> DataFrame:
    """The rows of a published version, from the files its record names."""
    files = [r.file for r in published_files(spark, target, version).select("file").collect()]
    return spark.read.schema(schema).parquet(*files) if files else spark.createDataFrame([], schema)


def _claimed(spark: SparkSession, claim: str) -> bool:
    """On a local disk, whether the folder ``claim`` could be made anew; else there is no need."""
    files, where = _filesystem(spark, claim)
    if files.getUri().getScheme() != "file":
        return True
    jvm = spark._jvm
    none = spark.sparkContext._gateway.new_array(jvm.java.nio.file.attribute.FileAttribute, 0)
    try:
        jvm.java.nio.file.Files.createDirectory(jvm.java.nio.file.Path.of(files.makeQualified(where).toUri()), none)
    except Py4JJavaError:
        if exists(spark, claim):
            return False
        raise
    return True


def _renamed(spark: SparkSession, source: str, target: str) -> bool:
    """Gives a folder its name unless the name is taken."""
    jvm = spark._jvm
    where = [jvm.org.apache.hadoop.fs.Path(p) for p in (source, target)]
    files = jvm.org.apache.hadoop.fs.FileContext.getFileContext(where[1].toUri(), spark._jsc.hadoopConfiguration())
    options = spark.sparkContext._gateway.new_array(getattr(jvm.org.apache.hadoop.fs, "Options$Rename"), 0)
    try:
        files.rename(*where, options)
    except Py4JJavaError:
        if exists(spark, target) and exists(spark, source):
            return False
        raise
    return True


def _filesystem(spark: SparkSession, path: str):
    """The file system a path is on, and the path, through Hadoop's own API."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()), where


def exists(spark: SparkSession, path: str) -> bool:
    files, where = _filesystem(spark, path)
    return files.exists(where)


def is_file(spark: SparkSession, path: str) -> bool:
    """Whether ``path`` is one file, not a folder or a pattern."""
    files, where = _filesystem(spark, path)
    return files.exists(where) and files.getFileStatus(where).isFile()


def last_version(spark: SparkSession, target: str, prefix: str = "version=") -> int:
    """The highest version folder there is, 0 without one (names only are listed)."""
    files, where = _filesystem(spark, target)
    if not files.exists(where):
        return 0
    names = [status.getPath().getName() for status in files.listStatus(where)]
    return max((int(n.removeprefix(prefix)) for n in names if n.startswith(prefix)), default=0)


def output_size(spark: SparkSession, path: str) -> DataFrame:
    """Files and megabytes of a written output."""
    files = (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", "true")
        .option("pathGlobFilter", "part-*")
        .load(path)
        .select("path", "length")
    )
    return files.agg(
        F.count(F.lit(1)).alias("files"),
        F.round(F.coalesce(F.sum("length"), F.lit(0)) / F.lit(1024 * 1024), 2).alias("megabytes"),
    )
