"""Micro-batches as flushes: one folder each, by size or by time, with a log."""

from __future__ import annotations

import threading
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.listener import (
    QueryIdleEvent,
    QueryProgressEvent,
    QueryStartedEvent,
    QueryTerminatedEvent,
    StreamingQueryListener,
)

FLUSH_LOG = "flush BIGINT, flushed_at STRING, rows BIGINT, rows_per_second DOUBLE, millis BIGINT"
# Seconds to wait for the last events of a query that has ended.
LAST_EVENTS = 60


class _FlushLog(StreamingQueryListener):
    """Writes one row for each flush of one query; a flush done again replaces its row."""

    def __init__(self, spark: SparkSession, name: str, path: str):
        self.spark, self.name, self.path = spark, name, path
        self.run, self.ended, self.failure = None, threading.Event(), None

    def onQueryStarted(self, event: QueryStartedEvent) -> None:
        if event.name == self.name:
            self.run = event.runId

    def onQueryProgress(self, event: QueryProgressEvent) -> None:
        told = event.progress
        if told.name != self.name or not told.numInputRows:
            return
        row = (told.batchId, told.timestamp, told.numInputRows, told.processedRowsPerSecond, told.durationMs["triggerExecution"])
        try:
            one = self.spark.createDataFrame([row], FLUSH_LOG).coalesce(1)
            one.write.mode("overwrite").parquet(f"{self.path}/part={told.batchId}")
        except Exception as error:  # raised where the query is waited for
            self.failure = error

    def onQueryIdle(self, event: QueryIdleEvent) -> None:
        pass

    def onQueryTerminated(self, event: QueryTerminatedEvent) -> None:
        if event.runId == self.run:
            self.ended.set()


def flush_batches(
    stream: DataFrame,
    transform: Callable[[DataFrame], DataFrame],
    output: str,
    checkpoint: str,
    every: str | None = None,
    name: str | None = None,
) -> StreamingQuery:
    """Writes each micro-batch of ``transform(stream)`` to a folder named by its number.

    The folder is replaced as a whole, so a batch that Spark plays again after a
    failure leaves one copy, also where it has fewer rows the second time. How
    much a batch takes is set on the stream (files or bytes a trigger); ``every``
    (``"5 seconds"``) is how often one is made, without it all waiting files are
    handled and the query ends.
    """

    def write(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{output}/batch={number}")

    writer = transform(stream).writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
    if name:
        writer = writer.queryName(name)
    trigger = {"processingTime": every} if every else {"availableNow": True}
    return writer.trigger(**trigger).start()


def flush_every(
    stream: DataFrame,
    transform: Callable[[DataFrame], DataFrame],
    output: str,
    checkpoint: str,
    log: str,
    every: str,
    until: Callable[[StreamingQuery], None] = StreamingQuery.processAllAvailable,
) -> DataFrame:
    """Flushes by time until ``until(query)`` returns; gives back the log of the flushes.

    By default that is when all files there are have been handled. The log holds a
    row for each flush that had rows, over all runs with this ``log``: its
    number, time, rows, rows per second and milliseconds.
    """
    spark = stream.sparkSession
    name = f"flush-{uuid.uuid4().hex}"
    listener = _FlushLog(spark, name, log)
    spark.streams.addListener(listener)
    try:
        query = flush_batches(stream, transform, output, checkpoint, every, name)
        try:
            until(query)
        finally:
            query.stop()
        if not listener.ended.wait(LAST_EVENTS):
            raise TimeoutError("the last events of the query did not come")
    finally:
        spark.streams.removeListener(listener)
    if listener.failure:
        raise listener.failure
    return read_log(spark, log)


def read_log(spark: SparkSession, log: str) -> DataFrame:
    return spark.read.schema(FLUSH_LOG).option("recursiveFileLookup", "true").parquet(log)


def read_flushes(spark: SparkSession, output: str, schema: str) -> DataFrame:
    """All rows flushed so far, with the number of their batch as ``batch``."""
    rows = spark.read.schema(schema).option("recursiveFileLookup", "true").parquet(output)
    number = F.regexp_extract(F.col("_metadata.file_path"), r"/batch=(\d+)/[^/]*\z", 1)
    return rows.select("*", number.cast("bigint").alias("batch"))


def forget_commit(spark: SparkSession, checkpoint: str, number: int) -> None:
    """Takes back that a batch was done, as if the driver had failed right before
    telling so; the next run plays the batch again. For tests and repairs."""
    where = spark._jvm.org.apache.hadoop.fs.Path(f"{checkpoint}/commits/{number}")
    files = where.getFileSystem(spark._jsc.hadoopConfiguration())
    if not files.delete(where, False):
        raise FileNotFoundError(f"batch {number} is not committed")
