"""Incremental runs: new files through a transformation into an output table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery


def follow(
    spark: SparkSession,
    path: str,
    schema: str,
    pattern: str = "*.parquet",
    files_per_trigger: int | None = None,
    bytes_per_trigger: int | None = None,
) -> DataFrame:
    """A stream of the Parquet files that arrive under ``path``.

    ``path`` is a folder or a name pattern; a table that is one single file has
    to be given by a pattern. How much one micro-batch takes, and so how often
    the output is flushed, is set by files or by bytes.
    """
    reader = spark.readStream.schema(schema).option("pathGlobFilter", pattern)
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    if bytes_per_trigger:
        reader = reader.option("maxBytesPerTrigger", bytes_per_trigger)
    return reader.parquet(path)


def run_incremental(
    stream: DataFrame,
    transform: Callable[[DataFrame], DataFrame],
    output: str,
    checkpoint: str,
    every: str | None = None,
    partition_by: str | None = None,
) -> StreamingQuery:
    """Append ``transform(stream)`` to ``output``, each input file exactly once.

    Without ``every`` all waiting files are handled and the query ends; with it
    (``"5 seconds"``) the query goes on. Started again with the same
    checkpoint, it continues where the output ended.
    """
    writer = (
        transform(stream)
        .writeStream.format("parquet")
        .outputMode("append")
        .option("path", output)
        .option("checkpointLocation", checkpoint)
    )
    if partition_by:
        writer = writer.partitionBy(partition_by)
    trigger = {"processingTime": every} if every else {"availableNow": True}
    return writer.trigger(**trigger).start()


def run_to_end(*args: object, **kwargs: object) -> None:
    """As ``run_incremental``, waiting until the waiting files are done."""
    run_incremental(*args, **kwargs).awaitTermination()
