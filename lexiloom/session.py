"""Session settings and the shared folder for staged tables."""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # Split oversized join partitions even where that costs one more shuffle.
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # Rows handed to a Python function at a time; texts can be long.
    "spark.sql.execution.arrow.maxRecordsPerBatch": "2000",
}


def build_session(master: str | None = None, **extra: str) -> SparkSession:
    builder = SparkSession.builder.appName("lexiloom")
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **extra}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor can reach, as the cluster names it.

    A folder of this machine is made only where the session runs on this
    machine alone; on a cluster without the setting this is an error.
    """
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if named:
        return named.rstrip("/")
    if not re.fullmatch(r"local(\[[^\]]*\])?", spark.sparkContext.master):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
    spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="lexiloom-"))
    return spark.sparkContext.getCheckpointDir()


# A property of the thread: the folder of the innermost `staging` it is in.
OWNER = "lexiloom.staging"


def new_folder(spark: SparkSession, label: str) -> str:
    """A path under the shared folder that no other run uses."""
    inside = spark.sparkContext.getLocalProperty(OWNER) or f"{shared_folder(spark)}/lexiloom"
    return f"{inside}/{label}-{uuid.uuid4().hex}"


@contextmanager
def staging(spark: SparkSession) -> Iterator[None]:
    """Owns the tables staged inside it by this thread and removes them at its end.

    They lie in a folder of its own, so what other threads stage meanwhile is left
    alone. A DataFrame made inside still reads them, so write its result before the end.
    """
    path = new_folder(spark, "owned")
    outside = spark.sparkContext.getLocalProperty(OWNER)
    spark.sparkContext.setLocalProperty(OWNER, path)
    try:
        yield
    finally:
        spark.sparkContext.setLocalProperty(OWNER, outside)
        where = spark._jvm.org.apache.hadoop.fs.Path(path)
        where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)


def stage(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` once and go on from the written table.

    Cuts lineage in a way that survives lost executors, and keeps costly
    columns (a translation) from being computed again by each reader.
    """
    spark = df.sparkSession
    path = new_folder(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
