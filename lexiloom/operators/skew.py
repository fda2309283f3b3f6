"""Joins that hold up when a few keys have most of the rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

HOT_KEYS = 256
SALTS = 64
# A table within both bounds may be broadcast.
SMALL_ROWS = 200_000
SMALL_BYTES = 32 * 1024 * 1024


def is_small(written: DataFrame, texts: list[str]) -> bool:
    """Whether a written table may be broadcast, by its rows and its text bytes."""
    size = sum((F.coalesce(F.octet_length(c), F.lit(0)) for c in texts), F.lit(0).cast("bigint"))
    rows, total = written.agg(F.count(F.lit(1)), F.coalesce(F.sum(size), F.lit(0))).first()
    return rows <= SMALL_ROWS and total <= SMALL_BYTES


def join_spread(
    left: DataFrame,
    right: DataFrame,
    key: str,
    spread_on: list[str],
    uses: DataFrame,
    how: str = "left",
) -> DataFrame:
    """Join on ``key`` (unique in ``right``) with the hottest keys salted.

    ``uses`` holds (``key``, ``uses``): how often each key occurs on the left,
    one row per key, from a written table (both sides must see the same top).
    Its top ``HOT_KEYS`` rows, as 8-byte hashes, are the only thing broadcast,
    so the broadcast has a fixed size; a key outside them holds less than one
    in ``HOT_KEYS`` of the rows. Left rows of a hot key are spread over
    ``SALTS`` groups by ``spread_on`` (columns that tell rows apart); the one
    matching right row is repeated for each group. No row is left out.
    """
    hot = (
        uses.orderBy(F.desc("uses"), key)
        .limit(HOT_KEYS)
        .select(F.xxhash64(key).alias("_hash"))
        .distinct()
        .withColumn("_hot", F.lit(True))
    )
    is_hot = F.coalesce(F.col("_hot"), F.lit(False))
    salted = (
        left.withColumn("_hash", F.xxhash64(key))
        .join(F.broadcast(hot), "_hash", "left")
        .withColumn(
            "_salt",
            F.when(is_hot, F.pmod(F.xxhash64(*spread_on), F.lit(SALTS)).cast("int")).otherwise(
                F.lit(0)
            ),
        )
        .drop("_hash", "_hot")
    )
    repeated = (
        right.withColumn("_hash", F.xxhash64(key))
        .join(F.broadcast(hot), "_hash", "left")
        .withColumn(
            "_salt",
            F.explode(
                F.when(is_hot, F.sequence(F.lit(0), F.lit(SALTS - 1))).otherwise(F.array(F.lit(0)))
            ),
        )
        .drop("_hash", "_hot")
    )
    return salted.join(repeated, [key, "_salt"], how).drop("_salt")
