"""Image-row exports: the manifest and the asset table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexiloom.functions.names import image_name, image_names
from lexiloom.schemas import MANIFEST_COLUMNS, conform


def _with_images(df: DataFrame) -> DataFrame:
    return df.filter(F.size("images") > 0)


def manifest(
    df: DataFrame, image_format: str = "png", limit: int | None = None, order: str = "id"
) -> DataFrame:
    """One line per row with images; ``limit`` counts the lines written.

    The first lines by ``order``, numbers by their value and before other texts.
    """
    rows = _with_images(df)
    if limit is not None:
        number = F.col(order).cast("string").try_cast("decimal(38,0)")
        rows = rows.orderBy(number.asc_nulls_last(), order).limit(limit)
    empty = F.lit("")
    named = rows.select(
        "id",
        image_names(F.col("id"), F.col("images"), image_format).alias("image_filenames"),
        F.replace(F.coalesce("problem", empty), F.lit("\n"), F.lit(" ")).alias("problem"),
        F.coalesce("answer", empty).alias("answer"),
        F.coalesce(F.col("pass").cast("string"), empty).alias("pass"),
    )
    return conform(named, MANIFEST_COLUMNS)


def asset_table(df: DataFrame, image_format: str = "png") -> DataFrame:
    """(image_filename, payload): the payloads under their manifest names."""
    return (
        _with_images(df)
        .select("id", F.posexplode("images").alias("_at", "payload"))
        .select(image_name(F.col("id"), F.col("_at"), image_format).alias("image_filename"), "payload")
    )
