"""File and batch names."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Name formats.
BATCH_FILE = r"batch_(\d+)_\d+[^/]*\z"
BATCH_FOLDER = r"batch_(\d+)_\d+[^/]*/[^/]*\z"
FILENAME_SEPARATOR = "||"


def batch_number(name: Column) -> Column:
    """The first row of the batch a file's name speaks of, or else its folder's.

    0 when neither names one; folders further up do not count.
    """
    found = [F.regexp_extract(name, pattern, 1).try_cast("bigint") for pattern in (BATCH_FILE, BATCH_FOLDER)]
    return F.coalesce(*found, F.lit(0).cast("bigint"))


def batch_id(index: Column, size: int) -> Column:
    return F.call_function("div", index, F.lit(size)).cast("bigint")


def batch_name(first: Column, end: Column) -> Column:
    return F.concat(F.lit("batch_"), first.cast("string"), F.lit("_"), end.cast("string"))


def image_name(row_id: Column, position: Column, image_format: str) -> Column:
    return F.concat(
        row_id.cast("string"), F.lit("_"), position.cast("string"), F.lit("." + image_format.lower())
    )


def image_names(row_id: Column, images: Column, image_format: str) -> Column:
    names = F.transform(images, lambda _, i: image_name(row_id, i, image_format))
    return F.array_join(names, FILENAME_SEPARATOR)
