"""Row filters by what a detector finds in a list of payloads."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import IntegralType

from lexiloom.functions.text import has_han
from lexiloom.operators.skew import join_spread
from lexiloom.session import stage

# A native detector is an expression on one payload; an outside one is a
# factory (called once per partition) of a function on one payload.
NativeDetector = Callable[[Column], Column]
DetectorFactory = Callable[[], Callable[[bytes], bool]]


# Bitmaps broadcast at a time, 4 KB each.
BITMAP_BUCKETS = 8192

# Outcomes of a row.
KEPT, DROPPED, NO_LIST = "kept", "dropped", "without_list"


class Unreadable(Exception):
    """What a detector raises for a payload it cannot open; anything else stops the job."""

    # Looked at in place of the class, of which a worker may have two copies.
    payload_unreadable = True


def han_payload(payload: Column) -> Column:
    """Native detector: the payload, read as UTF-8 text, contains Han characters."""
    return has_han(F.make_valid_utf8(payload.cast("string")))


def any_detected(images: Column, detector: NativeDetector) -> Column:
    """True when some payload is detected; NULL payloads count as not detected."""
    return F.coalesce(F.exists(images, lambda p: F.coalesce(detector(p), F.lit(False))), F.lit(False))


def _row_hit(detect: Callable[[bytes], bool], payloads: Iterable[bytes] | None) -> bool:
    """Whether one row has a hit; stops at the first, passes over unreadable ones."""
    for payload in payloads if payloads is not None else ():
        if payload is None:
            continue
        try:
            if detect(payload):
                return True
        except Exception as error:
            if not getattr(error, "payload_unreadable", False):
                raise
    return False


def outside_detector(factory: DetectorFactory) -> Callable[[Column], Column]:
    """A payload-list expression from a Python detector.

    The list goes to Python as it is, so rows are not exploded, regrouped or
    shuffled, and no other column leaves the JVM.
    """

    @F.pandas_udf("boolean")
    def any_hit(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        detect = factory()
        for rows in batches:
            yield pd.Series([_row_hit(detect, payloads) for payloads in rows], dtype="bool")

    return any_hit.asNondeterministic()


def _require_images(df: DataFrame, images: str) -> DataFrame:
    if images not in df.columns:
        raise ValueError(f"no column {images!r} to look into")
    return df.filter(F.col(images).isNotNull())


def without_list(df: DataFrame, images: str = "images") -> DataFrame:
    """The rows no filter here looks at: those without a payload list."""
    return df.filter(F.col(images).isNull())


def flag_detections(
    df: DataFrame,
    images: str = "images",
    native: NativeDetector = han_payload,
    outside: DetectorFactory | None = None,
) -> DataFrame:
    """Adds ``detected``; rows without a payload list are left out."""
    hit = outside_detector(outside)(F.col(images)) if outside else any_detected(F.col(images), native)
    return _require_images(df, images).withColumn("detected", hit)


def with_outcome(
    df: DataFrame,
    images: str = "images",
    native: NativeDetector = han_payload,
    outside: DetectorFactory | None = None,
    name: str = "outcome",
) -> DataFrame:
    """All rows with what becomes of them: kept, dropped for a hit, or without a list."""
    if images not in df.columns:
        raise ValueError(f"no column {images!r} to look into")
    hit = outside_detector(outside)(F.col(images)) if outside else any_detected(F.col(images), native)
    told = F.when(F.col(images).isNull(), F.lit(NO_LIST)).when(F.col("_hit"), F.lit(DROPPED)).otherwise(F.lit(KEPT))
    return df.withColumn("_hit", hit).withColumn(name, told).drop("_hit")


def outcome_counts(outcome: str = "outcome") -> list[Column]:
    """Aggregates for ``DataFrame.observe`` over rows with an outcome."""
    is_ = lambda value: F.count_if(F.col(outcome) == value)
    return [
        (is_(KEPT) + is_(DROPPED)).alias("scanned"),
        is_(KEPT).alias("kept"),
        is_(DROPPED).alias("dropped"),
        is_(NO_LIST).alias("without_list"),
    ]


def without_detections(df: DataFrame, images: str = "images", **detector: object) -> DataFrame:
    """Rows in which nothing is detected; an empty list is kept."""
    return flag_detections(df, images, **detector).filter(~F.col("detected")).drop("detected")


def without_rejected(df: DataFrame, rejected: DataFrame, index: str, buckets: int = BITMAP_BUCKETS) -> DataFrame:
    """Rows of ``df`` whose whole number ``index`` is not in ``rejected`` (one column).

    The rejected numbers become bitmaps of 32,768 each, 4 KB a bitmap, which are
    broadcast and tested where the rows lie; no row of ``df`` is shuffled. At most
    ``buckets`` bitmaps (32 MB by default) are broadcast at a time: beyond that the
    numbers are worked on range by range, and of a table stored in their order
    each range reads only its own files. A NULL number is not rejected.
    """
    return _by_number(df, rejected, index, False, buckets)


def only_chosen(df: DataFrame, chosen: DataFrame, index: str, buckets: int = BITMAP_BUCKETS) -> DataFrame:
    """In the same way the rows whose number is in ``chosen``; a NULL number is not."""
    return _by_number(df, chosen, index, True, buckets)


def _by_number(df: DataFrame, numbers: DataFrame, index: str, keep: bool, buckets: int) -> DataFrame:
    number = F.col(numbers.columns[0])
    bitmaps = stage(
        numbers.filter(number.isNotNull())
        .groupBy(F.bitmap_bucket_number(number).alias("_bucket"))
        .agg(F.bitmap_construct_agg(F.bitmap_bit_position(number)).alias("_bitmap")),
        "bitmaps",
    )
    low, high = bitmaps.agg(F.min("_bucket"), F.max("_bucket")).first()
    if low is None:
        return df.filter(F.lit(False)) if keep else df
    bucket, position = F.bitmap_bucket_number(F.col(index)), F.bitmap_bit_position(F.col(index))
    byte = F.conv(F.hex(F.substring("_bitmap", F.call_function("div", position, F.lit(8)).cast("int") + 1, F.lit(1))), 16, 10)
    hit = F.call_function("shiftright", byte.cast("int"), (position % 8).cast("int")).bitwiseAND(F.lit(1)) == 1

    def tested(rows: DataFrame, some: DataFrame) -> DataFrame:
        joined = rows.withColumn("_bucket", bucket).join(F.broadcast(some), "_bucket", "left")
        return joined.filter(F.coalesce(hit, F.lit(False)) == keep).select(*[F.col(f"`{c}`") for c in df.columns])

    if high - low < buckets:
        return tested(df, bitmaps)
    outside = F.coalesce((bucket < low) | (bucket > high), F.lit(True))
    out = df.filter(F.lit(False) if keep else outside)
    for first in range(low, high + 1, buckets):
        inside = lambda b: (b >= first) & (b < first + buckets)  # noqa: B023, E731
        out = out.unionByName(tested(df.filter(inside(bucket) & (bucket <= high)), bitmaps.filter(inside(F.col("_bucket")))))
    return out


def _without(rows: DataFrame, hits: DataFrame, row_id: str) -> DataFrame:
    """By bitmaps where rows are numbered, else by an anti-join on the ids."""
    if isinstance(rows.schema[row_id].dataType, IntegralType):
        return without_rejected(rows, hits, row_id)
    return rows.join(hits, row_id, "left_anti")


def without_detections_anti(
    df: DataFrame, row_id: str, images: str = "images", native: NativeDetector = han_payload
) -> DataFrame:
    """The same rows by the ids of rows with a hit.

    For hits that come from another table. Of the hits only ids are shuffled, and
    where ids are whole numbers no row of ``df`` is; the form above needs no
    shuffle at all and is the default.
    """
    rows = _require_images(df, images)
    hits = (
        rows.select(row_id, F.explode(images).alias("_payload"))
        .filter(native(F.col("_payload")))
        .select(row_id)
        .distinct()
    )
    return _without(rows, hits, row_id)


def file_address(path: Column) -> Column:
    """One spelling per file: ``/x``, ``file:/x`` and ``file:///x`` are the same."""
    bare = F.regexp_replace(path, r"^file:/+", "/")
    return F.when(F.startswith(bare, F.lit("/")), F.concat(F.lit("file:"), bare)).otherwise(bare)


def without_detections_by_path(
    df: DataFrame,
    files: DataFrame,
    row_id: str,
    images: str = "images",
    native: NativeDetector = han_payload,
    outside: DetectorFactory | None = None,
) -> DataFrame:
    """The filter for rows that name files: ``images`` is a list of paths.

    ``files`` is (path, payload), as ``readers.scan_binary`` gives it. Each file
    is looked at once, however many rows name it, and no payload is shuffled:
    only paths of hits and row ids are. Paths without a file count as unreadable;
    ``paths_without_file`` names them.
    """
    rows = _require_images(df, images)
    payload = F.array("payload")
    hit = outside_detector(outside)(payload) if outside else any_detected(payload, native)
    hit_paths = files.withColumn("_hit", hit).filter("_hit").select(file_address(F.col("path")).alias("path")).distinct()
    named = rows.select(row_id, F.explode(images).alias("path")).withColumn("path", file_address(F.col("path")))
    uses = stage(named.groupBy("path").agg(F.count(F.lit(1)).alias("uses")), "path-uses")
    hits = join_spread(named, hit_paths, "path", [row_id], uses, "inner").select(row_id).distinct()
    return _without(rows, hits, row_id)


def paths_without_file(df: DataFrame, files: DataFrame, images: str = "images") -> DataFrame:
    """(path): what rows name and ``files`` does not have."""
    named = _require_images(df, images).select(F.explode(images).alias("path"))
    there = files.select(file_address(F.col("path")).alias("path"))
    wanted = named.select(file_address(F.col("path")).alias("path")).filter("path IS NOT NULL").distinct()
    return wanted.join(there, "path", "left_anti")


def detection_stats(df: DataFrame, images: str = "images", **detector: object) -> DataFrame:
    """Scanned, kept and dropped row counts, as one row."""
    flagged = flag_detections(df, images, **detector)
    return flagged.agg(
        F.count(F.lit(1)).alias("scanned"),
        F.count_if(~F.col("detected")).alias("kept"),
        F.count_if(F.col("detected")).alias("dropped"),
    )
