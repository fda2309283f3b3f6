"""Rows of a stream in the order of their ordinals, while they arrive."""

from __future__ import annotations

from collections.abc import Iterator
from typing import Any

from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

# Ordinals held by one state; what waits in it is never more than that.
RANGE_ROWS = 10_000

STATE_STORE = "spark.sql.streaming.stateStore.providerClass"
ROCKS_DB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


class _InOrder(StatefulProcessor):
    """Holds back rows of one range until all ordinals before them are there."""

    def __init__(self, index: str, schema: T.StructType, start: int, range_rows: int):
        self.index, self.schema, self.start, self.range_rows = index, schema, start, range_rows

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.upcoming = handle.getValueState("upcoming", T.StructType().add("index", "long"))
        self.waiting = handle.getListState("waiting", self.schema)

    def handleInputRows(self, key: Any, rows: Iterator[Row], timerValues: Any) -> Iterator[Row]:
        first = max(key[0] * self.range_rows, self.start)
        known = self.upcoming.get()
        upcoming = first if known is None else known[0]
        place = self.schema.names.index(self.index)
        held: dict[int, tuple] = {}
        for row in (*self.waiting.get(), *rows):
            if row[place] >= upcoming:  # earlier ones are out already
                held.setdefault(row[place], tuple(row[: len(self.schema)]))
        start = upcoming
        while upcoming in held:
            yield Row(**dict(zip(self.schema.names, held.pop(upcoming))))
            upcoming += 1
        if upcoming != start or known is None:
            self.upcoming.update((upcoming,))
        if held:
            self.waiting.put([held[i] for i in sorted(held)])
        else:
            self.waiting.clear()

    def close(self) -> None:
        pass


def in_order(stream: DataFrame, index: str = "index", start: int = 0, range_rows: int = RANGE_ROWS) -> DataFrame:
    """The rows of ``stream`` from ordinal ``start`` on, each once all ordinals before
    it in its range have come.

    A range is ``range_rows`` ordinals with a state of their own, so ranges are
    worked on side by side and no state holds more rows than that; inside a range
    rows leave in order and without gaps. What waits behind a gap stays in the
    checkpoint until the missing ordinal comes, in this run or a later one. Of an
    ordinal that comes twice the first row counts. A null or earlier ordinal has
    no place and its row is left out. The session is set to the state store that
    such states need.
    """
    stream.sparkSession.conf.set(STATE_STORE, ROCKS_DB)
    ranged = stream.filter(F.col(index) >= start).withColumn("_range", F.floor(F.col(index) / range_rows).cast("bigint"))
    return ranged.groupBy("_range").transformWithState(
        _InOrder(index, stream.schema, start, range_rows), stream.schema, "Append", "None"
    )


def gap_free(written: DataFrame, index: str = "index", start: int = 0, range_rows: int = RANGE_ROWS) -> DataFrame:
    """Of rows released by ``in_order``: those with no ordinal missing over all ranges.

    Each range is a prefix of itself, so the first range that is not full decides:
    what is compared is a row for each range, its count.
    """
    of = F.floor(F.col(index) / range_rows).cast("bigint").alias("range")
    counts = written.groupBy(of).agg(F.count(F.lit(1)).alias("rows"))
    full = counts.filter(F.col("rows") == range_rows - F.greatest(start - F.col("range") * range_rows, F.lit(0)))
    first = start // range_rows
    spark = written.sparkSession
    wanted = full.select((F.col("range") + 1).alias("range")).union(spark.range(first, first + 1).toDF("range"))
    broken = wanted.join(full, "range", "left_anti").agg(F.min("range")).scalar()
    return written.filter(F.floor(F.col(index) / range_rows) <= broken)
