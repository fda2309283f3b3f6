"""Substring dedup: repeated passages found by seed and extend.

A window is ``WINDOW`` consecutive words of one document; a word goes when a window
over it starts anywhere else too. Every window is named by one of its 10-word
anchors, the one with the smallest hash (winnowing). Windows next to each other
mostly share their anchor, so a document has about one seed per 13 words: anchor,
the run of windows that have it, and the hash of all words of that run.

Equal windows have equal anchors, so seeds are joined on the anchor only:

* an anchor that occurs once has no repeated window;
* an anchor whose seeds all have the same run is repeated with its whole run,
  however many copies there are: the maximal match goes on past both ends;
* the others are where matches begin or end. One seed per different run is
  extended word by word, as window hashes, and these are counted.

Copies are folded by anchor and run before each shuffle, pairs are never made.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexiloom.llm.words import BASE, BASE_INVERSE, PLAIN, Words, longs, mix, pieces, powers, split_words, sums_between
from lexiloom.session import stage

WINDOW = 35
ANCHOR = 10


def row_keys(df: DataFrame) -> list[Column]:
    """128 bits that tell rows of different id or text apart, never null."""
    return [
        F.xxhash64("doc_id", "text").alias("k1"),
        F.xxhash64("text", F.lit(7), "doc_id").alias("k2"),
    ]


def first_smallest(values: np.ndarray, width: int) -> np.ndarray:
    """Position of the first smallest of ``width`` values from each position on."""
    n = len(values)
    best, place, have = values.copy(), np.arange(n), 1
    while have < width:
        step = min(have, width - have)
        m = len(best) - step
        later = best[step:] < best[:m]
        best = np.where(later, best[step:], best[:m])
        place = np.where(later, place[step:], place[:m])
        have += step
    return place


def seeds_of(words: Words, window: int, anchor: int):
    """Row, first window, number of windows, anchor hash and run hash of each seed."""
    n = len(words.hashes)
    empty = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.uint64), np.zeros(0, np.uint64)
    if n < window:
        return empty
    total = np.zeros(n + 1, np.uint64)
    np.cumsum(words.hashes * powers(BASE, n), out=total[1:])
    inverse = powers(BASE_INVERSE, n)
    grams = mix((total[anchor:] - total[:-anchor]) * inverse[: n - anchor + 1])
    place = first_smallest(grams, window - anchor + 1)
    row = words.rows()
    starts = np.flatnonzero(np.arange(len(place)) + window <= np.repeat(words.first[1:], words.counts)[: len(place)])
    if not len(starts):
        return empty
    chosen = place[starts]
    new = np.ones(len(starts), bool)
    new[1:] = (chosen[1:] != chosen[:-1]) | (row[starts][1:] != row[starts][:-1])
    head = np.flatnonzero(new)
    begin, many = starts[head], np.diff(np.append(head, len(starts)))
    length = (many + window - 1).astype(np.uint64)
    run = mix((total[begin + many + window - 1] - total[begin]) * inverse[begin] + length * np.uint64(0x2545F4914F6CDD1D))
    return row[begin], begin, many, grams[chosen[head]], run


def _lists(values: np.ndarray, first: np.ndarray, kind) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(first.astype(np.int32)), pa.array(values, kind))


def _find_seeds(window: int, anchor: int):
    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in pieces(batches, "text"):
            words = split_words(piece.column("text"), PLAIN)
            row, begin, many, anchors, runs = seeds_of(words, window, anchor)
            first = np.searchsorted(row, np.arange(piece.num_rows + 1))
            yield pa.RecordBatch.from_arrays(
                [
                    piece.column("k1"),
                    piece.column("k2"),
                    _lists(anchors.view(np.int64), first, pa.int64()),
                    _lists(runs.view(np.int64), first, pa.int64()),
                    _lists((begin - words.first[row]).astype(np.int32), first, pa.int32()),
                    _lists(many.astype(np.int32), first, pa.int32()),
                ],
                ["k1", "k2", "anchors", "runs", "starts", "sizes"],
            )

    return find


def _extend(window: int, anchor: int):
    """Window hashes of the chosen seeds of each row."""

    def extend(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in pieces(batches, "text"):
            words = split_words(piece.column("text"), PLAIN)
            _, hashes = words.windows(window)
            seeds = piece.column("seeds").to_pylist()
            out: list[tuple] = []
            for r, mine in enumerate(seeds):
                for s in mine:
                    at = words.first[r] + s["start"]
                    out += [(s["anchor"], s["run"], j, int(h)) for j, h in enumerate(hashes[at : at + s["size"]].view(np.int64))]
            yield pa.RecordBatch.from_arrays(
                [pa.array([o[i] for o in out], kind) for i, kind in enumerate((pa.int64(), pa.int64(), pa.int32(), pa.int64()))],
                ["anchor", "run", "at", "window"],
            )

    return extend


def _cut(window: int):
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in pieces(batches, "text"):
            words = split_words(piece.column("text"), PLAIN)
            counts = words.counts
            change = np.zeros(len(words.start) + 1, np.int64)
            for r, mine in enumerate(piece.column("repeats").to_pylist()):
                for s in mine or ():
                    at = words.first[r] + s["start"]
                    if s["windows"] is None:
                        change[at] += 1
                        change[at + s["size"] + window - 1] -= 1
                        continue
                    for j in range(s["size"]):
                        if s["windows"] >> j & 1:
                            change[at + j] += 1
                            change[at + j + window] -= 1
            gone = np.cumsum(change[:-1]) > 0
            removed = sums_between(gone.astype(np.int64), words.first[:-1], words.first[1:])
            kept = []
            for r in range(len(counts)):
                texts = words.texts(r)
                if removed[r]:
                    low = words.first[r]
                    texts = [t for t, g in zip(texts, gone[low : low + counts[r]].tolist()) if not g]
                kept.append(b" ".join(texts))
            columns = {name: piece.column(name) for name in piece.schema.names if name not in ("repeats", "text")}
            columns |= {
                "n_words": longs(counts),
                "n_removed": longs(removed),
                "kept_sha256": pa.array([hashlib.sha256(k).hexdigest() for k in kept]),
                "kept": pa.array(kept, pa.binary()).cast(pa.string()),
            }
            yield pa.RecordBatch.from_arrays(list(columns.values()), names=list(columns))

    return cut


def repeated_windows(docs: DataFrame, window: int = WINDOW, anchor: int = ANCHOR) -> DataFrame:
    """(k1, k2) of each document with repeats, and ``repeats``: seeds (start, size)
    with a bit per repeated window, or null for all windows of the seed."""
    seeds = stage(
        docs.select(*row_keys(docs), "text").mapInArrow(
            _find_seeds(window, anchor),
            "k1 long, k2 long, anchors array<long>, runs array<long>, starts array<int>, sizes array<int>",
        ),
        "seeds",
    )
    each = seeds.select("k1", "k2", F.inline(F.arrays_zip("anchors", "runs", "starts", "sizes")))
    # One row per anchor, folded before the shuffle. Joined as a table of its own,
    # so that Spark may split the seeds of a hot anchor over several tasks.
    shared = (
        each.groupBy(F.col("anchors").alias("anchor"))
        .agg(F.count(F.lit(1)).alias("n"), F.min("runs").alias("low"), F.max("runs").alias("high"))
        .filter("n > 1")
        .select("anchor", (F.col("low") != F.col("high")).alias("mixed"))
    )
    shared = stage(shared, "shared-anchors")
    hits = stage(
        each.withColumnRenamed("anchors", "anchor")
        .join(shared, "anchor")
        .select("k1", "k2", "anchor", F.col("runs").alias("run"), F.col("starts").alias("start"), F.col("sizes").alias("size"), "mixed"),
        "seed-hits",
    )
    mixed = hits.filter("mixed")
    chosen = mixed.groupBy("anchor", "run").agg(
        F.count(F.lit(1)).alias("n"), F.min(F.struct("k1", "k2", "start", "size")).alias("at")
    )
    chosen = stage(chosen.select("anchor", "run", "n", "at.*"), "seed-runs")
    wanted = chosen.groupBy("k1", "k2").agg(F.collect_list(F.struct("anchor", "run", "start", "size")).alias("seeds"))
    texts = docs.select(*row_keys(docs), "text").join(wanted, ["k1", "k2"]).select("text", "seeds")
    # A row that is in the table twice is extended twice; its windows are the same.
    windows = (
        texts.mapInArrow(_extend(window, anchor), "anchor long, run long, at int, window long")
        .distinct()
        .join(chosen.select("anchor", "run", "n"), ["anchor", "run"])
    )
    windows = stage(windows, "seed-windows")
    repeated = windows.groupBy("anchor", "window").agg(F.sum("n").alias("total")).filter("total > 1").select("anchor", "window")
    bits = (
        windows.join(repeated, ["anchor", "window"])
        .groupBy("anchor", "run")
        .agg(F.bit_or(F.expr("shiftleft(1L, at)")).alias("windows"))
    )
    bits = stage(bits, "seed-bits")  # a table of its own, as above
    partly = mixed.join(bits, ["anchor", "run"]).select("k1", "k2", "start", "size", "windows")
    whole = hits.filter("NOT mixed").select("k1", "k2", "start", "size", F.lit(None).cast("bigint").alias("windows"))
    return (
        whole.unionByName(partly)
        .groupBy("k1", "k2")
        .agg(F.collect_set(F.struct("start", "size", "windows")).alias("repeats"))
    )


def drop_repeats(docs: DataFrame, window: int = WINDOW, anchor: int = ANCHOR) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text): doc_id, n_words, n_removed,
    kept_sha256, kept (the words left, joined by one space).

    A null text has no words; a text shorter than a window loses nothing; rows
    that are in the table twice repeat each other, null ids included; no rows
    give no rows. ``window - anchor`` must be below 63.
    """
    assert anchor <= window < anchor + 63
    repeats = stage(repeated_windows(docs, window, anchor), "repeats")
    ids = docs.schema["doc_id"].dataType.simpleString()
    joined = docs.select("doc_id", "text", *row_keys(docs)).join(repeats, ["k1", "k2"], "left")
    return joined.select("doc_id", "text", "repeats").mapInArrow(
        _cut(window), f"doc_id {ids}, n_words long, n_removed long, kept_sha256 string, kept string"
    )
