"""Benchmark decontamination by a prefix-filtered set join.

Every benchmark item is a set of windows (10 words, or the whole item where it is
shorter). A window is contained in a document only if all its shingles are, so
its prefix, for full containment, is its one rarest shingle: documents are probed
with those only. A probe gives the place where the window would lie; places that
do not fit into the document are dropped, the others compared word by word.

Rarity is counted over all documents. The benchmark is cut into parts of at most
``PART_WINDOWS`` windows, each broadcast by itself, so the size of a broadcast
does not depend on the benchmark's; documents are read once per part and never
shuffled.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexiloom.llm.words import ALNUM, longs, pieces, set_aside, split_words
from lexiloom.session import stage

WINDOW = 10
SHINGLE = 3
# Distinct windows, and distinct shingles, of one broadcast: about 100 MB at most.
PART_WINDOWS = 500_000
RESULTS = ("n_words", "starts", "ends", "items")


def _windows_of_items(window: int, shingle: int):
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in pieces(batches, "text"):
            words = split_words(piece.column("text"), ALNUM, lower=True)
            ids = piece.column("item_id").to_pylist()
            out = []
            for row, n in enumerate(words.counts.tolist()):
                hashes = words.hashes[words.first[row] : words.first[row + 1]].view(np.int64)
                size = min(window, n)
                for start in range(n - size + 1 if n else 0):
                    out.append((ids[row], hashes[start : start + size].tobytes(), size))
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([o[0] for o in out], pa.string()),
                    pa.array([o[1] for o in out], pa.binary()),
                    pa.array([o[2] for o in out], pa.int32()),
                ],
                ["item_id", "words", "size"],
            )

    return cut


def _shingles_of_windows(shingle: int):
    """One row per shingle of a window, and where in the window it is."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            window, found, at = [], [], []
            for words in batch.column("words").to_pylist():
                hashes = np.frombuffer(words, np.uint64)
                size = min(shingle, len(hashes))
                starts = range(len(hashes) - size + 1)
                window += [words] * len(starts)
                found.append(shingle_hashes(hashes, size)[: len(starts)])
                at += starts
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(window, pa.binary()),
                    longs(np.concatenate(found) if found else np.zeros(0, np.uint64)),
                    pa.array(at, pa.int32()),
                ],
                ["words", "shingle", "at"],
            )

    return cut


def shingle_hashes(hashes: np.ndarray, size: int) -> np.ndarray:
    """Hash of ``size`` (at most a few) consecutive words; one pass per word."""
    out = np.zeros(len(hashes), np.uint64)
    if len(hashes) >= size:
        total = out[: len(hashes) - size + 1]
        for j in range(size):
            total *= np.uint64(0x9E3779B97F4A7C15)
            total ^= hashes[j : len(hashes) - size + 1 + j]
        total += np.uint64(size)
    return out


def _places(sorted_values: np.ndarray, probes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Positions of the probes that are among the values; their place there.

    A table of the values' 20 leading bits turns most probes away before the search.
    """
    if not len(sorted_values):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    known = np.zeros(1 << 20, bool)
    known[sorted_values >> np.uint64(44)] = True
    at = np.flatnonzero(known[probes >> np.uint64(44)])
    place = np.searchsorted(sorted_values, probes[at])
    place[place == len(sorted_values)] = 0
    same = sorted_values[place] == probes[at]
    return at[same], place[same]


def _count_shingles(shared, shingle: int):
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = shared.value
        total = np.zeros(len(known), np.int64)
        for piece in pieces(batches, "text"):
            words = split_words(piece.column("text"), ALNUM, lower=True)
            last = np.repeat(words.first[1:], words.counts)
            for size in range(1, shingle + 1):
                at, place = _places(known, shingle_hashes(words.hashes, size))
                fits = at + size <= last[at]
                total += np.bincount(place[fits], minlength=len(known))
        seen = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([longs(known[seen]), longs(total[seen])], ["shingle", "n"])

    return count


@dataclass
class Index:
    """The windows of one part, by their rarest shingle.

    Windows ``by_probe[j]:by_probe[j + 1]`` have ``probes[j]`` at their ``at``-th
    word. ``words[w]`` are the hashes of a window's words, ``items[w]`` the ids of
    the items that have it.
    """

    probes: np.ndarray
    by_probe: np.ndarray
    at: np.ndarray
    size: np.ndarray
    words: np.ndarray
    items: list[list[str]]

    @classmethod
    def of(cls, rows: list, window: int) -> Index:
        rows = sorted(rows, key=lambda r: (r["shingle"] % 2**64, r["words"]))
        shingle = np.array([r["shingle"] for r in rows], np.int64).view(np.uint64)
        words = np.zeros((len(rows), window), np.uint64)
        for i, r in enumerate(rows):
            words[i, : len(r["words"]) // 8] = np.frombuffer(r["words"], np.uint64)
        probes, first = np.unique(shingle, return_index=True)
        return cls(
            probes,
            np.append(first, len(rows)).astype(np.int64),
            np.array([r["at"] for r in rows], np.int64),
            np.array([len(r["words"]) // 8 for r in rows], np.int64),
            words,
            [sorted(r["items"]) for r in rows],
        )

    def occurrences(self, words, shingle: int) -> tuple[np.ndarray, np.ndarray]:
        """First word of each occurrence of a window, and the window."""
        starts, windows = [], []
        n = len(words.hashes)
        row_first = np.repeat(words.first[:-1], words.counts)
        row_last = np.repeat(words.first[1:], words.counts)
        for size in range(1, shingle + 1):
            at, place = _places(self.probes, shingle_hashes(words.hashes, size))
            many = self.by_probe[place + 1] - self.by_probe[place]
            head = np.repeat(at, many)
            skip = np.arange(len(head)) - np.repeat(np.cumsum(many) - many, many)
            window = np.repeat(self.by_probe[place], many) + skip
            start = head - self.at[window]
            fits = (
                (np.minimum(self.size[window], shingle) == size)
                & (start >= row_first[head])
                & (start + self.size[window] <= row_last[head])
            )
            start, window = start[fits], window[fits]
            same = np.ones(len(start), bool)
            for j in range(self.words.shape[1]):
                inside = j < self.size[window]
                same &= ~inside | (words.hashes[np.minimum(start + j, n - 1)] == self.words[window, j])
            starts.append(start[same])
            windows.append(window[same])
        return np.concatenate(starts), np.concatenate(windows)


def build_indexes(
    docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, shingle: int = SHINGLE, most: int = PART_WINDOWS
) -> Iterator[Index]:
    """The benchmark's windows with their rarest shingle, in parts of bounded size,
    one on the driver at a time."""
    spark = docs.sparkSession
    items = benchmark.select(F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("item_id"), "text")
    cut = items.mapInArrow(_windows_of_items(window, shingle), "item_id string, words binary, size int")
    windows = stage(cut.groupBy("words").agg(F.collect_set("item_id").alias("items")), "benchmark-windows")
    exploded = stage(
        windows.select("words").mapInArrow(_shingles_of_windows(shingle), "words binary, shingle long, at int"),
        "benchmark-shingles",
    )
    known = exploded.select("shingle").distinct()
    parts = max(1, -(-known.count() // most))
    rarity = None
    for part in range(parts):
        mine = known.filter(F.pmod(F.xxhash64("shingle"), F.lit(parts)) == part).toPandas()["shingle"]
        shared = spark.sparkContext.broadcast(np.sort(mine.to_numpy(np.int64).view(np.uint64)))
        found = docs.select("text").mapInArrow(_count_shingles(shared, shingle), "shingle long, n long")
        counts = stage(found.groupBy("shingle").agg(F.sum("n").alias("n")), "shingle-counts")
        shared.unpersist()
        rarity = counts if rarity is None else rarity.unionByName(counts)
    # A window with a shingle that no document has cannot occur.
    probes = stage(
        exploded.join(rarity, "shingle", "left")
        .groupBy("words")
        .agg(F.min(F.struct(F.coalesce("n", F.lit(0)).alias("n"), "shingle", "at")).alias("rarest"))
        .filter("rarest.n > 0")
        .join(windows, "words")
        .select("words", "items", "rarest.shingle", "rarest.at"),
        "benchmark-probes",
    )
    parts = max(1, -(-probes.count() // most))
    part_of = F.pmod(F.xxhash64("shingle", "words"), F.lit(parts))
    for part in range(parts):
        yield Index.of(probes.filter(part_of == part).collect(), window)


def _probe(shared, shingle: int):
    """Adds to (…, n_words, starts, ends, items) what one part finds."""

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = shared.value
        for piece in pieces(batches, "text"):
            words = split_words(piece.column("text"), ALNUM, lower=True)
            start, window = index.occurrences(words, shingle)
            row = np.searchsorted(words.first, start, side="right") - 1
            columns = {name: piece.column(name) for name in piece.schema.names}
            columns["n_words"] = longs(words.counts)
            if len(row):
                old = [piece.column(c).to_pylist() for c in ("starts", "ends", "items")]
                for r in np.unique(row):
                    mine = row == r
                    at = start[mine] - words.first[r]
                    spans = np.unique(np.stack([at, at + index.size[window[mine]]]), axis=1)
                    old[0][r] = (old[0][r] or []) + spans[0].tolist()
                    old[1][r] = (old[1][r] or []) + spans[1].tolist()
                    ids = {i for w in np.unique(window[mine]) for i in index.items[w]}
                    old[2][r] = sorted(ids.union(old[2][r] or []))
                for name, values in zip(("starts", "ends", "items"), old):
                    columns[name] = pa.array(values, piece.schema.field(name).type)
            yield pa.RecordBatch.from_arrays(list(columns.values()), names=list(columns))

    return search


def _covered(starts: list[int] | None, ends: list[int] | None) -> int:
    total, reached = 0, 0
    for a, b in sorted(zip(starts or (), ends or ())):
        total += max(0, b - max(a, reached))
        reached = max(reached, b)
    return total


def _sum_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    nothing = hashlib.sha256(b"").hexdigest()
    for batch in batches:
        starts, ends, items = (batch.column(c).to_pylist() for c in ("starts", "ends", "items"))
        hits = [_covered(a, b) for a, b in zip(starts, ends)]
        sha = [hashlib.sha256(",".join(i).encode()).hexdigest() if i else nothing for i in items]
        yield pa.RecordBatch.from_arrays(
            [
                batch.column("doc_id"),
                batch.column("n_words"),
                pa.array(hits, pa.int64()),
                pa.array([len(i or ()) for i in items], pa.int64()),
                pa.array(sha, pa.string()),
                pa.array([h > 0 for h in hits], pa.bool_()),
            ],
            ["doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated"],
        )


def find_benchmark_words(
    docs: DataFrame,
    benchmark: DataFrame,
    window: int = WINDOW,
    shingle: int = SHINGLE,
    part_windows: int = PART_WINDOWS,
) -> DataFrame:
    """Every column of ``docs`` and what was found in its ``text``.

    Added, or replaced where the names are taken: ``_n_words``; ``_starts`` and ``_ends``, word spans covered by a window;
    ``_items``, ids as strings of the items with a window there. Null or empty
    texts have no words; an item without words has no window; an item of fewer
    words than ``window`` is one window; a null item id counts as the empty string;
    repeated items and rows are found alike; an empty benchmark finds nothing.
    """
    renamed, back = set_aside(docs.drop(*(f"_{c}" for c in RESULTS)))
    found = _with_hits(renamed, benchmark, window, shingle, part_windows)
    return found.select(*back, *(F.col(c).alias(f"_{c}") for c in RESULTS))


def _with_hits(
    renamed: DataFrame,
    benchmark: DataFrame,
    window: int = WINDOW,
    shingle: int = SHINGLE,
    part_windows: int = PART_WINDOWS,
) -> DataFrame:
    spark = renamed.sparkSession
    indexes = build_indexes(renamed, benchmark, window, shingle, part_windows)
    found = renamed.select(
        "*",
        F.lit(0).cast("bigint").alias("n_words"),
        F.lit(None).cast("array<bigint>").alias("starts"),
        F.lit(None).cast("array<bigint>").alias("ends"),
        F.lit(None).cast("array<string>").alias("items"),
    )
    shared = None
    for index in indexes:
        if shared:  # one part in memory at a time, on the driver and on executors
            found = stage(found, "benchmark-hits")
            shared.unpersist()
        shared = spark.sparkContext.broadcast(index)
        found = found.mapInArrow(_probe(shared, shingle), found.schema)
    return found


def contamination(docs: DataFrame, benchmark: DataFrame, **settings) -> DataFrame:
    """One row per document: doc_id, n_words, n_hit, n_items, items_sha256, contaminated."""
    found = find_benchmark_words(docs.select("doc_id", "text"), benchmark, **settings)
    ids = docs.schema["doc_id"].dataType.simpleString()
    return found.select("doc_id", *(F.col(f"_{c}").alias(c) for c in RESULTS)).mapInArrow(
        _sum_up,
        f"doc_id {ids}, n_words long, n_hit long, n_items long, items_sha256 string, contaminated boolean",
    )


def without_benchmark(docs: DataFrame, benchmark: DataFrame, **settings) -> DataFrame:
    """The rows and columns of ``docs`` in which no window of the benchmark occurs.

    Null and empty texts stay, repeated rows stay or go alike, a text of any length
    is searched as a whole; columns of any name are kept. An empty benchmark takes
    nothing away; no rows give no rows.
    """
    renamed, back = set_aside(docs)
    found = _with_hits(renamed, benchmark, **settings)
    return found.filter(F.coalesce(F.size("starts"), F.lit(0)) <= 0).select(*back)
