"""Words of whole texts as numpy arrays, for use inside Arrow tasks.

A batch of texts becomes one byte buffer; words, lines and windows of words are
spans of it with 64-bit hashes. All separators are ASCII, so working on UTF-8
bytes gives the same words as working on characters. A null text has no words.
Memory is a small multiple of ``PIECE`` bytes, or of one text where that is longer.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Bytes of text handled at a time.
PIECE = 2 * 1024 * 1024
# Bytes hashed at a time; keeps the work arrays inside the cache.
SEGMENT = 1 << 14

_U = np.uint64


def _byte_set(*ranges: tuple[int, int]) -> np.ndarray:
    marked = np.zeros(256, bool)
    for low, high in ranges:
        marked[low : high + 1] = True
    return marked


# [^\x20\x09-\x0D]+
PLAIN = ~_byte_set((0x20, 0x20), (0x09, 0x0D))
# [^\x00-\x2F\x3A-\x60\x7B-\x7F]+, for lower-cased text
ALNUM = ~_byte_set((0x00, 0x2F), (0x3A, 0x60), (0x7B, 0x7F))
LOWER = np.arange(256, dtype=np.uint8)
LOWER[ord("A") : ord("Z") + 1] += 32

_random = np.random.default_rng(20_250_711)
_VALUES = _random.integers(1, 2**64, 256, dtype=_U)
BASE = 0x9E3779B97F4A7C15
BASE_INVERSE = pow(BASE, -1, 2**64)


def powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, _U)
    if n:
        out[0] = 1
    return np.cumprod(out, dtype=_U)


_POWERS = powers(BASE, SEGMENT + 1)
_INVERSES = powers(BASE_INVERSE, SEGMENT + 1)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values whose every output bit depends on all input bits."""
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


def sums_between(values: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    total = np.zeros(len(values) + 1, values.dtype)
    np.cumsum(values, out=total[1:])
    return total[end] - total[start]


def _long_span(data: np.ndarray) -> int:
    """The unmixed hash of one span of any length."""
    out, factor, step = 0, 1, pow(BASE, SEGMENT, 2**64)
    for at in range(0, len(data), SEGMENT):
        part = data[at : at + SEGMENT]
        out += factor * int((_VALUES[part] * _POWERS[: len(part)]).sum(dtype=_U))
        factor = factor * step % 2**64
    return out % 2**64


def hash_spans(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """64-bit hashes of byte spans that lie in order and do not overlap."""
    out = np.empty(len(start), _U)
    i = 0
    while i < len(start):
        j = max(i + 1, int(np.searchsorted(end, start[i] + SEGMENT, side="right")))
        low, high = start[i], end[j - 1]
        if high - low > SEGMENT:
            out[i] = _long_span(data[low:high])
        else:
            weighted = _VALUES[data[low:high]] * _POWERS[: high - low]
            out[i:j] = sums_between(weighted, start[i:j] - low, end[i:j] - low) * _INVERSES[start[i:j] - low]
        i = j
    return mix(out + (end - start).astype(_U) * _U(0xD6E8FEB86659FD93))


@dataclass
class Words:
    """``first[r]:first[r + 1]`` are the words of row r."""

    data: np.ndarray
    offsets: np.ndarray
    start: np.ndarray
    end: np.ndarray
    first: np.ndarray
    hashes: np.ndarray

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    def rows(self) -> np.ndarray:
        """The row of each word."""
        return np.repeat(np.arange(len(self.counts)), self.counts)

    def windows(self, size: int) -> tuple[np.ndarray, np.ndarray]:
        """Whether a window of ``size`` words of one row starts at each word; its hash."""
        hashes = window_hashes(self.hashes, size)
        last = np.repeat(self.first[1:], self.counts) - size
        return np.arange(len(self.start)) <= last, hashes

    def texts(self, row: int) -> list[bytes]:
        low, high = self.first[row], self.first[row + 1]
        raw = self.data[self.offsets[row] : self.offsets[row + 1]].tobytes()
        shift = self.offsets[row]
        return [raw[a:b] for a, b in zip((self.start[low:high] - shift).tolist(), (self.end[low:high] - shift).tolist())]


def window_hashes(hashes: np.ndarray, size: int) -> np.ndarray:
    """The hash of ``size`` consecutive values from each position on (0 past the last)."""
    n = len(hashes)
    out = np.zeros(n, _U)
    if n < size:
        return out
    total = np.zeros(n + 1, _U)
    np.cumsum(hashes * powers(BASE, n), out=total[1:])
    out[: n - size + 1] = mix((total[size:] - total[: n - size + 1]) * powers(BASE_INVERSE, n - size + 1) + _U(size))
    return out


def bytes_of(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of the rows, and where each row starts; a null row is empty."""
    texts = pc.fill_null(texts.cast(pa.large_string()), "")
    buffers = texts.buffers()
    offsets = np.frombuffer(buffers[1], np.int64, len(texts) + 1, texts.offset * 8)
    data = np.frombuffer(buffers[2], np.uint8) if buffers[2] is not None else np.zeros(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def spans(inside: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start and end of each run of marked bytes; runs end with their row."""
    begin, stop = inside.copy(), inside.copy()
    begin[1:] &= ~inside[:-1]
    stop[:-1] &= ~inside[1:]
    heads = offsets[:-1][offsets[:-1] < len(inside)]
    begin[heads] = inside[heads]
    tails = offsets[1:][offsets[1:] > 0] - 1
    stop[tails] = inside[tails]
    return np.flatnonzero(begin), np.flatnonzero(stop) + 1


def split_words(texts: pa.Array, marked: np.ndarray = PLAIN, lower: bool = False) -> Words:
    data, offsets = bytes_of(texts)
    if lower:
        data = LOWER[data]
    start, end = spans(marked[data], offsets)
    return Words(data, offsets, start, end, np.searchsorted(start, offsets), hash_spans(data, start, end))


def pieces(batches: Iterator[pa.RecordBatch], column: str) -> Iterator[pa.RecordBatch]:
    """The same rows in pieces of at most ``PIECE`` bytes of text, or of one row."""
    for batch in batches:
        if not batch.num_rows:
            continue
        lengths = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
        total = np.cumsum(lengths.astype(np.int64))
        i = 0
        while i < batch.num_rows:
            before = total[i - 1] if i else 0
            j = max(i + 1, int(np.searchsorted(total, before + PIECE, side="right")))
            yield batch.slice(i, j - i)
            i = j
        del batch
        pa.default_memory_pool().release_unused()  # workers live on between stages


def set_aside(docs: DataFrame) -> tuple[DataFrame, list[Column]]:
    """``docs`` with every column but ``text`` renamed to c0, c1, …, so that added
    columns clash with none; and the expressions that give its columns back."""
    others = [c for c in docs.columns if c != "text"]
    renamed = docs.select("text", *(F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(others)))
    place = {c: f"c{i}" for i, c in enumerate(others)} | {"text": "text"}
    return renamed, [F.col(place[c]).alias(c) for c in docs.columns]


def binaries(values: np.ndarray, first: np.ndarray) -> pa.Array:
    """``values[first[r]:first[r + 1]]`` of each row as bytes."""
    offsets = first.astype(np.int32) * values.dtype.itemsize
    return pa.Array.from_buffers(pa.binary(), len(first) - 1, [None, pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(values))])


def longs(values: np.ndarray) -> pa.Array:
    return pa.array(values.view(np.int64) if values.dtype == _U else values.astype(np.int64))
