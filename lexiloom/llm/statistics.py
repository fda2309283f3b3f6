"""Counts of a document that the quality operators work on."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from lexiloom.llm.words import PLAIN, hash_spans, longs, mix, pieces, spans, split_words

REPEAT = 8
COUNTS = (
    "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
    "n_lines", "n_upper", "n_lower", "n_digits", "n_marks", "n_other",
)

_SPACE, _SYMBOL, _UPPER, _LOWER, _DIGIT, _MARK, _OTHER, _INSIDE = range(8)
_CLASS = np.full(256, _MARK, np.uint8)
_CLASS[~PLAIN] = _SPACE
_CLASS[np.frombuffer(b"#*$%&|<>", np.uint8)] = _SYMBOL
_CLASS[ord("A") : ord("Z") + 1] = _UPPER
_CLASS[ord("a") : ord("z") + 1] = _LOWER
_CLASS[ord("0") : ord("9") + 1] = _DIGIT
_CLASS[0xC0:] = _OTHER
_CLASS[0x80:0xC0] = _INSIDE


def _seen_twice(row: np.ndarray, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Which values occur more than once in their row; which are not the first such."""
    keys = mix(hashes + (row + 1).astype(np.uint64) * np.uint64(0xD1B54A32D192ED03))
    ordered = np.sort(keys)
    twice = np.unique(ordered[1:][ordered[1:] == ordered[:-1]])
    again = np.zeros(len(keys), bool)
    if not len(twice):
        return again, again
    many = np.isin(keys, twice)
    at = np.flatnonzero(many)
    _, first = np.unique(keys[at], return_index=True)
    again[at] = True
    again[at[first]] = False
    return many, again


def count_all(texts: pa.Array) -> np.ndarray:
    """A row of ``COUNTS`` per text; zeros for a null one."""
    words = split_words(texts, PLAIN)
    rows, lengths = len(words.counts), np.diff(words.offsets)
    kinds = np.repeat(np.arange(rows) * 8, lengths) + _CLASS[words.data]
    by_class = np.bincount(kinds, minlength=rows * 8).reshape(rows, 8)

    begin, end = spans(words.data != 10, words.offsets)
    worded = np.searchsorted(words.start, begin) < np.searchsorted(words.start, end)
    line_row = np.searchsorted(words.offsets, begin, side="right") - 1
    _, again = _seen_twice(line_row, hash_spans(words.data, begin, end))

    row = words.rows()
    valid, windows = words.windows(REPEAT)
    at = np.flatnonzero(valid)
    many, _ = _seen_twice(row[at], windows[at])
    change = np.zeros(len(row) + 1, np.int64)
    change[at[many]] += 1
    np.subtract.at(change, at[many] + REPEAT, 1)
    covered = np.cumsum(change[:-1]) > 0

    return np.stack(
        [
            words.counts,
            by_class[:, _SYMBOL:_INSIDE].sum(axis=1),
            by_class[:, _SYMBOL],
            np.bincount(line_row[again & worded], minlength=rows),
            np.bincount(row[covered], minlength=rows),
            np.bincount(line_row[worded], minlength=rows),
            *(by_class[:, c] for c in (_UPPER, _LOWER, _DIGIT, _MARK, _OTHER)),
        ],
        axis=1,
    )


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for piece in pieces(batches, "text"):
        counts = count_all(piece.column("text"))
        names = [n for n in piece.schema.names if n != "text"]
        yield pa.RecordBatch.from_arrays(
            [*(piece.column(n) for n in names), *(longs(np.ascontiguousarray(c)) for c in counts.T)], [*names, *COUNTS]
        )


def count_documents(docs: DataFrame) -> DataFrame:
    """The columns of ``docs`` but ``text``, and ``COUNTS`` of the whole text."""
    others = docs.drop("text").schema
    shape = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in others), *(f"{c} long" for c in COUNTS)])
    return docs.mapInArrow(_count, shape)
