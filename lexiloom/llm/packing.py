"""Cost-balanced packing of documents into sequences of tokens.

A task tokenises its documents once and packs them in cells of a fixed number of
tokens, so a cell's memory is bounded and nothing is shuffled. A piece costs a
part linear in its tokens and a quadratic one for its attention. In a cell the
documents, longest first, each go to the sequence of least cost that has room for
them; one that fits nowhere is cut at the room of the cheapest sequence and its
rest goes on. A cell's sequences together hold exactly its tokens.
"""

from __future__ import annotations

import os
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexiloom.llm.words import LOWER, bytes_of, pieces, spans

SIZE = 2048
# Sequences of a full cell.
SEQUENCES = 256
# The id after each document's own.
END = 1
# Width of the model that costs are estimated for: attention over n tokens costs
# n / (6 * HIDDEN) of what the layers' products cost for them.
HIDDEN = 1024
# Parts of words whose ids are remembered, and the longest of them in bytes.
KNOWN = 800_000
LONGEST = 32

# Kinds of bytes: white space, small letters, digits, marks, and what is left alone.
SPACE, LETTER, DIGIT, MARK, OTHER = range(5)
KIND = np.full(256, OTHER, np.uint8)
KIND[33:127] = MARK
KIND[ord("a") : ord("z") + 1] = LETTER
KIND[ord("0") : ord("9") + 1] = DIGIT
KIND[ord("'")] = OTHER
KIND[[*range(9, 14), 32]] = SPACE
# Kinds of two neighbours between which every text is cut.
CUT = np.zeros((5, 5), bool)
CUT[SPACE] = True
CUT[LETTER, [DIGIT, MARK]] = CUT[DIGIT, [LETTER, DIGIT, MARK]] = CUT[MARK, [LETTER, DIGIT]] = True


class Vocabulary:
    """A public tokenizer that takes each distinct part of a batch's words once.

    It ignores case, and never joins characters across white space or across the
    edge of a run of ASCII letters, digits or marks; parts are cut there and only
    there. Around apostrophes and other characters words are left whole, and
    words with a ``|`` entirely, for the names of special ids are written so.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        (self.bar,) = self.tokenizer.encode("|", add_special_tokens=False).ids
        self.known: dict[bytes, bytes] = {}

    def _new(self, parts: list[bytes]) -> list[bytes]:
        """The ids of parts without a bar, all taken as one text with bars between."""
        joined = b" | ".join(parts).decode()
        ids = np.array(self.tokenizer.encode_batch_fast([joined], add_special_tokens=False)[0].ids, np.uint32)
        edges = np.flatnonzero(ids == self.bar).tolist()
        return [ids[i + 1 : j].tobytes() for i, j in zip([-1, *edges], [*edges, len(ids)])]

    def _of_parts(self, parts: list[bytes]) -> list[bytes]:
        """The ids of each part as bytes."""
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        out = list(map(self.known.get, parts))
        missing = [i for i, ids in enumerate(out) if ids is None]
        if len(self.known) + len(missing) > KNOWN:
            self.known.clear()
        plain = [i for i in missing if b"|" not in parts[i]]
        for i, ids in zip(plain, self._new([parts[i] for i in plain]) if plain else ()):
            out[i] = ids
            if len(parts[i]) <= LONGEST:
                self.known[parts[i]] = ids
        for i in set(missing) - set(plain):
            out[i] = np.array(self.tokenizer.encode(parts[i].decode(), add_special_tokens=False).ids, np.uint32).tobytes()
        return out

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all rows, and where each row's ids start; a null row has none."""
        data, offsets = bytes_of(texts)
        small = LOWER[data]
        kind = KIND[small]
        if len(bars := np.flatnonzero(data == ord("|"))):
            start, end = spans(kind != SPACE, offsets)
            for word in np.unique(np.searchsorted(start, bars, side="right") - 1):
                small[start[word] : end[word]] = data[start[word] : end[word]]
                kind[start[word] : end[word]] = OTHER
        inside = kind != SPACE
        begins = inside.copy()
        begins[1:] &= CUT.ravel()[kind[:-1] * np.uint8(5) + kind[1:]]
        heads = offsets[:-1][offsets[:-1] < len(data)]
        begins[heads] = inside[heads]
        begin = np.flatnonzero(begins)
        if not len(begin):
            return np.zeros(0, np.uint32), np.zeros(len(texts) + 1, np.int64)
        letters = small[inside]
        # White space only lies before parts, so each part begins as many bytes
        # earlier as there is white space before it.
        edges = np.append(begin - np.cumsum(~inside, dtype=np.int32)[begin], len(letters))
        parts = pa.Array.from_buffers(pa.large_binary(), len(begin), [None, pa.py_buffer(edges), pa.py_buffer(letters)])
        coded = parts.dictionary_encode()
        _, places, content = coded.dictionary.buffers()
        places, content = np.frombuffer(places, np.int64, len(coded.dictionary) + 1).tolist(), content.to_pybytes()
        tables = self._of_parts([content[i:j] for i, j in zip(places, places[1:])])
        flat = np.frombuffer(b"".join(tables), np.uint32)
        lengths = np.fromiter(map(len, tables), np.int64, len(tables)) // 4
        part = coded.indices.to_numpy()
        many = lengths[part]
        ends = np.concatenate([[0], np.cumsum(many)])
        ids = flat[np.repeat((np.cumsum(lengths) - lengths)[part] - ends[:-1], many) + np.arange(ends[-1])]
        return ids, ends[np.searchsorted(begin, offsets)]


def capacities(tokens: int, size: int) -> np.ndarray:
    """Full sequences, then powers of two for the rest: no sequence needs padding."""
    rest = tokens % size
    powers = [1 << bit for bit in reversed(range(rest.bit_length())) if rest >> bit & 1]
    return np.array([size] * (tokens // size) + powers, np.int64)


def pack_cell(lengths: np.ndarray, size: int, hidden: int) -> list[tuple[int, int, int, int, int]]:
    """(document, start, length, sequence, offset) of each piece of the cell."""
    room = capacities(int(lengths.sum()), size)
    full = room.copy()
    cost = np.zeros(len(room))
    out = []
    for doc in np.argsort(-lengths, kind="stable").tolist():
        start, left = 0, int(lengths[doc])
        while left:
            fits = np.flatnonzero(room >= left)
            if not len(fits):
                fits = np.flatnonzero(room)
            best = int(fits[np.argmin(cost[fits])])
            length = min(left, int(room[best]))
            out.append((doc, start, length, best, int(full[best] - room[best])))
            room[best] -= length
            cost[best] += length * (1 + length / (6 * hidden))
            start, left = start + length, left - length
    return out


class _Cells:
    """Collects a task's documents and turns them into rows cell by cell."""

    SCHEMA = pa.schema(
        [("row", pa.int64()), ("start", pa.int64()), ("length", pa.int64()), ("ids", pa.binary()), ("doc_tokens", pa.int64()),
         ("sequence_id", pa.int64()), ("offset", pa.int64())]
    )

    def __init__(self, size: int, sequences: int, hidden: int, first: int):
        self.size, self.most, self.hidden = size, size * sequences, hidden
        self.sequence = first
        self.waiting: list[tuple[object, int, np.ndarray, int]] = []
        self.tokens = 0

    def add(self, name: object, ids: np.ndarray) -> Iterator[list[tuple]]:
        start, total = 0, len(ids)
        while start < total:
            part = ids[start : start + min(self.size, self.most - self.tokens)]
            self.waiting.append((name, start, part, total))
            self.tokens += len(part)
            start += len(part)
            if self.tokens == self.most:
                yield self.close()

    def close(self) -> list[tuple]:
        lengths = np.array([len(part) for _, _, part, _ in self.waiting], np.int64)
        rows = []
        for doc, start, length, sequence, offset in pack_cell(lengths, self.size, self.hidden):
            name, base, part, total = self.waiting[doc]
            ids = part[start : start + length].astype("<u4").tobytes()
            rows.append((name, base + start, length, ids, total, self.sequence + sequence, offset))
        self.sequence += len(capacities(self.tokens, self.size))
        self.waiting, self.tokens = [], 0
        return rows


def _packer(shared, size: int, sequences: int, hidden: int, end: int):
    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cells = _Cells(size, sequences, hidden, TaskContext.get().partitionId() << 33)
        kind = None

        def batch(rows: list[tuple]) -> pa.RecordBatch:
            columns = list(zip(*rows))
            arrays = [pa.array(columns[0], kind), *(pa.array(c, f.type) for c, f in zip(columns[1:], list(_Cells.SCHEMA)[1:]))]
            return pa.RecordBatch.from_arrays(arrays, ["doc_id", *_Cells.SCHEMA.names[1:]])

        for piece in pieces(batches, "text"):
            kind = piece.column("doc_id").type
            ids, first = shared.value.encode(piece.column("text"))
            ends = np.array([end], np.uint32)
            for row, name in enumerate(piece.column("doc_id").to_pylist()):
                for rows in cells.add(name, np.concatenate([ids[first[row] : first[row + 1]], ends])):
                    yield batch(rows)
        if cells.waiting:
            yield batch(cells.close())

    return pack


def pack_documents(
    docs: DataFrame, vocabulary: str, size: int = SIZE, sequences: int = SEQUENCES, hidden: int = HIDDEN, end: int = END
) -> DataFrame:
    """The pieces of all rows of ``docs`` (doc_id, text), each with its place.

    Returns doc_id, start (ids of the document before the piece), length, ids
    (little-endian unsigned 32-bit), doc_tokens, sequence_id, offset. Each id of
    each row lies in one piece. A sequence has ``size`` ids or, at most one of
    each power of two at the end of a task's rows, such a power; ``size`` is one
    too, so nothing is padded. A null or empty text is the id ``end`` alone;
    repeated rows and ids are packed row by row, equal lengths in row order; a
    text of any length is cut at ``size`` and at the edge of a cell; no rows give
    no rows. Which rows share a sequence depends on how Spark splits the input.

    ``vocabulary`` is a tokenizer file the driver can read; executors get the
    tokenizer by broadcast (a few MB, whatever the data).
    """
    if size & (size - 1):
        raise ValueError("size must be a power of two")
    shared = docs.sparkSession.sparkContext.broadcast(Vocabulary(vocabulary))
    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", F.col("text").cast("string")).mapInArrow(
        _packer(shared, size, sequences, hidden, end),
        f"doc_id {kind}, start long, length long, ids binary, doc_tokens long, sequence_id long, offset long",
    )
