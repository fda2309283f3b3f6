import re

import numpy as np
import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st

from lexiloom.llm import words as w

PLAIN = re.compile("[^\x20\x09-\x0d]+")
ALNUM = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")
texts = st.lists(st.none() | st.text(st.sampled_from(list(" \t\nabAB19.é漢🙂"))), max_size=6)


def lower(text):
    return "".join(c.lower() if c.isascii() else c for c in text or "")


@given(texts)
@settings(max_examples=200, deadline=None)
def test_words_are_those_of_the_patterns(rows):
    array = pa.array(rows, pa.string())
    plain, alnum = w.split_words(array), w.split_words(array, w.ALNUM, lower=True)
    for r, text in enumerate(rows):
        assert [b.decode() for b in plain.texts(r)] == PLAIN.findall(text or "")
        assert [b.decode() for b in alnum.texts(r)] == ALNUM.findall(lower(text))


def test_equal_words_and_only_those_have_equal_hashes():
    rows = ["a b ab ba", None, "", "b a a\x00 \x00a abab", "x" * 50_000 + " " + "x" * 50_001]
    found = w.split_words(pa.array(rows, pa.string()))
    named = {}
    for r in range(len(rows)):
        for word, h in zip(found.texts(r), found.hashes[found.first[r] : found.first[r + 1]]):
            assert named.setdefault(word, h) == h
    assert len(set(named.values())) == len(named)


def test_long_words_hash_like_short_ones(monkeypatch):
    data = np.frombuffer(b"abc" * 100 + b" " + b"abc" * 100, np.uint8)
    start, end = np.array([0, 301]), np.array([300, 601])
    expected = w.hash_spans(data, start, end)
    assert expected[0] == expected[1]
    monkeypatch.setattr(w, "SEGMENT", 64)
    assert (w.hash_spans(data, start, end) == expected).all()


def test_windows_stay_inside_their_row():
    found = w.split_words(pa.array(["a b c", "a b", "c a b c"]))
    starts, hashes = found.windows(3)
    assert starts.tolist() == [True, False, False, False, False, True, True, False, False]
    assert hashes[0] == hashes[6] != hashes[5]


def test_pieces_cover_all_rows(monkeypatch):
    monkeypatch.setattr(w, "PIECE", 10)
    batch = pa.RecordBatch.from_arrays([pa.array(["a" * 25, None, "b" * 4, "c" * 6, "d", ""])], ["text"])
    parts = list(w.pieces([batch, batch.slice(0, 0)], "text"))
    assert [p.num_rows for p in parts] == [1, 3, 2]
