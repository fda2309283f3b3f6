import hashlib

import pytest
from pyspark.sql import functions as F

from lexiloom.operators import skew, translation
from lexiloom.operators.embedding import embed_hashed, embed_with
from lexiloom.operators.engines import (
    GaveUp,
    Glossary,
    Retrying,
    RowRejected,
    TranslatorEngine,
    WordSwap,
)

WORDS = {"the": "el", "and": "y"}


class Upper:
    def translate(self, texts):
        return [t.upper() for t in texts]


class Picky:
    """Fails a whole call when one of its texts is bad."""

    def translate(self, texts):
        if any("bad" in t for t in texts):
            raise ValueError("cannot take it")
        return [t.upper() for t in texts]


class Short:
    def translate(self, texts):
        return texts[:-1]


class Down:
    def translate(self, texts):
        raise ConnectionError("no server")


NATIVE = Glossary(WORDS)
UPPER = TranslatorEngine(Upper)
PICKY = TranslatorEngine(Picky, on_error="quarantine", call_size=3)


@pytest.fixture
def paq(spark):
    return spark.createDataFrame(
        [
            (0, ["q the", "a and"]),
            (1, ["bad q", "a"]),
            (2, ["only"]),
            (3, []),
            (4, None),
            (5, ["", "b"]),
            (6, ["q", "so bad"]),
            (7, [None, "x"]),
        ],
        "index bigint, set array<string>",
    )


def test_pairs_native_and_outside_agree(paq):
    swap = TranslatorEngine(lambda: WordSwap(WORDS))
    rows = [
        sorted(map(tuple, translation.translate_pairs(paq, engine).collect()), key=lambda r: r[0])
        for engine in (NATIVE, swap)
    ]
    assert rows[0] == rows[1]
    assert rows[0][0] == (0, "q the", "a and", None, "ok", "q el", "a y")
    assert rows[0][5][-2:] == ("", "b")


def test_every_row_is_either_good_or_quarantined(paq):
    done = translation.translate_pairs(paq, PICKY)
    good = {r["index"]: r for r in translation.good_rows(done).collect()}
    bad = {r["index"]: r.reason for r in translation.quarantined_rows(done).collect()}
    assert sorted(good) == [0, 5]
    assert good[0].A_traducida == "A AND"
    assert bad == {
        1: "ValueError: cannot take it",
        6: "ValueError: cannot take it",
        **{i: translation.MISSING for i in (2, 3, 4, 7)},
    }
    summary = {(r.status, r.reason): r.rows for r in translation.audit_summary(done).collect()}
    assert summary[("ok", None)] == 2 and summary[("quarantined", translation.MISSING)] == 4
    assert translation.audit(done).columns == ["index", "status", "reason"]


def test_policy_fail_stops_the_job(paq):
    with pytest.raises(Exception, match="cannot take it"):
        translation.translate_pairs(paq, TranslatorEngine(Picky)).collect()
    with pytest.raises(Exception, match="zip"):
        translation.translate_pairs(paq, TranslatorEngine(Short)).collect()
    with pytest.raises(ValueError):
        TranslatorEngine(Upper, on_error="ignore")


def test_giving_up_stops_the_job_even_under_quarantine(paq):
    engine = TranslatorEngine(
        lambda: Retrying(Down(), attempts=2, first_delay=0.0), on_error="quarantine"
    )
    with pytest.raises(Exception, match="2 attempts failed"):
        translation.translate_pairs(paq, engine).collect()


def test_retry_waits_twice_as_long_each_time():
    waits = []

    class Third:
        calls = 0

        def translate(self, texts):
            self.calls += 1
            if self.calls < 3:
                raise ConnectionError
            return texts

    assert Retrying(Third(), sleep=waits.append).translate(["x"]) == ["x"]
    assert waits == [1.0, 2.0]
    waits.clear()
    with pytest.raises(GaveUp):
        Retrying(Down(), attempts=3, sleep=waits.append).translate(["x"])
    assert waits == [1.0, 2.0]
    with pytest.raises(RowRejected):
        Retrying(WordSwap({"a": "b"}, 1), sleep=waits.append).translate(["one two"])
    assert waits == [1.0, 2.0]


def test_a_text_is_asked_for_once_per_batch():
    from lexiloom.operators.engines import _translate_texts

    asked = []

    class Counting(Upper):
        def translate(self, texts):
            asked.append(list(texts))
            return super().translate(texts)

    done, failed = _translate_texts(Counting(), ["a", "b", "c"], 2, True)
    assert asked == [["a", "b"], ["c"]]
    assert done == {"a": "A", "b": "B", "c": "C"} and not failed


def test_triplets(spark):
    df = spark.createDataFrame(
        [
            (0, ("q", ["p", "unused"], ["n1", "n2"])),
            (1, ("q", ["p"], [])),
            (2, ("q", [], ["n"])),
            (3, ("q", ["p"], ["ok", "bad"])),
            (4, ("q", ["p"], None)),
        ],
        "index bigint, set struct<query: string, pos: array<string>, neg: array<string>>",
    )
    rows = {r["index"]: r for r in translation.translate_triplets(df, PICKY).collect()}
    assert (rows[0].Q_traducida, rows[0].POS_traducida, rows[0].NEGs_traducidas) == ("Q", "P", ["N1", "N2"])
    assert rows[1].NEGs_traducidas == []
    assert [rows[i].status for i in range(5)] == ["ok", "ok", "quarantined", "quarantined", "quarantined"]
    assert rows[3].reason.startswith("ValueError")


@pytest.mark.parametrize("engine", [UPPER, TranslatorEngine(Upper, call_size=1)])
def test_markup(spark, engine):
    df = spark.createDataFrame(
        [("x <b>y</b> 12 <i> 1_0 </i>z",), ("",), (None,), ("<only>",)], "text string"
    )
    rows = {r.text: r for r in translation.translate_markup(df, "text", engine).collect()}
    assert rows["x <b>y</b> 12 <i> 1_0 </i>z"].translation == "X<b>Y</b>12<i>1_0</i>Z"
    assert rows[""].translation == ""
    assert rows["<only>"].translation == "<only>"
    assert rows[None].status == "quarantined"


def test_reasoning(spark):
    response = "<Thought>one. two three four\nfive</Thought><Thought>six!</Thought> skip <Output>out a. out b</Output>"
    df = spark.createDataFrame(
        [(0, "ask", response), (1, "漢 ask", response), (2, "ask", "no blocks"), (3, None, "r"), (4, "ask", None)],
        "index bigint, prompt string, response string",
    )
    rows = {r["index"]: r for r in translation.translate_reasoning(df, UPPER, limit=3).collect()}
    assert sorted(rows) == [0, 2, 3, 4]
    first = rows[0]
    assert first.prompt == "ASK"
    assert first.response_thoughts == "ONE. TWO THREE FOUR FIVE SIX!"
    assert first.response_salida == "OUT A. OUT B"
    assert (first.original_prompt, first.original_response) == ("ask", response)
    assert (rows[2].response_thoughts, rows[2].response_salida) == ("", "")
    assert rows[3].status == rows[4].status == "quarantined"


def test_distinct_equals_direct_with_a_hot_text(spark):
    df = spark.range(3000).select(
        "id",
        F.when(F.col("id") % 3 == 0, "the hot one")
        .when(F.col("id") % 7 == 0, None)
        .otherwise(F.concat(F.lit("and "), (F.col("id") % 500).cast("string")))
        .alias("text"),
    )
    distinct = translation.translate_distinct(df, "text", NATIVE, "id").select("id", "translation")
    direct = translation.translate_column(df, "text", NATIVE).select("id", "translation")
    assert distinct.count() == 3000
    assert distinct.exceptAll(direct).count() == 0


@pytest.mark.parametrize("small_rows", [200_000, 0])
def test_glossary_table_equals_glossary_map(spark, monkeypatch, small_rows):
    monkeypatch.setattr(skew, "SMALL_ROWS", small_rows)
    df = spark.createDataFrame(
        [(0, "the cat and the dog"), (1, ""), (2, "the"), (3, " the  end "), (4, "nothing")],
        "id bigint, text string",
    )
    table = spark.createDataFrame(list(WORDS.items()) + [("unused", "x")], "word string, target string")
    by_table = translation.translate_by_glossary_table(df, "text", table, "id")
    by_map = df.select("id", NATIVE.text(F.col("text")).alias("translation"))
    assert sorted(map(tuple, by_table.collect())) == sorted(map(tuple, by_map.collect()))


def test_a_large_glossary_meets_the_words_of_a_chunk_once(spark, monkeypatch):
    """No row for each word of each text, and rows are told apart without their ids."""
    monkeypatch.setattr(skew, "SMALL_ROWS", 0)
    monkeypatch.setattr(translation, "CHUNK_ROWS", 2)
    rows = [(i % 3, f"the {i} and  the {'x' * i}") for i in range(11)] + [(None, "the"), (1, None), (1, "")]
    df = spark.createDataFrame(rows, "id bigint, text string")
    table = spark.createDataFrame(list(WORDS.items()), "word string, target string")
    by_table = translation.translate_by_glossary_table(df, "text", table, "id")
    by_map = df.select("id", NATIVE.text(F.col("text")).alias("translation"))
    assert sorted(map(str, by_table.collect())) == sorted(map(str, by_map.collect()))
    assert "posexplode" not in by_table._jdf.queryExecution().executedPlan().toString()


def test_only_tables_within_both_bounds_are_small(spark, monkeypatch):
    df = spark.createDataFrame([("é",), ("bb",), (None,)], "t string")
    assert skew.is_small(df, ["t"])
    monkeypatch.setattr(skew, "SMALL_BYTES", 4)
    assert skew.is_small(df, ["t"])
    monkeypatch.setattr(skew, "SMALL_BYTES", 3)
    assert not skew.is_small(df, ["t"])
    monkeypatch.setattr(skew, "SMALL_ROWS", 2)
    assert not skew.is_small(df.filter("false").union(df), [])
    assert skew.is_small(df.filter("false"), ["t"])


def test_an_empty_glossary_is_an_error():
    with pytest.raises(ValueError):
        Glossary({})


def test_embeddings(spark):
    df = spark.createDataFrame([("a b a",), ("c",)], "text string")
    hashed = embed_hashed(df, dimensions=16).collect()
    for r in hashed:
        assert len(r.embedding) == 16
        assert abs(sum(x * x for x in r.embedding) - 1) < 1e-5
    odd = spark.createDataFrame([(" \n",), (None,), ("",), ("A a\tÉ é",)], "text string")
    blank, null, empty, words = embed_hashed(odd.coalesce(1), dimensions=8).collect()
    assert blank.embedding == empty.embedding == [0.0] * 8 and null.embedding is None
    places = [int(hashlib.md5(w.encode()).hexdigest()[:8], 16) % 8 for w in ("a", "a", "é", "é")]
    counts = [places.count(p) for p in range(8)]
    assert words.embedding == pytest.approx([c / sum(n * n for n in counts) ** 0.5 for c in counts])
    lengths = embed_with(df, lambda: lambda texts: [[float(len(t))] for t in texts]).collect()
    assert [r.embedding for r in lengths] == [[5.0], [1.0]]
