import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from lexiloom.functions import text as tx


def segments(value, text, **options):
    found = value(tx.segment_markup(F.lit(text), **options))
    assert [s["pos"] for s in found] == list(range(len(found)))
    return [("tag" if s["is_tag"] else "plain", s["text"]) for s in found]


@pytest.mark.parametrize(
    "text, expected",
    [
        ("a<b>c", [("plain", "a"), ("tag", "<b>"), ("plain", "c")]),
        ("<b>c", [("tag", "<b>"), ("plain", "c")]),
        ("<b>c<", [("tag", "<b>"), ("plain", "c"), ("plain", "<")]),
        ("<b>c<d e", [("tag", "<b>"), ("plain", "c"), ("plain", "<d e")]),
        ("a > b <t>", [("plain", "a > b"), ("tag", "<t>")]),
        ("<a> \n <b>", [("tag", "<a>"), ("tag", "<b>")]),
        ("<a> x <b>", [("tag", "<a>"), ("plain", "x"), ("tag", "<b>")]),
        ("<a\nb>x", [("tag", "<a\nb>"), ("plain", "x")]),
        ("", []),
    ],
)
def test_markup_segments(value, text, expected):
    assert segments(value, text) == expected


def test_leading_text_can_be_left_out(value):
    assert segments(value, "a<b>c", keep_leading=False) == [("tag", "<b>"), ("plain", "c")]
    assert segments(value, "<b>c", keep_leading=False) == [("tag", "<b>"), ("plain", "c")]


def test_unstripped_segments_give_the_text_back(spark):
    alphabet = st.text(alphabet="ab<> \n", max_size=30)

    @settings(
        max_examples=3, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture]
    )
    @given(st.lists(alphabet, min_size=40, max_size=40))
    def check(texts):
        df = spark.createDataFrame([(t,) for t in texts], "t string")
        whole = tx.join_segments(tx.segment_markup(F.col("t"), strip_plain=False))
        assert df.filter(whole != F.col("t")).count() == 0

    check()


@pytest.mark.parametrize(
    "text",
    "12| -3 |1_0|+7|\t5\n|0012|٣|1_0_0| 4|\x1c7".split("|") + ["1.5", "", "1__0", "_1", "1_", "x", "- 3", "1 2", "--1", "½"],
)
def test_integer_text_agrees_with_python(value, text):
    try:
        int(text)
        expected = True
    except ValueError:
        expected = False
    assert value(tx.is_integer_text(F.lit(text))) is expected


def test_integer_text_of_null_is_false(value):
    assert value(tx.is_integer_text(F.lit(None).cast("string"))) is False


@pytest.mark.parametrize(
    "text", ["", " a\n", "　x y\x1f", " z\x85", "no", " ", "​kept​"]
)
def test_strip_agrees_with_python(value, text):
    assert value(tx.strip(F.lit(text))) == text.strip()


@pytest.mark.parametrize(
    "text, expected",
    [
        ("Bonjour", True),
        ("hello 漢", False),
        ("漢字", False),
        ("éà", False),
        ("é!", True),
        (" \n", False),
        ("", False),
        ("㐀 a", True),
        ("a一", False),
        ("a鿿", False),
        ("aꀀ", True),
    ],
)
def test_script_predicate(value, text, expected):
    assert value(tx.ascii_no_han(F.lit(text))) is expected


def test_tagged_blocks(value):
    text = "<T>a\nb</T> x <T></T><T>c<T>d</T>"
    assert value(tx.extract_tagged(F.lit(text), "T")) == ["a\nb", "", "c<T>d"]
    assert value(tx.extract_tagged(F.lit("none"), "T")) == []


@pytest.mark.parametrize(
    "text, expected",
    [
        (" One. Two!  Three?\nFour ", ["One.", "Two!", "Three?", "Four"]),
        ("3.14 is pi.", ["3.14 is pi."]),
        ("Wait... what?!", ["Wait...", "what?!"]),
        ("   ", []),
        ("", []),
    ],
)
def test_sentences(value, text, expected):
    assert value(tx.split_sentences(F.lit(text))) == expected


@pytest.mark.parametrize("words", [0, 1, 4, 5, 6, 10, 11, 23])
def test_chunks_keep_every_word(value, words):
    text = "  ".join(f"w{i}" for i in range(words))
    chunks = value(tx.chunk_words(F.lit(text), 5))
    if words <= 5:
        assert chunks == [text]
    else:
        assert [w for c in chunks for w in c.split(" ")] == text.split()
        assert [len(c.split(" ")) for c in chunks[:-1]] == [5] * (len(chunks) - 1)
        assert 1 <= len(chunks[-1].split(" ")) <= 5


def test_header(value):
    assert value(tx.with_header(F.lit("x"), "Say:\n")) == "Say:\nx"
