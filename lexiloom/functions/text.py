"""Text expressions: Column in, Column out, evaluated inside the JVM."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

# Patterns and limits that decide the results.
# White space as Python's str.strip and str.split see it.
SPACE_CHARACTERS = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    + "".join(chr(code) for code in range(0x2000, 0x200B))
    + "\u2028\u2029\u202f\u205f\u3000"
)
SPACE = r"[\x09-\x0D\x1C-\x20\x85\xA0\u1680\u2000-\u200A\u2028\u2029\u202F\u205F\u3000]"
VISIBLE_ASCII = r"[!-~]"
HAN = r"[\x{4E00}-\x{9FFF}]"
INTEGER = r"(?U)\A\s*[+-]?\d+(_\d+)*\s*\z"
MARKUP_TOKEN = r"<[^>]*>|[^<]+|<[^>]*\z"
WORD_GAP = r"(?U)[\s\x1C-\x1F]"  # the same characters, faster where each one is tested
SENTENCE_END = rf"(?<=[.!?]){SPACE}+"
WORD_LIMIT = 470


def bind(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` computed once, however often it is used."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def strip(text: Column) -> Column:
    return F.btrim(text, F.lit(SPACE_CHARACTERS))


def has_han(text: Column) -> Column:
    return F.rlike(text, F.lit(HAN))


def ascii_no_han(text: Column) -> Column:
    """Has a visible ASCII character and no Han character.

    A script test, not language identification: French text passes as well.
    """
    return F.rlike(text, F.lit(VISIBLE_ASCII)) & ~has_han(text)


def is_integer_text(text: Column) -> Column:
    return F.coalesce(F.rlike(text, F.lit(INTEGER)), F.lit(False))


def extract_tagged(text: Column, tag: str) -> Column:
    """All texts between ``<tag>`` and ``</tag>``, shortest match, over lines."""
    return F.regexp_extract_all(text, F.lit(rf"(?s)<{tag}>(.*?)</{tag}>"), F.lit(1))


def split_sentences(text: Column) -> Column:
    """Sentences by rule: cut at white space after ``.``, ``!`` or ``?``."""
    return F.filter(F.split(strip(text), SENTENCE_END), lambda s: s != "")


def chunk_words(text: Column, limit: int = WORD_LIMIT) -> Column:
    """``[text]``, or pieces of ``limit`` words each when it has more."""

    def pieces(words: Column) -> Column:
        size = F.size(words)
        cut = F.transform(
            F.sequence(F.lit(0), F.floor((size - 1) / limit).cast("int")),
            lambda k: F.array_join(F.slice(words, k * limit + 1, F.lit(limit)), " "),
        )
        return F.when(size > limit, cut).otherwise(F.array(text))

    # Words take two characters each but the last: shorter texts are not split.
    return F.when(
        F.length(text) > 2 * limit, bind(F.split(strip(text), f"{WORD_GAP}+"), pieces)
    ).otherwise(F.array(text))


def segment_markup(text: Column, strip_plain: bool = True, keep_leading: bool = True) -> Column:
    """Markup and plain segments in order: ``array<struct<pos, is_tag, text>>``.

    Every character lands in one segment. ``strip_plain`` trims plain segments
    and drops blank ones; ``keep_leading=False`` drops text before the first tag.
    """

    def describe(token: Column) -> Column:
        is_tag = token.startswith("<") & token.endswith(">")
        body = F.when(is_tag, token).otherwise(strip(token)) if strip_plain else token
        return F.struct(is_tag.alias("is_tag"), body.alias("text"))

    segments = F.transform(F.regexp_extract_all(text, F.lit(MARKUP_TOKEN), F.lit(0)), describe)
    if not keep_leading:
        segments = F.filter(segments, lambda s, i: s["is_tag"] | (i > 0))
    segments = F.filter(segments, lambda s: s["is_tag"] | (s["text"] != ""))
    return F.transform(
        segments,
        lambda s, i: F.struct(i.alias("pos"), s["is_tag"].alias("is_tag"), s["text"].alias("text")),
    )


def needs_translation(segment: Column) -> Column:
    """Plain and not merely a number."""
    return ~segment["is_tag"] & ~is_integer_text(segment["text"])


def join_segments(segments: Column, separator: str = "") -> Column:
    return F.array_join(F.transform(segments, lambda s: s["text"]), separator)


def with_header(text: Column, header: str) -> Column:
    """``text`` behind a fixed instruction header."""
    return F.concat(F.lit(header), text)
