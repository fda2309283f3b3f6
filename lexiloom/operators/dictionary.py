"""Dictionary entries to definitions and word forms.

Everything but the distinct over forms is narrow: filters run before any
expansion and reach the scan, lists are worked on as array expressions.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# What is kept and what is left out.
LANGUAGE = "es"
PARTS_OF_SPEECH = ["adj", "verb", "noun"]
EXCLUDED_TAGS = ["archaic", "obsolete", "form-of"]


def select_entries(
    entries: DataFrame,
    language: str = LANGUAGE,
    parts_of_speech: Sequence[str] = PARTS_OF_SPEECH,
) -> DataFrame:
    """Entries with a word, in one language, of the given parts of speech."""
    return entries.filter(
        (F.col("lang_code") == language)
        & F.col("pos").isin(*parts_of_speech)
        & F.col("word").isNotNull()
    )


def kept_senses(senses: Column, excluded: Sequence[str] = EXCLUDED_TAGS) -> Column:
    """Senses without an excluded tag; a sense without tags is kept."""
    barred = F.array(*[F.lit(tag) for tag in excluded])
    no_tags = F.array().cast("array<string>")
    return F.filter(senses, lambda s: ~F.arrays_overlap(F.coalesce(s["tags"], no_tags), barred))


def entry_glosses(senses: Column) -> Column:
    """All glosses of an entry, each once, in the order they first appear."""
    return F.array_distinct(
        F.flatten(F.filter(F.transform(senses, lambda s: s["glosses"]), lambda g: g.isNotNull()))
    )


def definitions(entries: DataFrame, excluded: Sequence[str] = EXCLUDED_TAGS) -> DataFrame:
    """(word, definition) for selected entries, distinct within each entry."""
    glosses = entry_glosses(kept_senses(F.col("senses"), excluded))
    return entries.select("word", F.explode(glosses).alias("definition"))


def forms(entries: DataFrame) -> DataFrame:
    """(word, original form) over all senses, tagged ones too, distinct overall."""
    originals = F.filter(
        F.flatten(
            F.filter(
                F.transform(F.col("senses"), lambda s: F.transform(s["form_of"], lambda f: f["word"])),
                lambda words: words.isNotNull(),
            )
        ),
        lambda word: word.isNotNull(),
    )
    return (
        entries.select("word", F.explode(F.array_distinct(originals)).alias("original form")).distinct()
    )


def sense_rows(entries: DataFrame, excluded: Sequence[str] = EXCLUDED_TAGS) -> DataFrame:
    """One row per kept sense, with its place among all senses of the entry."""
    placed = F.transform(
        F.col("senses"),
        lambda s, i: F.struct(
            i.alias("sense"), s["tags"].alias("tags"), s["glosses"].alias("glosses")
        ),
    )
    kept = kept_senses(placed, excluded)
    others = [c for c in entries.columns if c != "senses"]
    return entries.select(*others, F.inline(kept))
