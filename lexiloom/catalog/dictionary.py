"""Registered queries: dictionary flattening and its sources."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lexiloom.catalog import fixtures
from lexiloom.catalog.sql import WORDS
from lexiloom.operators import dictionary
from lexiloom.plans import jobs
from lexiloom.schemas import DICTIONARY
from lexiloom.session import new_folder
from lexiloom.sources import readers
from lexiloom.sources.writers import CSV_READ_OPTIONS


def chosen(spark: SparkSession, sf: str) -> DataFrame:
    return dictionary.select_entries(fixtures.dictionary_entries(spark, sf))


def dict_filter(spark: SparkSession, sf: str) -> DataFrame:
    return chosen(spark, sf).select("doc_id", "word", "lang_code", "pos")


def sense_tag_filter(spark: SparkSession, sf: str) -> DataFrame:
    return dictionary.sense_rows(chosen(spark, sf)).select(
        "doc_id",
        "word",
        F.col("sense").cast("bigint").alias("sense"),
        F.array_join("tags", ",").alias("tags"),
        F.get("glosses", F.lit(0)).alias("gloss"),
    )


def dict_definitions(spark: SparkSession, sf: str) -> DataFrame:
    return dictionary.definitions(chosen(spark, sf))


def dict_forms(spark: SparkSession, sf: str) -> DataFrame:
    return dictionary.forms(chosen(spark, sf))


def _lines(spark: SparkSession, sf: str) -> str:
    """All entries as JSON lines, and after each a broken copy, cut in its middle."""
    path = new_folder(spark, "entries")
    entries = fixtures.dictionary_entries(spark, sf).select("word", "lang_code", "pos", "senses")
    line = F.to_json(F.struct("*"))
    both = entries.select(F.explode(F.array(line, F.concat(F.lit("{broken "), "lang_code"))).alias("value"))
    both.write.text(path)
    return path


def scan_dictionary(spark: SparkSession, sf: str) -> DataFrame:
    """Entries in through the reader, with every sense; broken lines by their text."""
    good, corrupt = readers.split_corrupt(readers.scan_dictionary(spark, _lines(spark, sf), DICTIONARY))
    glosses = F.transform("senses", lambda s: F.coalesce(F.get(s["glosses"], F.lit(0)), F.lit("")))
    tags = F.transform("senses", lambda s: F.array_join(F.coalesce(s["tags"], F.array()), ","))
    forms = F.transform("senses", lambda s: F.coalesce(F.get(s["form_of"], F.lit(0))["word"], F.lit("")))
    joined = [F.array_join(c, "\n").alias(n) for c, n in ((glosses, "glosses"), (tags, "tags"), (forms, "forms"))]
    none = [F.lit(None).cast("string").alias(n) for n in ("word", "lang_code", "pos", "glosses", "tags", "forms")]
    return good.select("word", "lang_code", "pos", *joined, F.lit(None).cast("string").alias("corrupt")).union(
        corrupt.select(*none, "corrupt")
    )


def _job(spark: SparkSession, sf: str) -> str:
    path = new_folder(spark, "dictionary")
    jobs.dictionary_from_lines(spark, _lines(spark, sf), path)
    return path


def job_wiktionary(spark: SparkSession, sf: str) -> DataFrame:
    """Both CSV tables as written, one under the other."""
    path = _job(spark, sf)
    read = spark.read.options(**CSV_READ_OPTIONS)
    words = read.schema("word STRING, definition STRING").csv(f"{path}/words")
    forms = read.schema("word STRING, `original form` STRING").csv(f"{path}/forms")
    return words.select(F.lit("definition").alias("kind"), "word", F.col("definition").alias("value")).union(
        forms.select(F.lit("form"), "word", F.col("original form"))
    )


QUERIES = {
    "dict_filter": dict_filter,
    "sense_tag_filter": sense_tag_filter,
    "dict_definitions": dict_definitions,
    "dict_forms": dict_forms,
    "scan_dictionary": scan_dictionary,
    "job_wiktionary": job_wiktionary,
}

_DEFINITIONS = """SELECT word, line AS definition FROM senses
WHERE letter NOT IN ('a', 'o', 'e') AND line <> '' GROUP BY doc_id, word, line"""
_FORMS = """SELECT DISTINCT word, lower(split_part(line, ' ', 1)) AS "original form"
FROM senses WHERE letter IN ('a', 'e')"""

SQL = {
    "dict_filter": f"WITH {WORDS} SELECT doc_id, word, lang_code, pos FROM chosen",
    "sense_tag_filter": f"""WITH {WORDS}
SELECT doc_id, word, CAST(sense AS BIGINT) AS sense,
  CASE WHEN letter = 't' THEN 'rare' END AS tags, nullif(line, '') AS gloss
FROM senses WHERE letter NOT IN ('a', 'o', 'e')""",
    "dict_definitions": f"WITH {WORDS} {_DEFINITIONS}",
    "dict_forms": f"WITH {WORDS} {_FORMS}",
    "scan_dictionary": f"""WITH {WORDS},
listed AS (SELECT word, lang_code, pos, string_split(text, chr(10)) AS lines FROM entries)
SELECT word, lang_code, pos, array_to_string(lines, chr(10)) AS glosses,
  array_to_string(list_transform(lines, lambda x: CASE lower(x[1]) WHEN 'a' THEN 'archaic'
    WHEN 'o' THEN 'obsolete,rare' WHEN 'e' THEN 'form-of' WHEN 't' THEN 'rare' ELSE '' END), chr(10)) AS tags,
  array_to_string(list_transform(lines, lambda x: CASE WHEN lower(x[1]) IN ('a', 'e')
    THEN lower(split_part(x, ' ', 1)) ELSE '' END), chr(10)) AS forms, NULL AS corrupt
FROM listed
UNION ALL SELECT NULL, NULL, NULL, NULL, NULL, NULL, '{{broken ' || lang FROM documents""",
    "job_wiktionary": f"""WITH {WORDS}, d AS ({_DEFINITIONS}), f AS ({_FORMS})
SELECT 'definition' AS kind, word, definition AS value FROM d
UNION ALL SELECT 'form', word, "original form" FROM f""",
}
