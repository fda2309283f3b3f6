"""Inputs of the library's shape, derived from the given tables.

Each has a twin in ``sql.py``. Nothing is left out on the way: every row and
every text of the given table is used.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lexiloom.operators.indexing import read_indexed

GLOSSARY = {"the": "el", "and": "y", "of": "de", "to": "a", "that": "que", "in": "en"}

# A letter of the generated texts that stands in for a Han character, of which
# the texts have none.
STANDIN, HAN_LETTER = "ê", "漢"

# Rows with longer texts than this are what the limited translator rejects.
MAX_WORDS = 150


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def planted(text: Column) -> Column:
    return F.replace(text, F.lit(STANDIN), F.lit(HAN_LETTER))


def dictionary_entries(spark: SparkSession, sf: str) -> DataFrame:
    """One entry per document; a sense per line, tagged by the line's first letter.

    a: archaic, o: obsolete and rare, e: form-of, t: rare; a and e also name an
    original form. The part of speech goes by the last letter of the word, and a
    word with a full stop in it counts as absent.
    """
    word = F.lower(F.substring_index("text", " ", 1))
    last = F.right(word, F.lit(1))
    part = (
        F.when(last.isin("n", "s"), "noun")
        .when(last.isin("e", "o"), "verb")
        .when(last.isin("a", "r", "t"), "adj")
        .otherwise("adv")
    )

    def sense(line):
        letter = F.lower(F.substring(line, 1, 1))
        tags = (
            F.when(letter == "a", F.array(F.lit("archaic")))
            .when(letter == "o", F.array(F.lit("obsolete"), F.lit("rare")))
            .when(letter == "e", F.array(F.lit("form-of")))
            .when(letter == "t", F.array(F.lit("rare")))
        )
        original = F.lower(F.substring_index(line, " ", 1))
        return F.struct(
            F.when(line != "", F.array(line)).alias("glosses"),
            tags.alias("tags"),
            F.when(letter.isin("a", "e"), F.array(F.struct(original.alias("word")))).alias("form_of"),
        )

    return table(spark, sf, "documents").select(
        "doc_id",
        F.when(~F.contains(word, F.lit(".")), word).alias("word"),
        F.col("lang").alias("lang_code"),
        part.alias("pos"),
        F.transform(F.split("text", "\n"), sense).alias("senses"),
    )


def turns(spark: SparkSession, sf: str) -> DataFrame:
    """Conversation turns with their ordinal in the stored table."""
    return read_indexed(spark, f"{sf}/conversations.parquet")


def questions(spark: SparkSession, sf: str) -> DataFrame:
    return turns(spark, sf).filter("role = 'user'")


def answers(spark: SparkSession, sf: str) -> DataFrame:
    """Each answer under the key of the turn before it."""
    said = table(spark, sf, "conversations").filter("role = 'assistant'")
    return said.select("conv_id", (F.col("turn") - 1).alias("turn"), F.col("text").alias("answer"))


def pair_rows(spark: SparkSession, sf: str) -> DataFrame:
    """``set = [question, answer]`` per user turn; ``[question]`` where none follows."""
    both = questions(spark, sf).join(answers(spark, sf), ["conv_id", "turn"], "left")
    return both.select("index", F.array_compact(F.array("text", "answer")).alias("set"))


def triplet_rows(spark: SparkSession, sf: str) -> DataFrame:
    """Question, its answer, and the answers to the next two questions as negatives.

    Answers go to the turns they serve by key, at most three to each, so one
    endless conversation is still spread over all tasks.
    """
    served = (
        table(spark, sf, "conversations")
        .filter("role = 'assistant'")
        .select("conv_id", "turn", "text", F.explode(F.array(F.lit(1), F.lit(3), F.lit(5))).alias("back"))
        .select("conv_id", (F.col("turn") - F.col("back")).alias("turn"), "back", "text")
        .groupBy("conv_id", "turn")
        .agg(
            F.max(F.when(F.col("back") == 1, F.col("text"))).alias("answer"),
            F.sort_array(
                F.collect_list(F.when(F.col("back") > 1, F.struct("back", "text")))
            ).alias("later"),
        )
    )
    negatives = F.coalesce(
        F.transform("later", lambda x: x["text"]), F.array().cast("array<string>")
    )
    return (
        questions(spark, sf)
        .join(served, ["conv_id", "turn"], "left")
        .select(
            "index",
            F.struct(
                F.col("text").alias("query"),
                F.array_compact(F.array("answer")).alias("pos"),
                negatives.alias("neg"),
            ).alias("set"),
        )
    )


def reasoning_rows(spark: SparkSession, sf: str) -> DataFrame:
    """Prompt with planted Han letters, response with thought and output blocks.

    ``opening`` tells first questions from later ones.
    """
    response = F.concat(
        F.lit("<Thought>"),
        F.col("answer"),
        F.lit("</Thought>\n<Output>"),
        F.col("answer"),
        F.lit("</Output>"),
    )
    return (
        questions(spark, sf)
        .join(answers(spark, sf), ["conv_id", "turn"], "left")
        .select(
            "index",
            planted(F.col("text")).alias("prompt"),
            response.alias("response"),
            (F.col("turn") < 2).alias("opening"),
        )
    )


def reasoning_sources(spark: SparkSession, sf: str) -> list[DataFrame]:
    """The same rows as two sources with different column names."""
    rows = reasoning_rows(spark, sf)
    first = rows.filter("opening").select("index", "prompt", "response")
    later = rows.filter("not opening").select(
        "index", F.col("prompt").alias("instruction"), F.col("response").alias("output")
    )
    return [first, later]


def markup_texts(spark: SparkSession, sf: str) -> DataFrame:
    return read_indexed(spark, f"{sf}/pages.parquet").select("index", F.col("html").alias("text"))


def sentences(spark: SparkSession, sf: str) -> DataFrame:
    vectors = table(spark, sf, "embeddings")
    texts = table(spark, sf, "documents")
    return vectors.join(texts, F.col("vec_id") == F.col("doc_id")).select(
        F.col("vec_id").alias("idx"), "text", "embedding"
    )


def document_rows(spark: SparkSession, sf: str) -> DataFrame:
    """All documents as numbered sentences, for what needs no vector."""
    return table(spark, sf, "documents").select(F.col("doc_id").alias("idx"), "text")


def image_rows(spark: SparkSession, sf: str) -> DataFrame:
    """Whole paragraphs as payloads; empty ones stand for unreadable images."""
    paragraphs = F.regexp_extract_all(
        planted(F.col("html")), F.lit("(?s)<p>(.*?)</p>"), F.lit(1)
    )
    return table(spark, sf, "pages").select(
        F.col("page_id").cast("string").alias("id"),
        F.transform(paragraphs, lambda p: F.when(p != "", p.cast("binary"))).alias("images"),
        F.col("html").alias("problem"),
        F.col("url").alias("answer"),
        F.when(F.contains("url", F.lit("?")), "1").otherwise("0").alias("pass"),
    )
