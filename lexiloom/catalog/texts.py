"""Registered queries: text expressions and markup."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lexiloom.catalog import fixtures
from lexiloom.catalog.sql import (
    ASCII_NO_HAN,
    INTEGER,
    REASONING,
    SEGMENTS,
    chunks_of,
    planted,
    sentences_of,
    words_of,
)
from lexiloom.functions import text as tx
from lexiloom.operators.embedding import embed_hashed

# The instruction put before a text; a user's own value.
HEADER = "Give a Spanish version of this passage.\n\n\n"


def ascii_no_han(spark: SparkSession, sf: str) -> DataFrame:
    docs = fixtures.table(spark, sf, "documents")
    return docs.select("doc_id", tx.ascii_no_han(fixtures.planted(F.col("text"))).alias("passes"))


def is_integer_text(spark: SparkSession, sf: str) -> DataFrame:
    """Every piece of every page address."""
    pieces = F.posexplode(F.split("url", "[/?&=#]")).alias("pos", "piece")
    rows = fixtures.table(spark, sf, "pages").select("page_id", pieces)
    return rows.select(
        "page_id",
        F.col("pos").cast("bigint").alias("pos"),
        "piece",
        tx.is_integer_text(F.col("piece")).alias("is_integer"),
    )


def extract_tagged(spark: SparkSession, sf: str) -> DataFrame:
    rows = fixtures.reasoning_rows(spark, sf)
    parts = [
        rows.select(
            "index", F.lit(tag).alias("tag"), F.explode(tx.extract_tagged(F.col("response"), tag)).alias("block")
        )
        for tag in ("Thought", "Output")
    ]
    return parts[0].union(parts[1])


def split_sentences(spark: SparkSession, sf: str) -> DataFrame:
    rows = fixtures.table(spark, sf, "documents").select(
        "doc_id", F.posexplode(tx.split_sentences(F.col("text"))).alias("pos", "sentence")
    )
    return rows.withColumn("pos", F.col("pos").cast("bigint"))


def chunk_words(spark: SparkSession, sf: str) -> DataFrame:
    rows = fixtures.table(spark, sf, "documents").select(
        "doc_id", F.posexplode(tx.chunk_words(F.col("text"))).alias("pos", "chunk")
    )
    return rows.withColumn("pos", F.col("pos").cast("bigint"))


def segment_markup(spark: SparkSession, sf: str) -> DataFrame:
    rows = fixtures.table(spark, sf, "pages").select(
        "page_id", F.inline(tx.segment_markup(F.col("html")))
    )
    return rows.withColumn("pos", F.col("pos").cast("bigint"))


def reassemble(spark: SparkSession, sf: str) -> DataFrame:
    """Split into segments and joined again: only white space around tags is lost."""
    return fixtures.table(spark, sf, "pages").select(
        "page_id", tx.join_segments(tx.segment_markup(F.col("html"))).alias("text")
    )


def build_prompt(spark: SparkSession, sf: str) -> DataFrame:
    return fixtures.table(spark, sf, "conversations").select(
        "conv_id", "turn", tx.with_header(F.col("text"), HEADER).alias("prompt")
    )


DIMENSIONS = 64


def embed_text(spark: SparkSession, sf: str) -> DataFrame:
    """Each document's vector, a row per component."""
    embedded = embed_hashed(fixtures.table(spark, sf, "documents").select("doc_id", "text"), dimensions=DIMENSIONS)
    parts = embedded.select("doc_id", F.posexplode("embedding").alias("place", "weight"))
    return parts.select("doc_id", "place", F.round(F.col("weight").cast("double"), 6).alias("weight"))


QUERIES = {
    "ascii_no_han": ascii_no_han,
    "is_integer_text": is_integer_text,
    "extract_tagged": extract_tagged,
    "split_sentences": split_sentences,
    "chunk_words": chunk_words,
    "segment_markup": segment_markup,
    "reassemble": reassemble,
    "build_prompt": build_prompt,
    "embed_text": embed_text,
}


def _exploded(source: str, key: str, items: str, name: str) -> str:
    return f"""WITH listed AS (SELECT {key}, {items} AS items FROM {source})
SELECT {key}, CAST(generate_subscripts(items, 1) - 1 AS BIGINT) AS pos, unnest(items) AS {name}
FROM listed"""


def _blocks(tag: str) -> str:
    return (
        f"SELECT \"index\", '{tag}' AS tag, "
        f"unnest(regexp_extract_all(response, '(?s)<{tag}>(.*?)</{tag}>', 1)) AS block FROM o1"
    )


SQL = {
    "ascii_no_han": f"SELECT doc_id, {ASCII_NO_HAN.format(planted('text'))} AS passes FROM documents",
    "is_integer_text": f"""WITH listed AS (
  SELECT page_id, regexp_split_to_array(url, '[/?&=#]') AS items FROM pages),
pieces AS (
  SELECT page_id, CAST(generate_subscripts(items, 1) - 1 AS BIGINT) AS pos, unnest(items) AS piece FROM listed)
SELECT page_id, pos, piece, {INTEGER.format("piece")} AS is_integer FROM pieces""",
    "extract_tagged": f"WITH {REASONING} {_blocks('Thought')} UNION ALL {_blocks('Output')}",
    "split_sentences": _exploded("documents", "doc_id", sentences_of("text"), "sentence"),
    "chunk_words": _exploded("documents", "doc_id", chunks_of("text", 470), "chunk"),
    "segment_markup": f"WITH {SEGMENTS} SELECT page_id, CAST(pos AS BIGINT) AS pos, is_tag, text FROM segments",
    "reassemble": f"""WITH {SEGMENTS}
SELECT page_id, string_agg(text, '' ORDER BY pos) AS text FROM segments GROUP BY page_id""",
    "embed_text": f"""WITH words AS (
  SELECT doc_id, unnest({words_of("lower(text)")}) AS word FROM documents),
counts AS (
  SELECT doc_id, ('0x' || substr(md5(word), 1, 8))::BIGINT % {DIMENSIONS} AS place, count(*) AS n FROM words GROUP BY 1, 2),
norms AS (SELECT doc_id, sqrt(sum(n * n)) AS norm FROM counts GROUP BY doc_id),
places AS (SELECT doc_id, unnest(range(0, {DIMENSIONS})) AS place FROM documents WHERE text IS NOT NULL)
SELECT p.doc_id, CAST(p.place AS INTEGER) AS place,
  round(CAST(CAST(coalesce(c.n / m.norm, 0) AS FLOAT) AS DOUBLE), 6) AS weight
FROM places p LEFT JOIN counts c ON c.doc_id = p.doc_id AND c.place = p.place
LEFT JOIN norms m ON m.doc_id = p.doc_id""",
    "build_prompt": f"""SELECT conv_id, turn,
  'Give a Spanish version of this passage.' || repeat(chr(10), 3) || text AS prompt
FROM conversations""",
}
