"""Column, pair, triplet, markup and reasoning translation.

Each row's texts go to the engine as one array, so no row is exploded and
regrouped. Results carry ``status`` (``ok`` or ``quarantined``) and ``reason``.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from lexiloom.functions.text import (
    WORD_LIMIT,
    ascii_no_han,
    chunk_words,
    extract_tagged,
    needs_translation,
    segment_markup,
    split_sentences,
)
from lexiloom.operators.engines import Engine
from lexiloom.operators.skew import is_small, join_spread
from lexiloom.session import stage

OK = "ok"
QUARANTINED = "quarantined"
MISSING = "missing field"
# What an engine with a clock adds to each row, in seconds.
TIMES = ("started", "ended", "waited")
PICKED_UP, DONE = "picked up", "done"

# Markup names around the parts of a response.
THOUGHT_TAG = "Thought"
OUTPUT_TAG = "Output"

# Texts that are worked on with one dictionary of their own words: rows and bytes.
CHUNK_ROWS = 2048
CHUNK_BYTES = 4 * 1024 * 1024


def with_status(df: DataFrame, reason: Column) -> DataFrame:
    return df.withColumn("reason", reason).withColumn(
        "status", F.when(F.col("reason").isNull(), OK).otherwise(QUARANTINED)
    )


def good_rows(df: DataFrame) -> DataFrame:
    return df.filter(F.col("status") == OK).drop("status", "reason")


def quarantined_rows(df: DataFrame) -> DataFrame:
    return df.filter(F.col("status") == QUARANTINED)


def audit(df: DataFrame, index: str = "index") -> DataFrame:
    """(index, status, reason): what became of each row."""
    return df.select(index, "status", "reason")


def audit_summary(df: DataFrame) -> DataFrame:
    return df.groupBy("status", "reason").agg(F.count(F.lit(1)).alias("rows"))


def run_log(done: DataFrame, index: str = "index") -> DataFrame:
    """(index, time, delta, waited, event): two lines for each row an engine with a
    clock has handled, when it was taken up and what became of it.

    ``delta`` is the seconds since it was taken up, ``waited`` those between the row
    before it in its task and itself.
    """
    outcome = F.when(F.col("status") == OK, F.lit(DONE)).otherwise(F.concat_ws(": ", F.lit(QUARANTINED), "reason"))
    moment = F.timestamp_micros((F.col("line.at") * 1_000_000).cast("bigint"))
    lines = F.explode(
        F.array(
            F.struct(F.col("started").alias("at"), F.lit(0.0).alias("delta"), F.lit(PICKED_UP).alias("event")),
            F.struct(F.col("ended").alias("at"), (F.col("ended") - F.col("started")).alias("delta"), outcome.alias("event")),
        )
    )
    return done.select(index, "waited", lines.alias("line")).select(
        index, moment.alias("time"), "line.delta", "waited", "line.event"
    )


def _translate_row(df: DataFrame, texts: Column, engine: Engine, missing: Column) -> DataFrame:
    """Adds ``_t``, the engine's result, for rows whose fields are all there."""
    asked = F.when(~missing, texts)
    told = df.withColumn("_missing", missing).withColumn("_t", engine(asked))
    if getattr(engine, "clock", None):
        told = told.withColumns({name: F.col(f"_t.{name}") for name in TIMES})
    reason = F.when(F.col("_missing"), F.lit(MISSING)).otherwise(F.col("_t.error"))
    return with_status(told, reason).drop("_missing")


def _translate_row_once(df: DataFrame, texts: Column, engine: Engine, missing: Column, key: str) -> DataFrame:
    """As ``_translate_row``, but each distinct text of all rows is translated once.

    Texts are gathered over all fields and rows, and put back by ``key``, which is
    unique, and their place in the row.
    """
    asked = df.withColumn("_missing", missing).withColumn("_asked", F.when(~missing, texts))
    each = asked.select(key, F.posexplode("_asked").alias("_at", "text")).filter("text IS NOT NULL")
    part = F.struct("_at", "translation", "reason")
    parts = (
        translate_distinct(each, "text", engine, key)
        .groupBy(key)
        .agg(F.sort_array(F.collect_list(part)).alias("_parts"))
    )
    failed = F.filter(F.transform("_parts", lambda p: p["reason"]), lambda r: r.isNotNull())
    by_place = F.map_from_entries(F.transform("_parts", lambda p: F.struct(p["_at"], p["translation"])))
    told = F.transform("_asked", lambda _, i: F.try_element_at(by_place, i))
    error = F.get(failed, F.lit(0))
    result = F.struct(F.when(error.isNull(), told).alias("texts"), error.alias("error"))
    return with_status(
        asked.join(parts, key, "left").withColumn("_t", result),
        F.when(F.col("_missing"), F.lit(MISSING)).otherwise(F.col("_t.error")),
    ).drop("_missing", "_asked", "_parts")


def translate_column(
    df: DataFrame, column: str, engine: Engine, output: str = "translation"
) -> DataFrame:
    missing = F.col(column).isNull()
    done = _translate_row(df, F.array(F.col(column)), engine, missing)
    return done.withColumn(output, F.get("_t.texts", F.lit(0))).drop("_t")


def pair_fields(df: DataFrame) -> DataFrame:
    """``set[0]`` and ``set[1]``; NULL where the array is short."""
    return df.select(
        "index",
        F.get("set", F.lit(0)).alias("Q_original"),
        F.get("set", F.lit(1)).alias("A_original"),
    )


def triplet_fields(df: DataFrame) -> DataFrame:
    """Query, first positive and all negatives."""
    return df.select(
        "index",
        F.col("set.query").alias("Q_original"),
        F.get("set.pos", F.lit(0)).alias("POS_original"),
        F.col("set.neg").alias("NEGs_original"),
    )


def translate_pairs(df: DataFrame, engine: Engine, distinct: bool = False) -> DataFrame:
    """With ``distinct``, a text that many rows have is translated once."""
    fields = pair_fields(df)
    missing = F.col("Q_original").isNull() | F.col("A_original").isNull()
    texts = F.array("Q_original", "A_original")
    if distinct:
        done = _translate_row_once(fields, texts, engine, missing, "index")
    else:
        done = _translate_row(fields, texts, engine, missing)
    return done.withColumns(
        {
            "Q_traducida": F.get("_t.texts", F.lit(0)),
            "A_traducida": F.get("_t.texts", F.lit(1)),
        }
    ).drop("_t")


def translate_triplets(df: DataFrame, engine: Engine, distinct: bool = False) -> DataFrame:
    """Query, positive and every negative; an empty list of negatives is fine.

    With ``distinct``, a text that many rows have is translated once.
    """
    fields = triplet_fields(df)
    missing = (
        F.col("Q_original").isNull()
        | F.col("POS_original").isNull()
        | F.col("NEGs_original").isNull()
    )
    texts = F.concat(F.array("Q_original", "POS_original"), F.col("NEGs_original"))
    if distinct:
        done = _translate_row_once(fields, texts, engine, missing, "index")
    else:
        done = _translate_row(fields, texts, engine, missing)
    rest = F.slice("_t.texts", F.lit(3), F.greatest(F.size("_t.texts") - 2, F.lit(0)))
    return done.withColumns(
        {
            "Q_traducida": F.get("_t.texts", F.lit(0)),
            "POS_traducida": F.get("_t.texts", F.lit(1)),
            "NEGs_traducidas": rest,
        }
    ).drop("_t")


def translate_markup(
    df: DataFrame,
    column: str,
    engine: Engine,
    output: str = "translation",
    strip_plain: bool = True,
    keep_leading: bool = True,
) -> DataFrame:
    """Plain, non-numeric segments translated; tags and numbers as they are."""
    missing = F.col(column).isNull()
    segments = segment_markup(F.col(column), strip_plain, keep_leading)
    # A NULL stands for a segment to leave alone, so places stay aligned.
    texts = F.transform(F.col("_segments"), lambda s: F.when(needs_translation(s), s["text"]))
    done = _translate_row(df.withColumn("_segments", segments), texts, engine, missing)
    merged = F.zip_with(
        F.col("_segments"), F.col("_t.texts"), lambda s, t: F.coalesce(t, s["text"])
    )
    return done.withColumn(
        output, F.when(F.col("status") == OK, F.array_join(merged, ""))
    ).drop("_t", "_segments")


def _speech(response: Column, tag: str, limit: int) -> Column:
    """The tagged blocks of a response as sentences of at most ``limit`` words."""
    sentences = F.flatten(F.transform(extract_tagged(response, tag), split_sentences))
    return F.flatten(F.transform(sentences, lambda s: chunk_words(s, limit)))


def translate_reasoning(df: DataFrame, engine: Engine, limit: int = WORD_LIMIT) -> DataFrame:
    """Prompt, thought blocks and output blocks of prompts that pass the script test.

    Other prompts are left out; a row without a prompt or a response is
    quarantined.
    """
    missing = F.col("prompt").isNull() | F.col("response").isNull()
    chosen = df.filter(missing | ascii_no_han(F.col("prompt"))).withColumns(
        {
            "_thoughts": _speech(F.col("response"), THOUGHT_TAG, limit),
            "_outputs": _speech(F.col("response"), OUTPUT_TAG, limit),
        }
    )
    texts = F.concat(F.array("prompt"), F.col("_thoughts"), F.col("_outputs"))
    done = _translate_row(chosen, texts, engine, missing)
    n_thoughts, n_outputs = F.size("_thoughts"), F.size("_outputs")
    translated = F.col("_t.texts")
    return done.select(
        *[F.col(c) for c in df.columns if c not in ("prompt", "response")],
        F.get(translated, F.lit(0)).alias("prompt"),
        F.array_join(F.slice(translated, F.lit(2), n_thoughts), " ").alias("response_thoughts"),
        F.array_join(F.slice(translated, n_thoughts + 2, n_outputs), " ").alias("response_salida"),
        F.col("prompt").alias("original_prompt"),
        F.col("response").alias("original_response"),
        "status",
        "reason",
        *[c for c in TIMES if c in done.columns],
    )


def translate_distinct(
    df: DataFrame, column: str, engine: Engine, row_id: str, output: str = "translation"
) -> DataFrame:
    """Each distinct text translated once, then joined back to its rows.

    The translations are written once to the shared folder and read from there
    by every later step. Texts that many rows share are salted in the join;
    rows without a text have no part in it and get their status like any other.
    """
    missing = df.filter(F.col(column).isNull())
    uses = (
        df.filter(F.col(column).isNotNull())
        .groupBy(column)
        .agg(F.count(F.lit(1)).alias("uses"))
    )
    memory = stage(translate_column(uses, column, engine, output), "translations")
    joined = join_spread(
        df.filter(F.col(column).isNotNull()),
        memory.select(column, output, "status", "reason"),
        column,
        [row_id],
        memory.select(column, "uses"),
    )
    return joined.unionByName(translate_column(missing, column, engine, output))


def _swap_words(texts: list[str | None], known: dict[str, str]) -> list[str | None]:
    return [None if t is None else " ".join([known.get(w, w) for w in t.split(" ")]) for t in texts]


def _swapped(shared) -> Callable[[Column], Column]:
    @F.arrow_udf("string")
    def swap(texts: pa.Array) -> pa.Array:
        return pa.array(_swap_words(texts.to_pylist(), shared.value), pa.string())

    return swap


def _chunked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (id, text) with the number of their chunk: neighbours of one task."""
    chunk, rows, size = TaskContext.get().partitionId() << 32, 0, 0
    for batch in batches:
        numbers = []
        for length in pc.fill_null(pc.binary_length(batch.column(1)), 0).to_pylist():
            if rows and (rows >= CHUNK_ROWS or size + length > CHUNK_BYTES):
                chunk, rows, size = chunk + 1, 0, 0
            rows, size = rows + 1, size + length
            numbers.append(chunk)
        yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(numbers, pa.int64())], ["_row", "_text", "_chunk"])


def _translate_chunk(texts: pa.Table, hits: pa.Table) -> pa.Table:
    known = dict(zip(hits.column("word").to_pylist(), hits.column("_target").to_pylist(), strict=True))
    # A target that is NULL leaves the word as it is.
    known = {word: target for word, target in known.items() if target is not None}
    done = pa.array(_swap_words(texts.column("_text").to_pylist(), known), pa.string())
    return pa.table({"_row": texts.column("_row"), "_done": done})


def translate_by_glossary_table(
    df: DataFrame, column: str, glossary: DataFrame, row_id: str, output: str = "translation"
) -> DataFrame:
    """Word-for-word translation with a glossary table of any size.

    ``glossary``: (word, target), one row per word. The distinct words of the
    column meet the glossary first, and the hits are written once. Where they
    prove small they are broadcast as one dictionary. Else the texts are written
    in chunks of a few megabytes; the distinct words of each chunk meet the hits,
    and each chunk gets its own dictionary: what is shuffled are the texts, once,
    and those words, not every word of every text. A NULL text stays NULL.
    """
    words = df.select(F.explode(F.split(column, " ")).alias("word")).distinct()
    known = glossary.select("word", F.col("target").alias("_target"))
    targets = stage(words.join(known, "word"), "glossary-hits")
    if is_small(targets, ["word", "_target"]):
        # Each text meets the few hits where it lies: no words, no regrouping.
        hits = {r["word"]: r["_target"] for r in targets.collect()}
        shared = df.sparkSession.sparkContext.broadcast(hits)
        return df.select(row_id, _swapped(shared)(F.col(column)).alias(output))
    rows = df.select(F.col(row_id).alias("_row"), F.col(column).alias("_text"))
    texts = stage(rows.mapInArrow(_chunked, StructType([*rows.schema]).add("_chunk", "long")), "glossary-texts")
    said = texts.select(F.col("_chunk").alias("_in"), F.explode(F.split("_text", " ")).alias("word")).distinct()
    found = said.join(targets, "word").groupBy("_in")
    done = StructType([rows.schema["_row"]]).add("_done", "string")
    translated = texts.groupBy("_chunk").cogroup(found).applyInArrow(_translate_chunk, done)
    return translated.select(F.col("_row").alias(row_id), F.col("_done").alias(output))
