"""Registered queries: translation, ordinals, resumption and streams."""

from __future__ import annotations

from functools import partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lexiloom.catalog import fixtures
from lexiloom.catalog.fixtures import GLOSSARY, MAX_WORDS
from lexiloom.catalog.sql import (
    ASCII_NO_HAN,
    INTEGER,
    MISSING,
    PAIRS,
    REASONING,
    REJECTED,
    SEGMENTS,
    TRIPLETS,
    TURNS,
    chunks_of,
    sentences_of,
    too_long,
    translated,
)
from lexiloom.operators import indexing, translation
from lexiloom.operators.engines import Glossary, Retrying, TranslatorEngine, WordSwap
from lexiloom.plans import jobs
from lexiloom.schemas import PAIR_COLUMNS, REASONING_COLUMNS, TRIPLET_COLUMNS, conform, lists_as_json
from lexiloom.session import new_folder
from lexiloom.sources import readers
from lexiloom.streaming.flushes import flush_batches, flush_every, forget_commit, read_flushes
from lexiloom.streaming.incremental import follow, run_to_end
from lexiloom.streaming.ordered import gap_free, in_order

NATIVE = Glossary(GLOSSARY)
OUTSIDE = TranslatorEngine(partial(WordSwap, GLOSSARY))
LIMITED = TranslatorEngine(partial(WordSwap, GLOSSARY, MAX_WORDS), on_error="quarantine")
TURN_SCHEMA = "conv_id BIGINT, turn BIGINT, role STRING, text STRING"
CHUNK = 20


class FailsAtFirst(WordSwap):
    """Fails on the first call each partition makes, as a cold server may."""

    def __init__(self) -> None:
        super().__init__(GLOSSARY)
        self.calls = 0

    def translate(self, texts: list[str]) -> list[str]:
        self.calls += 1
        if self.calls == 1:
            raise ConnectionError("not ready")
        return super().translate(texts)


class Paced(WordSwap):
    """A limited translator that takes a second for each word, by its own clock."""

    def __init__(self) -> None:
        super().__init__(GLOSSARY, MAX_WORDS)
        self.now = 0.0

    def translate(self, texts: list[str]) -> list[str]:
        self.now += sum(len(text.split(" ")) for text in texts)
        return super().translate(texts)


def _patient() -> Retrying:
    return Retrying(FailsAtFirst(), attempts=3, first_delay=0.01)


# -- ordinals ---------------------------------------------------------------


def with_index(spark: SparkSession, sf: str) -> DataFrame:
    """Ordinal by position in the stored files: no shuffle."""
    return fixtures.turns(spark, sf).select("index", "conv_id", "turn")


def with_order_index(spark: SparkSession, sf: str) -> DataFrame:
    """Ordinal by an order: events by time."""
    events = fixtures.table(spark, sf, "events").select("event_id", "ts", "event_type")
    return indexing.with_order_index(events, "ts", "event_id").select("index", "event_id", "event_type")


def pair_fields(spark: SparkSession, sf: str) -> DataFrame:
    return translation.pair_fields(fixtures.pair_rows(spark, sf))


def triplet_fields(spark: SparkSession, sf: str) -> DataFrame:
    return lists_as_json(translation.triplet_fields(fixtures.triplet_rows(spark, sf)))


def list_to_json(spark: SparkSession, sf: str) -> DataFrame:
    """Pairs with their list column as JSON text."""
    return lists_as_json(fixtures.pair_rows(spark, sf))


SKIP, TAKE = 50, 200


def slice_by_index(spark: SparkSession, sf: str) -> DataFrame:
    chosen = indexing.slice_by_index(fixtures.turns(spark, sf), SKIP, TAKE)
    return chosen.select("index", "conv_id", "turn", "text")


def _first_run(spark: SparkSession, sf: str) -> DataFrame:
    """What a run with the limited translator gets done: the quarantined rows are missing."""
    return translation.good_rows(translation.translate_pairs(fixtures.pair_rows(spark, sf), LIMITED))


def resume_antijoin(spark: SparkSession, sf: str) -> DataFrame:
    todo = indexing.pending(fixtures.pair_rows(spark, sf), _first_run(spark, sf))
    return translation.pair_fields(todo)


def resume_point(spark: SparkSession, sf: str) -> DataFrame:
    return indexing.resume_point(_first_run(spark, sf))


def contiguous_prefix(spark: SparkSession, sf: str) -> DataFrame:
    """Turns up to the first one missing when system turns were not worked on."""
    done = fixtures.turns(spark, sf).filter("role <> 'system'")
    return indexing.contiguous_prefix(done).select("index", "conv_id", "turn")


def ordered_output(spark: SparkSession, sf: str) -> DataFrame:
    done = translation.translate_pairs(fixtures.pair_rows(spark, sf), NATIVE)
    return conform(translation.good_rows(done), PAIR_COLUMNS).orderBy("index")


# -- translation ------------------------------------------------------------


def lexicon_translate(spark: SparkSession, sf: str) -> DataFrame:
    """The glossary as a native expression."""
    docs = fixtures.table(spark, sf, "documents")
    return docs.select("doc_id", NATIVE.text(F.col("text")).alias("translation"))


def glossary_table(spark: SparkSession, sf: str) -> DataFrame:
    """The glossary as a table: here every word of the questions, put in brackets."""
    said = fixtures.table(spark, sf, "conversations")
    words = said.filter("role = 'user'").select(F.explode(F.split("text", " ")).alias("word"))
    glossary = words.distinct().select("word", F.concat(F.lit("["), "word", F.lit("]")).alias("target"))
    docs = fixtures.table(spark, sf, "documents").select("doc_id", "text")
    return translation.translate_by_glossary_table(docs, "text", glossary, "doc_id")


def translate_column(spark: SparkSession, sf: str) -> DataFrame:
    docs = fixtures.table(spark, sf, "documents").select("doc_id", "text")
    return translation.translate_column(docs, "text", OUTSIDE).select("doc_id", "translation")


def translate_retry(spark: SparkSession, sf: str) -> DataFrame:
    docs = fixtures.table(spark, sf, "documents").select("doc_id", "text")
    engine = TranslatorEngine(_patient)
    return translation.translate_column(docs, "text", engine).select("doc_id", "translation")


def translate_distinct(spark: SparkSession, sf: str) -> DataFrame:
    docs = fixtures.table(spark, sf, "documents").select("doc_id", "text")
    done = translation.translate_distinct(docs, "text", OUTSIDE, "doc_id")
    return done.select("doc_id", "translation")


def translate_pairs(spark: SparkSession, sf: str) -> DataFrame:
    return translation.translate_pairs(fixtures.pair_rows(spark, sf), OUTSIDE)


def translate_triplets(spark: SparkSession, sf: str) -> DataFrame:
    return lists_as_json(translation.translate_triplets(fixtures.triplet_rows(spark, sf), OUTSIDE))


def translate_markup(spark: SparkSession, sf: str) -> DataFrame:
    done = translation.translate_markup(fixtures.markup_texts(spark, sf), "text", OUTSIDE)
    return done.select("index", "translation")


def translate_cot(spark: SparkSession, sf: str) -> DataFrame:
    return translation.translate_reasoning(
        fixtures.reasoning_rows(spark, sf).drop("opening"), OUTSIDE, limit=CHUNK
    )


def output_contract(spark: SparkSession, sf: str) -> DataFrame:
    done = translation.translate_triplets(fixtures.triplet_rows(spark, sf), NATIVE)
    return lists_as_json(conform(translation.good_rows(done), TRIPLET_COLUMNS))


def quarantine(spark: SparkSession, sf: str) -> DataFrame:
    done = translation.translate_pairs(fixtures.pair_rows(spark, sf), LIMITED)
    return translation.quarantined_rows(done).select("index", "Q_original", "A_original", "reason")


def run_audit(spark: SparkSession, sf: str) -> DataFrame:
    done = translation.translate_pairs(fixtures.pair_rows(spark, sf), LIMITED)
    return translation.audit_summary(done)


def run_log(spark: SparkSession, sf: str) -> DataFrame:
    """Each row's two lines, by a clock that goes on with the words translated."""
    engine = TranslatorEngine(Paced, on_error="quarantine", clock=lambda translator: translator.now)
    rows = fixtures.turns(spark, sf).select("index", F.array("text", F.col("role")).alias("set"))
    lines = translation.run_log(translation.translate_pairs(rows, engine))
    # Of a rejected row both texts were tried once more, one by one.
    return lines.select("index", "delta", "waited", "event")


def normalize_columns(spark: SparkSession, sf: str) -> DataFrame:
    """All rows under the other layout's names, and back."""
    rows = fixtures.reasoning_rows(spark, sf)
    other = rows.select("index", F.col("prompt").alias("instruction"), F.col("response").alias("output"))
    return readers.normalize_columns(other)


def union_sources(spark: SparkSession, sf: str) -> DataFrame:
    return readers.union_sources(*fixtures.reasoning_sources(spark, sf))


# -- jobs -------------------------------------------------------------------


def job_cot(spark: SparkSession, sf: str) -> DataFrame:
    path = new_folder(spark, "markup")
    written = jobs.markup_corpus(fixtures.markup_texts(spark, sf), path, NATIVE)
    return written.select("index", "translation", "status")


def job_o1(spark: SparkSession, sf: str) -> DataFrame:
    path = new_folder(spark, "reasoning")
    written = jobs.reasoning_corpus(fixtures.reasoning_sources(spark, sf), path, NATIVE)
    return conform(translation.good_rows(written), ["index", *REASONING_COLUMNS])


def job_paq(spark: SparkSession, sf: str) -> DataFrame:
    """A limited run, then an unlimited one that picks up what was quarantined."""
    path = new_folder(spark, "pairs")
    rows = fixtures.pair_rows(spark, sf)
    jobs.pair_corpus(rows, path, LIMITED)
    return jobs.pair_corpus(rows, path, NATIVE)


def job_paq_distinct(spark: SparkSession, sf: str) -> DataFrame:
    """Each text once: first a slice without rows, then a run over all."""
    path = new_folder(spark, "pairs")
    rows = fixtures.pair_rows(spark, sf)
    jobs.pair_corpus(rows, path, NATIVE, skip=10**9, distinct=True)
    return jobs.pair_corpus(rows, path, NATIVE, distinct=True)


def job_qqp_distinct(spark: SparkSession, sf: str) -> DataFrame:
    """Each text once, answers of one row and negatives of another included."""
    rows = fixtures.triplet_rows(spark, sf)
    return lists_as_json(jobs.triplet_corpus(rows, new_folder(spark, "triplets"), NATIVE, distinct=True))


def run_outcomes(spark: SparkSession, sf: str) -> DataFrame:
    """Each row's last outcome after a limited and an unlimited run."""
    path = new_folder(spark, "outcomes")
    rows = fixtures.pair_rows(spark, sf)
    jobs.pair_corpus(rows, path, LIMITED)
    jobs.pair_corpus(rows, path, NATIVE)
    return jobs.last_outcomes(spark.read.parquet(path)).select("index", "status", "reason")


def job_qqp(spark: SparkSession, sf: str) -> DataFrame:
    path = new_folder(spark, "triplets")
    rows = fixtures.triplet_rows(spark, sf)
    jobs.triplet_corpus(rows, path, LIMITED)
    return lists_as_json(jobs.triplet_corpus(rows, path, NATIVE))


# -- streams ----------------------------------------------------------------


def _translate_turns(stream: DataFrame) -> DataFrame:
    return stream.select("conv_id", "turn", NATIVE.text(F.col("text")).alias("translation"))


def stream_translate(spark: SparkSession, sf: str) -> DataFrame:
    path = new_folder(spark, "stream")
    run_to_end(
        follow(spark, f"{sf}/conversations*", TURN_SCHEMA, files_per_trigger=1),
        _translate_turns,
        f"{path}/out",
        f"{path}/checkpoint",
    )
    return spark.read.parquet(f"{path}/out")


def stream_resume(spark: SparkSession, sf: str) -> DataFrame:
    """The same stream run twice with one checkpoint: the second run adds nothing."""
    path = new_folder(spark, "stream")
    for _ in range(2):
        run_to_end(
            follow(spark, f"{sf}/conversations*", TURN_SCHEMA),
            _translate_turns,
            f"{path}/out",
            f"{path}/checkpoint",
        )
    return spark.read.parquet(f"{path}/out").select("conv_id", "turn")


def stream_append(spark: SparkSession, sf: str) -> DataFrame:
    """New files arrive between two runs; the second appends them alone."""
    path = new_folder(spark, "stream")
    said = fixtures.table(spark, sf, "conversations")
    for arrived in (F.col("role") == "user", F.col("role") != "user"):
        said.filter(arrived).write.mode("append").parquet(f"{path}/in")
        run_to_end(
            follow(spark, f"{path}/in", TURN_SCHEMA),
            lambda turns: turns.select("conv_id", "turn", "role"),
            f"{path}/out",
            f"{path}/checkpoint",
        )
    return spark.read.parquet(f"{path}/out")


# Ordinals of a state in ``stream_ordered``, small so that there are many of them.
RANGE_ROWS = 200


def stream_ordered(spark: SparkSession, sf: str) -> DataFrame:
    """Turns that arrive out of order leave in order, half of them in a second run.

    ``run`` tells in which of both a turn left: in the first only those before the
    first gap of their range.
    """
    path = new_folder(spark, "stream")
    place = F.md5(F.col("index").cast("string"))
    late = F.conv(F.substring(place, 1, 8), 16, 10).cast("bigint") % 2 == 1
    turns = fixtures.turns(spark, sf)
    for run, arrived in enumerate((~late, late), 1):
        turns.filter(arrived).repartitionByRange(6, place).sortWithinPartitions(place).write.mode("append").parquet(f"{path}/in")
        run_to_end(
            follow(spark, f"{path}/in", f"index BIGINT, {TURN_SCHEMA}", files_per_trigger=3),
            lambda stream: in_order(stream, range_rows=RANGE_ROWS).withColumn("run", F.lit(run)),  # noqa: B023
            f"{path}/out",
            f"{path}/checkpoint",
        )
    left = gap_free(spark.read.parquet(f"{path}/out"), range_rows=RANGE_ROWS)
    return left.select("index", "conv_id", "turn", NATIVE.text(F.col("text")).alias("translation"), "run")


def stream_every(spark: SparkSession, sf: str) -> DataFrame:
    """Flushes by time; beside each row, how many rows of its flush are in the log."""
    path = new_folder(spark, "stream")
    said = fixtures.table(spark, sf, "conversations")
    said.repartition(4, "conv_id").write.parquet(f"{path}/in")
    log = flush_every(
        follow(spark, f"{path}/in", TURN_SCHEMA, files_per_trigger=1),
        _translate_turns,
        f"{path}/out",
        f"{path}/checkpoint",
        f"{path}/log",
        "500 milliseconds",
    )
    rows = read_flushes(spark, f"{path}/out", "conv_id BIGINT, turn BIGINT, translation STRING")
    counts = rows.groupBy("batch").agg(F.count(F.lit(1)).alias("written"))
    both = log.join(counts, log["flush"] == counts["batch"], "full_outer")
    logged, agreed = both.agg(F.sum("rows"), F.every(F.col("rows").eqNullSafe(F.col("written")))).first()
    return rows.drop("batch").withColumns({"logged": F.lit(logged), "agreed": F.lit(agreed)})


def stream_batches(spark: SparkSession, sf: str) -> DataFrame:
    """A batch is played twice, as after a failure between its output and its commit."""
    path = new_folder(spark, "stream")
    said = fixtures.table(spark, sf, "conversations")
    said.repartition(4, "conv_id").write.parquet(f"{path}/in")
    stream = follow(spark, f"{path}/in", TURN_SCHEMA, files_per_trigger=2)
    for _ in range(2):
        flush_batches(stream, _translate_turns, f"{path}/out", f"{path}/checkpoint").awaitTermination()
        forget_commit(spark, f"{path}/checkpoint", 1)
    rows = read_flushes(spark, f"{path}/out", "conv_id BIGINT, turn BIGINT, translation STRING")
    return rows.drop("batch")


QUERIES = {
    query.__name__: query
    for query in (
        with_index,
        with_order_index,
        pair_fields,
        triplet_fields,
        list_to_json,
        slice_by_index,
        resume_antijoin,
        resume_point,
        contiguous_prefix,
        ordered_output,
        lexicon_translate,
        glossary_table,
        translate_column,
        translate_retry,
        translate_distinct,
        translate_pairs,
        translate_triplets,
        translate_markup,
        translate_cot,
        output_contract,
        quarantine,
        run_audit,
        run_outcomes,
        run_log,
        normalize_columns,
        union_sources,
        job_cot,
        job_o1,
        job_paq,
        job_paq_distinct,
        job_qqp_distinct,
        job_qqp,
        stream_translate,
        stream_resume,
        stream_append,
        stream_ordered,
        stream_every,
        stream_batches,
    )
}

_SCORE = f"""{PAIRS},
judged AS (
  SELECT *, CASE WHEN a IS NULL THEN '{MISSING}'
    WHEN {too_long("q")} OR {too_long("a")} THEN '{REJECTED}' END AS reason FROM paq
)"""
_PAIR = f"""q AS "Q_original", a AS "A_original",
  {translated("q")} AS "Q_traducida", {translated("a")} AS "A_traducida\""""
_PAIR_IF = f"""q AS "Q_original", a AS "A_original",
  CASE WHEN a IS NOT NULL THEN {translated("q")} END AS "Q_traducida",
  CASE WHEN a IS NOT NULL THEN {translated("a")} END AS "A_traducida\""""
_NEG = f"list_transform(neg, lambda n: {translated('n')})"
_JSON = "CAST(to_json({0}) AS VARCHAR)"
_TRIPLET = f"""query AS "Q_original", pos AS "POS_original", {_JSON.format("neg")} AS "NEGs_original",
  {translated("query")} AS "Q_traducida", {translated("pos")} AS "POS_traducida",
  {_JSON.format(_NEG)} AS "NEGs_traducidas\""""
_DOCS = f"SELECT doc_id, {translated('text')} AS translation FROM documents"
_MARKUP = f"""WITH {SEGMENTS}
SELECT page_id AS "index", string_agg(
  CASE WHEN is_tag OR {INTEGER.format("text")} THEN text ELSE {translated("text")} END, '' ORDER BY pos)
  AS translation FROM segments GROUP BY page_id"""


def _speech(tag: str, limit: int) -> str:
    """A response's blocks as sentences, cut, translated and joined by spaces."""
    blocks = f"regexp_extract_all(response, '(?s)<{tag}>(.*?)</{tag}>', 1)"
    sentences = f"flatten(list_transform({blocks}, lambda b: {sentences_of('b')}))"
    chunks = f"flatten(list_transform({sentences}, lambda c: {chunks_of('c', limit)}))"
    return f"array_to_string(list_transform({chunks}, lambda t: {translated('t')}), ' ')"


def _reasoning(limit: int) -> str:
    return f"""{translated("prompt")} AS prompt, {_speech("Thought", limit)} AS response_thoughts,
  {_speech("Output", limit)} AS response_salida,
  prompt AS original_prompt, response AS original_response"""


_PASSES = ASCII_NO_HAN.format("prompt")

SQL = {
    "with_index": f'WITH {TURNS} SELECT "index", conv_id, turn FROM conv',
    "with_order_index": """SELECT row_number() OVER (ORDER BY ts, event_id) - 1 AS "index",
  event_id, event_type FROM events""",
    "pair_fields": f'WITH {PAIRS} SELECT "index", q AS "Q_original", a AS "A_original" FROM paq',
    "triplet_fields": f"""WITH {TRIPLETS}
SELECT "index", query AS "Q_original", pos AS "POS_original", {_JSON.format("neg")} AS "NEGs_original"
FROM qqp""",
    "list_to_json": f"""WITH {PAIRS}
SELECT "index", {_JSON.format("CASE WHEN a IS NULL THEN [q] ELSE [q, a] END")} AS "set" FROM paq""",
    "slice_by_index": f"""WITH {TURNS}
SELECT "index", conv_id, turn, text FROM conv WHERE "index" >= {SKIP} AND "index" < {SKIP + TAKE}""",
    "resume_antijoin": f"""WITH {_SCORE}
SELECT "index", q AS "Q_original", a AS "A_original" FROM judged WHERE reason IS NOT NULL""",
    "resume_point": f"""WITH {_SCORE}
SELECT max("index") AS last_index, coalesce(max("index") + 1, 0) AS next_index
FROM judged WHERE reason IS NULL""",
    "contiguous_prefix": f"""WITH {TURNS}
SELECT "index", conv_id, turn FROM conv WHERE "index" < coalesce(
  (SELECT min("index") FROM conv WHERE role = 'system'), (SELECT max("index") + 1 FROM conv))""",
    "ordered_output": f'WITH {PAIRS} SELECT "index", {_PAIR} FROM paq WHERE a IS NOT NULL ORDER BY "index"',
    "lexicon_translate": _DOCS,
    "glossary_table": """WITH known AS (
  SELECT DISTINCT unnest(string_split(text, ' ')) AS word FROM conversations WHERE role = 'user'),
words AS (
  SELECT doc_id, unnest(string_split(text, ' ')) AS word,
    generate_subscripts(string_split(text, ' '), 1) AS place FROM documents)
SELECT doc_id, string_agg(CASE WHEN k.word IS NULL THEN w.word ELSE '[' || w.word || ']' END, ' ' ORDER BY place)
  AS translation
FROM words w LEFT JOIN known k ON k.word = w.word GROUP BY doc_id""",
    "translate_column": _DOCS,
    "translate_retry": _DOCS,
    "translate_distinct": _DOCS,
    "translate_pairs": f"""WITH {PAIRS}
SELECT "index", {_PAIR_IF}, CASE WHEN a IS NULL THEN '{MISSING}' END AS reason,
  CASE WHEN a IS NULL THEN 'quarantined' ELSE 'ok' END AS status FROM paq""",
    "translate_triplets": f"""WITH {TRIPLETS}
SELECT "index", query AS "Q_original", pos AS "POS_original", {_JSON.format("neg")} AS "NEGs_original",
  CASE WHEN pos IS NOT NULL THEN {translated("query")} END AS "Q_traducida",
  CASE WHEN pos IS NOT NULL THEN {translated("pos")} END AS "POS_traducida",
  CASE WHEN pos IS NOT NULL THEN {_JSON.format(_NEG)} END AS "NEGs_traducidas",
  CASE WHEN pos IS NULL THEN '{MISSING}' END AS reason,
  CASE WHEN pos IS NULL THEN 'quarantined' ELSE 'ok' END AS status FROM qqp""",
    "translate_markup": _MARKUP,
    "translate_cot": f"""WITH {REASONING}
SELECT "index", {_reasoning(CHUNK)}, 'ok' AS status, CAST(NULL AS VARCHAR) AS reason
FROM o1 WHERE response IS NOT NULL AND {_PASSES}
UNION ALL SELECT "index", NULL, NULL, NULL, prompt, response, 'quarantined', '{MISSING}'
FROM o1 WHERE response IS NULL""",
    "output_contract": f'WITH {TRIPLETS} SELECT "index", {_TRIPLET} FROM qqp WHERE pos IS NOT NULL',
    "quarantine": f"""WITH {_SCORE}
SELECT "index", q AS "Q_original", a AS "A_original", reason FROM judged WHERE reason IS NOT NULL""",
    "run_audit": f"""WITH {_SCORE}
SELECT CASE WHEN reason IS NULL THEN 'ok' ELSE 'quarantined' END AS status, reason, count(*) AS rows
FROM judged GROUP BY 1, 2""",
    "run_outcomes": f"""WITH {PAIRS}
SELECT "index", CASE WHEN a IS NULL THEN 'quarantined' ELSE 'ok' END AS status,
  CASE WHEN a IS NULL THEN '{MISSING}' END AS reason FROM paq""",
    "run_log": f"""WITH {TURNS},
timed AS (
  SELECT "index", len(string_split(text, ' ')) AS words, len(string_split(role, ' ')) AS others,
    {too_long("text")} OR {too_long("role")} AS rejected, text IS NULL OR role IS NULL AS missing FROM conv)
SELECT "index", 0.0 AS delta, 0.0 AS waited, 'picked up' AS event FROM timed
UNION ALL SELECT "index", CASE WHEN missing THEN 0 WHEN rejected THEN 2 * (words + others) ELSE words + others END::DOUBLE, 0.0,
  CASE WHEN missing THEN 'quarantined: {MISSING}' WHEN rejected THEN 'quarantined: {REJECTED}' ELSE 'done' END FROM timed""",
    "normalize_columns": f'WITH {REASONING} SELECT "index", prompt, response FROM o1',
    "union_sources": f'WITH {REASONING} SELECT "index", prompt, response FROM o1',
    "job_cot": _MARKUP.replace("AS translation", "AS translation, 'ok' AS status"),
    "job_o1": f"""WITH {REASONING}
SELECT "index", {_reasoning(470)} FROM o1 WHERE response IS NOT NULL AND {_PASSES}""",
    "job_paq": f'WITH {PAIRS} SELECT "index", {_PAIR} FROM paq WHERE a IS NOT NULL',
    "job_paq_distinct": f'WITH {PAIRS} SELECT "index", {_PAIR} FROM paq WHERE a IS NOT NULL',
    "job_qqp_distinct": f'WITH {TRIPLETS} SELECT "index", {_TRIPLET} FROM qqp WHERE pos IS NOT NULL',
    "job_qqp": f'WITH {TRIPLETS} SELECT "index", {_TRIPLET} FROM qqp WHERE pos IS NOT NULL',
    "stream_translate": f"SELECT conv_id, turn, {translated('text')} AS translation FROM conversations",
    "stream_resume": "SELECT conv_id, turn FROM conversations",
    "stream_append": "SELECT conv_id, turn, role FROM conversations",
    "stream_ordered": f"""WITH {TURNS},
arrived AS (SELECT *, ('0x' || substr(md5(CAST("index" AS VARCHAR)), 1, 8))::BIGINT % 2 = 1 AS late FROM conv),
gaps AS (SELECT "index" // {RANGE_ROWS} AS part, min("index") AS gap FROM arrived WHERE late GROUP BY 1)
SELECT "index", conv_id, turn, {translated("text")} AS translation,
  CASE WHEN gap IS NULL OR "index" < gap THEN 1 ELSE 2 END AS run
FROM arrived LEFT JOIN gaps ON part = "index" // {RANGE_ROWS}""",
    "stream_every": f"""SELECT conv_id, turn, {translated("text")} AS translation,
  CAST(count(*) OVER () AS BIGINT) AS logged, true AS agreed FROM conversations""",
    "stream_batches": f"SELECT conv_id, turn, {translated('text')} AS translation FROM conversations",
}
