"""The composite jobs: each reads tables, composes operators and writes outputs."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from lexiloom.functions.names import batch_id
from lexiloom.operators import detection, dictionary, export, indexing, pairs, translation
from lexiloom.operators.engines import Engine
from lexiloom.schemas import (
    DICTIONARY,
    PAIR_COLUMNS,
    REASONING_COLUMNS,
    SCORED_PAIR_COLUMNS,
    SCORED_PAIRS,
    TRIPLET_COLUMNS,
    conform,
)
from lexiloom.session import stage, staging
from lexiloom.sources import readers, writers


def clean_images(
    rows: DataFrame,
    out: str,
    image_format: str = "png",
    limit: int | None = None,
    overwrite: bool = True,
    max_rows: int | None = None,
    index: str = "index",
    **detector: object,
) -> DataFrame:
    """Filter by detector, save, export manifest and assets, publish.

    One pass over ``rows`` writes those that stay and those without a payload list
    (``rows``, by ``outcome``), runs the detector once and counts (``totals``).
    Manifest and assets read what was kept; what is published is a record of its
    files. ``max_rows`` counts scanned rows by the ordinal column ``index``,
    ``limit`` counts manifest lines. Returns (version, rows) of the published table.

    Spark counts a task again that had to be redone for a lost executor; the number
    of rows kept is therefore held against the written footers, and where they
    differ the totals are taken from a pass of their own.
    """
    spark = rows.sparkSession
    if max_rows is not None:
        rows = indexing.slice_by_index(rows, 0, max_rows, index)
    seen = Observation("outcomes")
    told = detection.with_outcome(rows, **detector).observe(seen, *detection.outcome_counts())
    writers.write_table(told.filter(F.col("outcome") != detection.DROPPED), f"{out}/rows", overwrite, "outcome")
    kept_rows = f"{out}/rows/outcome={detection.KEPT}"
    if not writers.exists(spark, kept_rows):  # nothing was kept
        writers.write_table(rows.limit(0), kept_rows)
    kept = spark.read.schema(rows.schema).parquet(kept_rows)
    published = writers.publish_table(spark, kept_rows, f"{out}/published")
    totals = seen.get
    if totals["kept"] != published.first().rows:
        totals = detection.with_outcome(rows, **detector).agg(*detection.outcome_counts()).first().asDict()
    names = ("scanned", "kept", "dropped", "without_list")
    counted = spark.createDataFrame([tuple(totals[n] for n in names)], ", ".join(f"{n} BIGINT" for n in names))
    writers.write_table(counted, f"{out}/totals", overwrite)
    writers.write_csv(export.manifest(kept, image_format, limit), f"{out}/manifest", overwrite)
    writers.write_table(export.asset_table(kept, image_format), f"{out}/images", overwrite)
    return published


def sentence_similarity(
    sentences: DataFrame, out: str, blocks_per_folder: int = 10, **options: int
) -> DataFrame:
    """Sampled, scored, deduplicated pairs, written by batch; returns them.

    A folder takes the pairs of many blocks, and its blocks are worked on by one
    task, so it is one file and the pairs are not shuffled again to be written.
    """
    size = options.get("block_size", pairs.BLOCK_SIZE) * blocks_per_folder
    found = pairs.similar_pairs(sentences, together=blocks_per_folder, **options).withColumn(
        "batch_id", batch_id(F.col("idx1"), size)
    )
    writers.write_batches(found, out, "batch_id", size, gather=False, only=True)
    written = readers.read_batches(sentences.sparkSession, out, SCORED_PAIRS)
    return conform(written, SCORED_PAIR_COLUMNS)


def consolidate(spark: SparkSession, batches: str, out: str) -> DataFrame:
    """Batch outputs to one deduplicated CSV; returns the statistics.

    The batches are read twice and no text is shuffled: the first time pairs are
    counted and the places found of those that stay, the second time these go into the
    CSV from where they lie. Both times all columns are read, so that the second sees
    the rows of the first. The rows of each file are counted as well, in one sum over
    hashes of their addresses, which is held against the footers. Only where that
    differs are the files read again, to name those that are broken (``out``-skipped:
    file, rows, read); ``files_skipped`` counts them. If the counts cannot be right
    (Spark counts a redone task again) they are taken from the batches as well.
    """
    loaded = readers.read_batches(spark, batches, SCORED_PAIRS)
    seen, left = Observation("loaded"), Observation("written")
    own = F.count_if(F.col("idx1") == F.col("idx2")).alias("own")
    mark = F.sum("_mark").alias("mark")
    texts = [F.count(name).alias(name) for name in ("sentence1", "sentence2")]
    with staging(spark):
        files = stage(readers.file_rows(spark, batches), "batch-files")
        marked = loaded.withColumn("_mark", readers.file_mark(F.col("_metadata.file_path")))
        numbered = indexing.number_rows(marked, files, "_number")
        watched = numbered.observe(seen, F.count(F.lit(1)).alias("rows"), own, mark, *texts)
        first_seen = ["batch_no", "idx1", "idx2", "similarity"]
        first = stage(pairs.first_numbers(watched, first_seen, "_number"), "first-seen")
        final = detection.only_chosen(numbered, first, "_number").observe(left, F.count(F.lit(1)).alias("rows"))
        writers.write_csv(conform(final, SCORED_PAIR_COLUMNS), out)
        final_pairs = first.count()
        footers = files.agg(
            F.count_if(F.col("rows").isNull()).alias("broken"),
            F.coalesce(F.sum("rows"), F.lit(0)).alias("rows"),
            F.sum(readers.file_mark(F.col("file")) * F.col("rows")).alias("mark"),
        ).first()
    if left.get["rows"] < final_pairs:
        raise RuntimeError("the batches changed while they were read")
    whole = not footers.broken and (seen.get["mark"] or 0) == (footers.mark or 0)
    none = spark.createDataFrame([], "file STRING, rows BIGINT, read BIGINT")
    writers.write_table(none if whole else readers.skipped_files(spark, batches, SCORED_PAIRS), f"{out}-skipped")
    broken = spark.read.schema(none.schema).parquet(f"{out}-skipped")
    skipped, lost = broken.agg(F.count(F.lit(1)), F.coalesce(F.sum(F.coalesce("rows", "read") - F.col("read")), F.lit(0))).first()
    if seen.get["rows"] != footers.rows - lost:
        return pairs.pair_dedup_stats(loaded).withColumn("files_skipped", F.lit(skipped))
    total, selves = seen.get["rows"], seen.get["own"]
    row = (total, selves, total - selves - final_pairs, final_pairs, skipped)
    names = ("initial_pairs", "self_pairs_removed", "duplicates_removed", "final_pairs", "files_skipped")
    return spark.createDataFrame([row], ", ".join(f"{n} BIGINT" for n in names))


def markup_corpus(
    texts: DataFrame,
    out: str,
    engine: Engine,
    column: str = "text",
    index: str = "index",
    max_samples: int | None = None,
) -> DataFrame:
    """Markup-safe translation of a text table, resumable; returns what was written.

    The CSV has the good rows of all runs in index order.
    """

    def translate(rows: DataFrame) -> DataFrame:
        done = translation.translate_markup(rows, column, engine)
        return done.select(index, "translation", "status", "reason")

    written = _resumable(texts, f"{out}/rows", translate, 0, max_samples, index)
    good = translation.good_rows(written).orderBy(index)
    writers.write_csv(good.select("translation"), f"{out}/csv")
    return written


def reasoning_corpus(
    sources: list[DataFrame],
    out: str,
    engine: Engine,
    max_samples: int | None = None,
    index: str | None = None,
) -> DataFrame:
    """Prompt/response sources to translated thoughts and outputs, resumable.

    ``max_samples`` needs the name of an ordinal column to count by. Without one,
    rows are told apart by a digest of their texts, in ``row_key``.
    """
    together = readers.union_sources(*sources)
    key = index
    if key is None:
        if max_samples is not None:
            raise ValueError("max_samples counts by an index column")
        key = "row_key"
        texts = F.to_json(F.struct("prompt", "response"), {"ignoreNullFields": "false"})
        together = together.withColumn(key, F.sha2(texts, 256))

    def translate(rows: DataFrame) -> DataFrame:
        return translation.translate_reasoning(rows, engine)

    written = _resumable(together, f"{out}/rows", translate, None if index is None else 0, max_samples, key)
    good = conform(translation.good_rows(written).orderBy(key), REASONING_COLUMNS)
    writers.write_csv(good, f"{out}/csv")
    return written


def _resumable(
    df: DataFrame,
    out: str,
    translate: Callable[[DataFrame], DataFrame],
    skip: int | None,
    max_rows: int | None,
    index: str = "index",
) -> DataFrame:
    """Translate the rows of a slice that ``out`` does not hold yet, append them.

    Good rows already written are passed over; quarantined ones are tried
    again. The slice is by absolute ordinal, so a restart does not widen it;
    without ``skip`` all rows are in it. Without any row the result is empty.
    """
    spark = df.sparkSession
    todo = df if skip is None else indexing.slice_by_index(df, skip, max_rows, index)
    with staging(spark):
        if writers.exists(spark, out):
            told = StructType([todo.schema[index]]).add("status", "string")
            before = spark.read.schema(told).parquet(out).filter(F.col("status") == translation.OK)
            todo = indexing.pending(todo, before, index)
        done = translate(todo)
        writers.append_run(done, out)
        schema = done.withColumn("processed_at", F.current_timestamp()).schema
    return spark.read.schema(schema).parquet(out)


def last_outcomes(written: DataFrame, index: str = "index") -> DataFrame:
    """(index, status, reason, processed_at): each row's latest outcome over all runs."""
    latest = F.max_by(F.struct("status", "reason"), "processed_at")
    return (
        written.groupBy(index)
        .agg(latest.alias("_last"), F.max("processed_at").alias("processed_at"))
        .select(index, "_last.status", "_last.reason", "processed_at")
    )


def pair_corpus(
    df: DataFrame,
    out: str,
    engine: Engine,
    skip: int = 0,
    max_rows: int | None = None,
    distinct: bool = False,
) -> DataFrame:
    """Question/answer pairs, resumable; returns the good rows in index order.

    With ``distinct``, each text of a run is translated once, however many rows have it.
    """
    rows = _resumable(df, out, lambda d: translation.translate_pairs(d, engine, distinct), skip, max_rows)
    return conform(translation.good_rows(rows), PAIR_COLUMNS).orderBy("index")


def triplet_corpus(
    df: DataFrame,
    out: str,
    engine: Engine,
    skip: int = 0,
    max_rows: int | None = None,
    distinct: bool = False,
) -> DataFrame:
    """Query/positive/negatives rows, resumable; good rows in index order.

    With ``distinct``, each text of a run is translated once, however many rows have it.
    """
    rows = _resumable(df, out, lambda d: translation.translate_triplets(d, engine, distinct), skip, max_rows)
    return conform(translation.good_rows(rows), TRIPLET_COLUMNS).orderBy("index")


def dictionary_from_lines(spark: SparkSession, lines: str, out: str) -> tuple[DataFrame, DataFrame]:
    """From JSON lines to both tables; lines that are no JSON go to ``out``/quarantine."""
    entries, corrupt = readers.split_corrupt(readers.scan_dictionary(spark, lines, DICTIONARY))
    writers.write_table(corrupt, f"{out}/quarantine")
    return dictionary_tables(entries, out)


def dictionary_tables(entries: DataFrame, out: str) -> tuple[DataFrame, DataFrame]:
    """Definitions and word forms as CSV; returns both."""
    chosen = dictionary.select_entries(entries)
    words, forms = dictionary.definitions(chosen), dictionary.forms(chosen)
    writers.write_csv(words, f"{out}/words")
    writers.write_csv(forms, f"{out}/forms")
    return words, forms
