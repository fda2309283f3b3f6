"""Registered queries: sampled pairs, scoring, deduplication, batches."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lexiloom.catalog import fixtures
from lexiloom.catalog.sql import ALL_DOCUMENTS, SCORED, SENTENCES, sampled
from lexiloom.functions import names
from lexiloom.functions.vectors import cosine
from lexiloom.operators import pairs
from lexiloom.plans import jobs
from lexiloom.schemas import SCORED_PAIR_COLUMNS, SCORED_PAIRS, conform
from lexiloom.session import new_folder, stage
from lexiloom.sources import readers, writers

BLOCK = 100
PARTNERS = 10


def batch_id(spark: SparkSession, sf: str) -> DataFrame:
    idx = F.col("idx")
    return fixtures.document_rows(spark, sf).select("idx", names.batch_id(idx, BLOCK).alias("batch_id"))


def sample_k_per_row(spark: SparkSession, sf: str) -> DataFrame:
    drawn = pairs.sample_partners(
        fixtures.document_rows(spark, sf), block_size=BLOCK, partners=PARTNERS, repeats=2
    )
    return drawn.select("idx1", "rep", F.array_join("partners", ",").alias("partners"))


def sample_pairs(spark: SparkSession, sf: str) -> DataFrame:
    return pairs.sample_pairs(fixtures.document_rows(spark, sf), block_size=BLOCK, partners=PARTNERS)


def score_pairs(spark: SparkSession, sf: str) -> DataFrame:
    """Pairs over a stored table of sentences, of which nothing is shuffled."""
    sentences = fixtures.sentences(spark, sf)
    drawn = pairs.sample_pairs(sentences, block_size=BLOCK, partners=PARTNERS)
    table = pairs.store_vectors(sentences, new_folder(spark, "sentences"), buckets=8)
    return conform(pairs.score_stored(drawn, table), SCORED_PAIR_COLUMNS)


def cosine_query(spark: SparkSession, sf: str) -> DataFrame:
    """Each vector with the next one."""
    vectors = fixtures.table(spark, sf, "embeddings")
    following = vectors.select(
        (F.col("vec_id") - 1).alias("vec_id"), F.col("embedding").alias("following")
    )
    return vectors.join(following, "vec_id").select(
        "vec_id", F.round(cosine(F.col("embedding"), F.col("following")), 6).alias("similarity")
    )


def overlapping(spark: SparkSession, sf: str, texts: bool = True) -> DataFrame:
    """Sampled, scored pairs with copies: close pairs mirrored, far ones as self-pairs.

    Without ``texts``, ``_texted`` adds them later.
    """
    sentences = fixtures.sentences(spark, sf)
    drawn = pairs.sample_pairs(sentences, block_size=BLOCK, partners=PARTNERS)
    scored = pairs.score_pairs(drawn, sentences, texts)
    close, far = F.col("similarity") > 0.2, F.col("similarity") < -0.2

    def copy(first: str, second: str, kind: int):
        ends = [F.col(f"idx{first}").alias("idx1"), F.col(f"idx{second}").alias("idx2")]
        if texts:
            ends += [F.col(f"sentence{first}").alias("sentence1"), F.col(f"sentence{second}").alias("sentence2")]
        return F.array(F.struct(*ends, F.lit(kind).alias("copy")))

    copies = F.concat(
        copy("1", "2", 0),
        F.when(close, copy("2", "1", 1)).when(far, copy("1", "1", 2)).otherwise(F.slice(copy("1", "2", 0), 1, 0)),
    )
    return scored.select(F.inline(copies), "rep", "rank", "similarity")


ORDER = ["idx1", "rep", "rank", "copy", "idx2"]
OVERLAP_COLUMNS = ["idx1", "idx2", "sentence1", "sentence2", "similarity"]


def _texted(spark: SparkSession, sf: str, found: DataFrame) -> DataFrame:
    return pairs.with_texts(found, fixtures.sentences(spark, sf)).select(*OVERLAP_COLUMNS)


def drop_self_pairs(spark: SparkSession, sf: str) -> DataFrame:
    return pairs.drop_self_pairs(overlapping(spark, sf))


def dedup_pairs(spark: SparkSession, sf: str) -> DataFrame:
    """Of a written table, texts last."""
    turned = F.col("idx1") > F.col("idx2")
    order = [(turned.cast("int"), 1), (F.col("rep"), 31), (F.col("rank"), 31), (F.col("copy"), 8)]
    return _texted(spark, sf, pairs.dedup_stored(stage(overlapping(spark, sf, texts=False), "overlapping"), order))


def dedup_pairs_ranked(spark: SparkSession, sf: str) -> DataFrame:
    """Texts last, to the pairs that are left."""
    return _texted(spark, sf, pairs.dedup_pairs_ranked(overlapping(spark, sf, texts=False), ORDER))


def pair_dedup_stats(spark: SparkSession, sf: str) -> DataFrame:
    return pairs.pair_dedup_stats(overlapping(spark, sf))


def job_similarity(spark: SparkSession, sf: str) -> DataFrame:
    path = new_folder(spark, "similarity")
    return jobs.sentence_similarity(fixtures.sentences(spark, sf), path)


def job_similarity_blocks(spark: SparkSession, sf: str) -> DataFrame:
    """Several blocks in several folders, over ids with gaps: every seventh is left free."""
    path = new_folder(spark, "similarity")
    gapped = fixtures.sentences(spark, sf).withColumn("idx", F.expr("idx + idx div 6"))
    found = jobs.sentence_similarity(gapped, path, block_size=BLOCK, blocks_per_folder=2, partners=200)
    return found.select("idx1", "idx2", "sentence1", "sentence2", "similarity")


def _batches(spark: SparkSession, sf: str, chosen: str = "true") -> str:
    """Overlapping pairs written one folder per batch of first rows.

    A batch is a block, so its pairs lie together once they have their texts.
    """
    path = new_folder(spark, "batches")
    found = overlapping(spark, sf, texts=False).filter(chosen)
    rows = pairs.with_block_texts(found, fixtures.sentences(spark, sf), BLOCK, 2 * PARTNERS).select(
        names.batch_id(F.least("idx1", "idx2"), BLOCK).alias("batch_id"),
        "idx1",
        "idx2",
        "sentence1",
        "sentence2",
        "similarity",
    )
    writers.write_batches(rows, path, size=BLOCK, gather=False)
    return path


def _read(spark: SparkSession, sf: str) -> DataFrame:
    return readers.read_batches(spark, _batches(spark, sf), SCORED_PAIRS)


def write_batches(spark: SparkSession, sf: str) -> DataFrame:
    """The batch folders as a partitioned table."""
    written = spark.read.schema(SCORED_PAIRS + ", batch STRING").parquet(_batches(spark, sf))
    return written.groupBy("batch").agg(F.count(F.lit(1)).alias("pairs"))


def read_batches(spark: SparkSession, sf: str) -> DataFrame:
    return _read(spark, sf)


def pairs_per_batch(spark: SparkSession, sf: str) -> DataFrame:
    return pairs.pairs_per_batch(_read(spark, sf).withColumnRenamed("batch_no", "batch_id"))


def batch_number(spark: SparkSession, sf: str) -> DataFrame:
    """Numbers found in batch names, and in names that hold none."""
    rows = fixtures.document_rows(spark, sf)
    first = names.batch_id(F.col("idx"), BLOCK) * BLOCK
    named = F.concat(F.lit("pairs_"), names.batch_name(first, first + BLOCK), F.lit(".parquet"))
    plain = F.concat(F.lit("/batch_7_8/out/pairs_"), F.col("idx").cast("string"), F.lit(".parquet"))
    return rows.select("idx", F.explode(F.array(named, plain)).alias("name")).select(
        "idx", "name", names.batch_number(F.col("name")).alias("batch_no")
    )


def order_batches(spark: SparkSession, sf: str) -> DataFrame:
    return _read(spark, sf).orderBy("batch_no", "idx1", "idx2", "similarity")


def union_batches(spark: SparkSession, sf: str) -> DataFrame:
    """Two runs' batches, read apart and put together by column name: one of the
    pairs as drawn, one of their copies."""
    runs = [_batches(spark, sf, "copy = 0"), _batches(spark, sf, "copy > 0")]
    first, second = (readers.read_batches(spark, run, SCORED_PAIRS) for run in runs)
    return first.unionByName(second).drop("batch_no")


def job_consolidate(spark: SparkSession, sf: str) -> DataFrame:
    path = new_folder(spark, "consolidated")
    jobs.consolidate(spark, _batches(spark, sf), path)
    return spark.read.options(**writers.CSV_READ_OPTIONS).schema(SCORED_PAIRS).csv(path)


def preview(spark: SparkSession, sf: str) -> DataFrame:
    """The first five deduplicated pairs."""
    return dedup_pairs(spark, sf).orderBy("idx1", "idx2").limit(5)


FILES = 4


def output_size(spark: SparkSession, sf: str) -> DataFrame:
    """Of all documents as text, a line each, in a given number of files."""
    path = new_folder(spark, "lines")
    line = F.concat_ws(" ", F.col("doc_id").cast("string"), F.translate("text", "\n", " "))
    writers.write_lines(fixtures.table(spark, sf, "documents").select(line.alias("value")), path, FILES)
    return writers.output_size(spark, path)


QUERIES = {
    "batch_id": batch_id,
    "sample_k_per_row": sample_k_per_row,
    "sample_pairs": sample_pairs,
    "score_pairs": score_pairs,
    "cosine": cosine_query,
    "drop_self_pairs": drop_self_pairs,
    "dedup_pairs": dedup_pairs,
    "dedup_pairs_ranked": dedup_pairs_ranked,
    "pair_dedup_stats": pair_dedup_stats,
    "job_similarity": job_similarity,
    "job_similarity_blocks": job_similarity_blocks,
    "write_batches": write_batches,
    "read_batches": read_batches,
    "pairs_per_batch": pairs_per_batch,
    "batch_number": batch_number,
    "order_batches": order_batches,
    "union_batches": union_batches,
    "job_consolidate": job_consolidate,
    "preview": preview,
    "output_size": output_size,
}

_DRAWN = sampled(BLOCK, PARTNERS)
_OVERLAP = f"""{_DRAWN}, {SCORED},
overlap AS (
  SELECT idx1, idx2, sentence1, sentence2, 0 AS copy, rep, rank, similarity FROM scored
  UNION ALL SELECT idx2, idx1, sentence2, sentence1, 1, rep, rank, similarity FROM scored WHERE similarity > 0.2
  UNION ALL SELECT idx1, idx1, sentence1, sentence1, 2, rep, rank, similarity FROM scored WHERE similarity < -0.2
),
ranked AS (
  SELECT *, row_number() OVER (
    PARTITION BY least(idx1, idx2), greatest(idx1, idx2) ORDER BY idx1, rep, rank, copy, idx2) AS n
  FROM overlap WHERE idx1 <> idx2
)"""
_ROWS = f"""SELECT idx1, idx2, sentence1, sentence2, similarity,
  CAST(least(idx1, idx2) // {BLOCK} * {BLOCK} AS BIGINT) AS batch_no FROM overlap"""
_KEPT = "SELECT idx1, idx2, sentence1, sentence2, similarity FROM ranked WHERE n = 1"

SQL = {
    "batch_id": f"WITH {ALL_DOCUMENTS} SELECT idx, CAST(idx // {BLOCK} AS BIGINT) AS batch_id FROM sents",
    "sample_k_per_row": f"""WITH {sampled(BLOCK, PARTNERS, repeats=2, source=ALL_DOCUMENTS)}
SELECT idx1, rep, string_agg(idx2, ',' ORDER BY rank) AS partners FROM drawn GROUP BY idx1, rep""",
    "sample_pairs": f"""WITH {sampled(BLOCK, PARTNERS, source=ALL_DOCUMENTS)}
SELECT idx1, idx2, rep, rank FROM drawn""",
    "score_pairs": f"""WITH {_DRAWN}, {SCORED}
SELECT idx1, idx2, sentence1, sentence2, similarity FROM scored""",
    "cosine": """SELECT a.vec_id, round(list_cosine_similarity(
  CAST(a.embedding AS DOUBLE[]), CAST(b.embedding AS DOUBLE[])), 6) AS similarity
FROM embeddings a JOIN embeddings b ON b.vec_id = a.vec_id + 1""",
    "drop_self_pairs": f"""WITH {_OVERLAP}
SELECT idx1, idx2, sentence1, sentence2, copy, rep, rank, similarity FROM overlap WHERE idx1 <> idx2""",
    "dedup_pairs": f"WITH {_OVERLAP} {_KEPT}",
    "dedup_pairs_ranked": f"WITH {_OVERLAP} {_KEPT}",
    "pair_dedup_stats": f"""WITH {_OVERLAP}
SELECT (SELECT count(*) FROM overlap) AS initial_pairs,
  (SELECT count(*) FROM overlap WHERE idx1 = idx2) AS self_pairs_removed,
  count(*) FILTER (n > 1) AS duplicates_removed, count(*) FILTER (n = 1) AS final_pairs
FROM ranked""",
    "job_similarity": f"""WITH {sampled(1000, 10)}, {SCORED},
ranked AS (
  SELECT *, row_number() OVER (
    PARTITION BY least(idx1, idx2), greatest(idx1, idx2) ORDER BY idx1, rep, rank) AS n
  FROM scored
)
SELECT idx1, idx2, sentence1, sentence2, similarity FROM ranked WHERE n = 1""",
    "job_similarity_blocks": f"""WITH {SENTENCES.replace("vec_id AS idx", "vec_id + vec_id // 6 AS idx")}
SELECT least(a.idx, b.idx) AS idx1, greatest(a.idx, b.idx) AS idx2, a.text AS sentence1, b.text AS sentence2,
  round(list_cosine_similarity(CAST(a.embedding AS DOUBLE[]), CAST(b.embedding AS DOUBLE[])), 6) AS similarity
FROM sents a JOIN sents b ON a.idx // {BLOCK} = b.idx // {BLOCK} AND a.idx < b.idx""",
    "write_batches": f"""WITH {_OVERLAP}
SELECT 'batch_' || (least(idx1, idx2) // {BLOCK} * {BLOCK}) || '_'
  || (least(idx1, idx2) // {BLOCK} * {BLOCK} + {BLOCK}) AS batch, count(*) AS pairs
FROM overlap GROUP BY 1""",
    "read_batches": f"WITH {_OVERLAP} {_ROWS}",
    "pairs_per_batch": f"""WITH {_OVERLAP}
SELECT CAST(least(idx1, idx2) // {BLOCK} * {BLOCK} AS BIGINT) AS batch_id, count(*) AS pairs
FROM overlap GROUP BY 1""",
    "batch_number": f"""WITH {ALL_DOCUMENTS}
SELECT idx, 'pairs_batch_' || (idx // {BLOCK} * {BLOCK}) || '_' || (idx // {BLOCK} * {BLOCK} + {BLOCK})
  || '.parquet' AS name, CAST(idx // {BLOCK} * {BLOCK} AS BIGINT) AS batch_no FROM sents
UNION ALL SELECT idx, '/batch_7_8/out/pairs_' || idx || '.parquet', CAST(0 AS BIGINT) FROM sents""",
    "order_batches": f"WITH {_OVERLAP} {_ROWS} ORDER BY batch_no, idx1, idx2, similarity",
    "union_batches": f"""WITH {_OVERLAP}
SELECT idx1, idx2, sentence1, sentence2, similarity FROM overlap""",
    "job_consolidate": f"""WITH {_OVERLAP}, r AS ({_ROWS}),
first AS (
  SELECT *, row_number() OVER (PARTITION BY least(idx1, idx2), greatest(idx1, idx2)
    ORDER BY batch_no, idx1, idx2, similarity) AS n
  FROM r WHERE idx1 <> idx2
)
SELECT idx1, idx2, sentence1, sentence2, similarity FROM first WHERE n = 1""",
    "output_size": f"""SELECT CAST({FILES} AS BIGINT) AS files,
  round(sum(strlen(concat_ws(' ', CAST(doc_id AS VARCHAR), text)) + 1) / (1024 * 1024), 2) AS megabytes FROM documents""",
    "preview": f"WITH {_OVERLAP} {_KEPT} ORDER BY idx1, idx2 LIMIT 5",
}
