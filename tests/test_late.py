"""Plans and rows of what fetches texts and payloads last."""

import random

import pytest
from pyspark.sql import functions as F

from lexiloom.catalog import similarity
from lexiloom.operators import detection, pairs
from lexiloom.plans import jobs
from lexiloom.schemas import SCORED_PAIRS
from lexiloom.session import stage
from lexiloom.sources import readers, writers
from tests.conftest import plan_of

ROWS = [(1, 2, 0.5, 0), (2, 1, 0.5, 1), (3, 3, 1.0, 2), (5, 4, 0.1, 3), (4, 5, 0.1, 4), (1, 2, 0.5, 5), (7, 6, 0.2, 6), (8, 9, None, None), (9, 8, None, 7), (None, 1, 0.1, 8)]


@pytest.fixture
def stored(spark):
    made = spark.createDataFrame(ROWS, "idx1 bigint, idx2 bigint, similarity double, seq int")
    return stage(made.withColumn("sentence1", F.repeat(F.lit("long text "), 20)), "copies")


def test_first_by_a_packed_order(stored):
    once = pairs.dedup_stored(stored, [(F.col("seq"), 31)]).collect()
    assert sorted((r.idx1, r.idx2) for r in once) == [(1, 2), (5, 4), (7, 6), (8, 9)]
    by_direction = pairs.dedup_stored(stored, [((F.col("idx1") < F.col("idx2")).cast("int"), 1), (F.col("seq"), 31)])
    assert sorted((r.idx1, r.idx2) for r in by_direction.collect()) == [(2, 1), (5, 4), (7, 6), (9, 8)]
    alike = pairs.dedup_stored(stage(stored.union(stored), "twice"), [(F.lit(0), 1)])
    assert sorted(sorted((r.idx1, r.idx2)) for r in alike.collect()) == [[1, 2], [4, 5], [6, 7], [8, 9]] and alike.columns == stored.columns


def test_values_that_do_not_fit_are_an_error(stored):
    with pytest.raises(Exception, match="more than 2 bits"):
        pairs.dedup_stored(stored, [(F.col("seq"), 2)]).collect()
    with pytest.raises(ValueError):
        pairs.dedup_stored(stored, [(F.col("seq"), 64), (F.col("seq"), 63)])


def test_packed_order_is_the_order_of_the_columns(spark):
    maker = random.Random(2)
    rows = [(maker.choice([None, *range(8)]), maker.randrange(2**60), maker.randrange(2)) for _ in range(300)]
    packed = pairs.packed_order([(F.col("a"), 3), (F.col("b"), 60), (F.col("c"), 1)])
    by_one = [tuple(r)[:3] for r in spark.createDataFrame(rows, "a int, b bigint, c int").withColumn("p", packed).orderBy("p").collect()]
    assert [(r[0] or 0, *r[1:]) for r in by_one] == sorted((a or 0, b, c) for a, b, c in rows)


def test_texts_ride_one_shuffle(spark, stored):
    """Hash aggregation of ids and numbers; texts only where the winners fetch them."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = plan_of(pairs.dedup_stored(stored, [(F.col("seq"), 31)]))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "SortAggregate" not in plan and plan.count("HashAggregate") == 2
    scans = [line for line in plan.splitlines() if "FileScan" in line]
    assert sum("sentence1" in line for line in scans) == 1 and len(scans) == 2


def test_stored_vectors_lie_where_they_are_joined(spark, folder):
    maker = random.Random(7)
    rows = [(i, f"text {i}", [maker.uniform(-1, 1) for _ in range(8)]) for i in range(57)]
    sentences = spark.createDataFrame(rows, "idx bigint, text string, embedding array<float>")
    drawn = pairs.sample_pairs(sentences, block_size=20, partners=6)
    table = pairs.store_vectors(sentences, f"{folder}/s", buckets=4)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        found = pairs.score_stored(drawn, table)
        plan = plan_of(found)
        rows = found.collect()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    scans = [line for line in plan.splitlines() if "FileScan" in line]
    assert len(scans) == 4 and all("Bucketed: true" in line for line in scans)
    # One for each of the four joins: the pairs alone are moved.
    assert plan.count("Exchange hashpartitioning") == 4
    joined = pairs.score_pairs(drawn, sentences).collect()
    key = lambda r: (r.idx1, r.idx2, r["rank"], r.sentence1, r.sentence2, r.similarity)
    assert sorted(map(key, rows)) == sorted(map(key, joined))


@pytest.mark.parametrize("buckets", [8192, 3, 1])
def test_rejected_numbers(spark, buckets):
    """In one piece and in many; rows keep their columns, a NULL number stays."""
    rows = spark.range(0, 400_000, 7).select("id", F.lit("payload").alias("images")).union(spark.createDataFrame([(None, "x")], "id bigint, images string"))
    gone = spark.createDataFrame([(7,), (14,), (32_767 * 7,), (399_994,), (5,), (None,), (10**12,)], "n bigint")
    kept = detection.without_rejected(rows, gone, "id", buckets if buckets == 8192 else 10**9) if buckets == 3 else detection.without_rejected(rows, gone.filter("n < 1e9 or n is null"), "id", buckets)
    assert kept.columns == rows.columns and kept.count() == rows.count() - 4
    assert kept.filter("id in (7, 14, 229369, 399994)").count() == 0 and kept.filter("id is null").count() == 1
    assert detection.without_rejected(rows, gone.filter("false"), "id").count() == rows.count()


def test_payload_rows_are_not_shuffled(spark):
    rows = spark.range(50).select("id", F.array(F.when(F.col("id") % 3 == 0, F.lit("漢")).otherwise("a").cast("binary")).alias("images"))
    kept = detection.without_detections_anti(rows, "id")
    assert sorted(r.id for r in kept.collect()) == [i for i in range(50) if i % 3]
    assert "hashpartitioning" not in plan_of(kept)


@pytest.mark.parametrize("dedup", [similarity.dedup_pairs, similarity.dedup_pairs_ranked])
def test_pairs_are_scored_and_deduplicated_without_texts(spark, folder, monkeypatch, dedup):
    """Texts are given to the pairs that are left, the same as if they had been there."""
    maker = random.Random(3)
    rows = [(i, [maker.uniform(-1, 1) for _ in range(8)]) for i in range(130)]
    spark.createDataFrame(rows, "vec_id bigint, embedding array<float>").write.parquet(f"{folder}/embeddings.parquet")
    texts = [(i, f"text {i}") for i in range(140)]
    spark.createDataFrame(texts, "doc_id bigint, text string").write.parquet(f"{folder}/documents.parquet")
    whole = pairs.dedup_pairs(similarity.overlapping(spark, folder), similarity.ORDER).select(*similarity.OVERLAP_COLUMNS)
    seen = []
    for name in ("dedup_stored", "dedup_pairs_ranked"):
        plain = getattr(pairs, name)
        monkeypatch.setattr(pairs, name, lambda found, order, plain=plain: seen.append(found.columns) or plain(found, order))
    once = dedup(spark, folder)
    assert once.columns == similarity.OVERLAP_COLUMNS
    assert sorted(map(tuple, once.collect())) == sorted(map(tuple, whole.collect()))
    assert seen and not any("sentence" in column for columns in seen for column in columns)


def test_texts_by_block_are_those_of_two_joins(spark):
    """Repeated ids, missing ids and NULL texts too; only texts and pairs without texts are moved."""
    rows = [(0, "a"), (1, None), (2, "c"), (2, "c too"), (11, "x"), (12, ""), (None, "n")]
    sentences = spark.createDataFrame(rows, "idx bigint, text string")
    found = [(0, 1, 0.1), (2, 2, 0.2), (2, 0, 0.2), (2, 0, 0.2), (11, 12, None), (11, 13, 0.3), (None, 1, 0.4), (1, None, 0.5)]
    drawn = spark.createDataFrame(found, "idx1 bigint, idx2 bigint, similarity double")
    by_block, joined = pairs.with_block_texts(drawn, sentences, 10, 2), pairs.with_texts(drawn, sentences)
    assert by_block.columns == ["idx1", "idx2", "similarity", "sentence1", "sentence2"]
    key = lambda r: repr((r.idx1, r.idx2, r.similarity, r.sentence1, r.sentence2))
    assert sorted(map(key, by_block.collect())) == sorted(map(key, joined.collect())) and by_block.count() == 10
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert plan_of(pairs.with_block_texts(drawn, sentences, 10, 2)).count("Exchange hashpartitioning") == 2
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    with pytest.raises(Exception, match="two blocks"):
        pairs.with_block_texts(spark.createDataFrame([(2, 11, 0.1)], drawn.schema), sentences, 10, 2).collect()


@pytest.mark.parametrize("buckets", [8192, 3, 1])
def test_chosen_numbers(spark, buckets):
    rows = spark.range(0, 400_000, 7).select("id", F.lit("payload").alias("images")).union(spark.createDataFrame([(None, "x")], "id bigint, images string"))
    chosen = spark.createDataFrame([(7,), (14,), (32_767 * 7,), (399_994,), (5,), (None,)], "n bigint")
    assert sorted(r.id for r in detection.only_chosen(rows, chosen, "id", buckets).collect()) == [7, 14, 229369, 399994]
    assert detection.only_chosen(rows, chosen.filter("false"), "id", buckets).count() == 0


def test_consolidation_moves_no_text(spark, folder, monkeypatch):
    """What goes into the CSV lies where it was read; copies of a pair in several batches, ties and NULLs."""
    maker = random.Random(5)
    rows = [(maker.choice([None, *range(6)]), maker.randrange(6), f"s {n}\n", f"t {n}", maker.choice([None, 0.5, float("nan")]), maker.randrange(4)) for n in range(200)]
    made = spark.createDataFrame(rows, "idx1 bigint, idx2 bigint, sentence1 string, sentence2 string, similarity double, batch_id bigint")
    writers.write_batches(made, f"{folder}/b", size=10)
    given, plain = [], writers.write_csv
    monkeypatch.setattr(writers, "write_csv", lambda df, *rest: given.append(plan_of(df)) or plain(df, *rest))
    stats = jobs.consolidate(spark, f"{folder}/b", f"{folder}/csv").first()
    assert "hashpartitioning" not in given[0]
    loaded = readers.read_batches(spark, f"{folder}/b", SCORED_PAIRS)
    once = pairs.dedup_pairs(loaded, ["batch_no", "idx1", "idx2", "similarity"]).collect()
    written = spark.read.options(**writers.CSV_READ_OPTIONS).schema(SCORED_PAIRS).csv(f"{folder}/csv").collect()
    key = lambda r: repr((r.idx1, r.idx2, r.similarity))
    assert sorted(map(key, written)) == sorted(map(key, once)) and stats.final_pairs == len(once)
    own = sum(r[0] == r[1] for r in rows)
    assert (stats.initial_pairs, stats.self_pairs_removed, stats.files_skipped) == (200, own, 0)


def test_batches_are_scored_without_texts(spark, folder, monkeypatch):
    maker = random.Random(3)
    rows = [(i, [maker.uniform(-1, 1) for _ in range(8)]) for i in range(130)]
    spark.createDataFrame(rows, "vec_id bigint, embedding array<float>").write.parquet(f"{folder}/embeddings.parquet")
    texts = [(i, f"text {i}") for i in range(140)]
    spark.createDataFrame(texts, "doc_id bigint, text string").write.parquet(f"{folder}/documents.parquet")
    whole = similarity.overlapping(spark, folder).select(*similarity.OVERLAP_COLUMNS)
    scored, seen = pairs.score_pairs, []
    monkeypatch.setattr(pairs, "score_pairs", lambda *given: seen.append(scored(*given)) or seen[-1])
    for query in (similarity.read_batches, similarity.union_batches, similarity.order_batches):
        found = query(spark, folder).select(*similarity.OVERLAP_COLUMNS)
        assert sorted(map(tuple, found.collect())) == sorted(map(tuple, whole.collect()))
    assert len(seen) == 4 and not any("sentence" in column for one in seen for column in one.columns)


def test_lines_in_a_given_number_of_files_without_a_shuffle(spark, folder):
    lines = spark.range(0, 1000, 1, 7).select(F.concat(F.lit("line "), F.col("id").cast("string")).alias("value"))
    writers.write_lines(lines, f"{folder}/lines", 4)
    assert writers.output_size(spark, f"{folder}/lines").first().files == 4
    read = spark.read.text(f"{folder}/lines").groupBy(F.col("_metadata.file_name")).agg(F.count(F.lit(1)).alias("n"))
    assert sum(r.n for r in read.collect()) == 1000 and all(240 < r.n < 260 for r in read.collect())
    assert sorted(r.value for r in spark.read.text(f"{folder}/lines").collect()) == sorted(r.value for r in lines.collect())
    writers.write_lines(lines.limit(0), f"{folder}/none", 4)
    assert spark.read.text(f"{folder}/none").count() == 0
