import hashlib
import math
import random
import re

import pytest
from pyspark.sql import functions as F

from lexiloom.functions.vectors import batch_cosine, cosine
from lexiloom.functions import names
from lexiloom.operators import pairs
from lexiloom.plans import jobs
from tests.conftest import plan_of


@pytest.fixture(scope="module")
def sentences(spark):
    maker = random.Random(7)
    rows = [(i, f"text {i}", [maker.uniform(-1, 1) for _ in range(8)]) for i in range(57)]
    return spark.createDataFrame(rows, "idx bigint, text string, embedding array<float>")


def expected_partners(idx, total, block, k, repeat, seed):
    """The sampling rule again, in plain Python."""
    start = idx // block * block
    others = min(block, total - start) - 1
    if others <= k:
        places = list(range(others))
    else:
        places = []
        for step in range(k):
            top = others - k + step
            digest = hashlib.md5(f"{seed}|{repeat}|{idx}|{step}".encode()).hexdigest()
            drawn = int(digest[:15], 16) % (top + 1)
            places.append(top if drawn in places else drawn)
    return [start + p + (p >= idx - start) for p in places]


@pytest.mark.parametrize("block, k, repeats, seed", [(20, 5, 2, 42), (10, 9, 1, 1), (8, 10, 1, 3), (28, 3, 1, 9)])
def test_samples(sentences, block, k, repeats, seed):
    rows = pairs.sample_partners(
        sentences, block_size=block, partners=k, repeats=repeats, seed=seed
    ).collect()
    assert len(rows) == 57 * repeats
    for r in rows:
        start = r.idx1 // block * block
        others = min(block, 57 - start) - 1
        assert len(set(r.partners)) == len(r.partners) == min(k, others)
        assert r.idx1 not in r.partners
        assert all(start <= p < min(start + block, 57) for p in r.partners)
        assert r.partners == expected_partners(r.idx1, 57, block, k, r.rep, seed)


def test_a_lone_last_row_has_no_partner(sentences):
    rows = pairs.sample_pairs(sentences, block_size=8, partners=3).filter("idx1 >= 56").collect()
    assert rows == []


def test_draws_are_spread_evenly(spark):
    many = spark.range(2000).select(F.col("id").alias("idx"))
    counts = (
        pairs.sample_pairs(many, block_size=2000, partners=10)
        .groupBy((F.col("idx2") / 200).cast("int").alias("bin"))
        .count()
        .collect()
    )
    assert len(counts) == 10
    assert all(1700 < r["count"] < 2300 for r in counts)


@pytest.mark.parametrize("repeats", [1, 3])
def test_block_form_equals_join_form(sentences, repeats):
    options = {"block_size": 20, "partners": 6, "repeats": repeats}
    drawn = pairs.sample_pairs(sentences, **options)
    joined = pairs.dedup_pairs(pairs.score_pairs(drawn, sentences), ["idx1", "rep", "rank"])
    columns = ["idx1", "idx2", "sentence1", "sentence2", "similarity"]
    block = pairs.similar_pairs(sentences, **options)
    assert sorted(map(tuple, block.select(columns).collect())) == sorted(
        map(tuple, joined.select(columns).collect())
    )
    assert block.filter(F.col("batch_id") != F.expr("idx1 div 20")).count() == 0


def test_blocks_worked_on_together_give_the_same_pairs(sentences):
    apart, together = (
        pairs.similar_pairs(sentences, block_size=8, partners=3, together=n) for n in (1, 3)
    )
    assert sorted(map(tuple, apart.collect())) == sorted(map(tuple, together.collect()))


def test_a_folder_is_one_file(spark, sentences, folder):
    jobs.sentence_similarity(sentences, f"{folder}/s", blocks_per_folder=2, block_size=8, partners=3)
    files = spark.read.parquet(f"{folder}/s").select("batch", F.col("_metadata.file_path").alias("f"))
    counts = files.distinct().groupBy("batch").count().collect()
    assert {r["batch"]: r["count"] for r in counts} == {
        f"batch_{at}_{at + 16}": 1 for at in (0, 16, 32, 48)
    }


def test_cosine_forms_agree_and_zero_vectors_give_null(spark):
    df = spark.createDataFrame(
        [([1.0, 0.0], [0.0, 1.0]), ([1.0, 2.0], [-1.0, -2.0]), ([3.0, 4.0], [3.0, 4.0]), ([0.0, 0.0], [1.0, 1.0])],
        "a array<float>, b array<float>",
    )
    rows = df.select(
        cosine(F.col("a"), F.col("b")).alias("native"),
        batch_cosine(F.col("a"), F.col("b")).alias("batch"),
    ).collect()
    for r, expected in zip(rows, [0.0, -1.0, 1.0, None]):
        for got in r:
            assert got is None if expected is None else math.isclose(got, expected, abs_tol=1e-12)


COPIES = [(1, 2, 0.5, 0), (2, 1, 0.5, 1), (3, 3, 1.0, 2), (5, 4, 0.1, 3), (4, 5, 0.1, 4), (1, 2, 0.5, 5), (7, 6, 0.2, 6)]


@pytest.fixture
def copies(spark):
    return spark.createDataFrame(COPIES, "idx1 bigint, idx2 bigint, similarity double, seq int")


@pytest.mark.parametrize("dedup", [pairs.dedup_pairs, pairs.dedup_pairs_ranked])
def test_first_seen_orientation_is_kept(copies, dedup):
    once = dedup(copies, ["seq"])
    assert sorted((r.idx1, r.idx2, r.seq) for r in once.collect()) == [(1, 2, 0), (5, 4, 3), (7, 6, 6)]
    assert sorted(map(tuple, dedup(once, ["seq"]).collect())) == sorted(map(tuple, once.collect()))


def test_stats(copies):
    assert tuple(pairs.pair_dedup_stats(copies).first()) == (7, 1, 3, 3)
    assert tuple(pairs.pair_dedup_stats(copies.filter("false")).first()) == (0, 0, 0, 0)


def test_batch_names(value):
    name = names.batch_name(F.lit(1000), F.lit(2000))
    assert value(name) == "batch_1000_2000"
    assert value(names.batch_number(name)) == 1000
    assert value(names.batch_number(F.lit("pairs.parquet"))) == 0
    assert value(names.batch_id(F.lit(2**60 + 1), 1000)) == (2**60 + 1) // 1000


def test_job_then_consolidation(spark, sentences, folder):
    first = jobs.sentence_similarity(sentences, f"{folder}/b", block_size=20, partners=6).count()
    again = jobs.sentence_similarity(sentences, f"{folder}/b", block_size=20, partners=6)
    assert first == again.count() > 0
    stats = jobs.consolidate(spark, f"{folder}/b", f"{folder}/csv").first()
    assert stats.self_pairs_removed == stats.duplicates_removed == 0
    assert stats.initial_pairs == stats.final_pairs == again.count()


def test_tasks_are_counted_by_the_pairs_they_form(spark, monkeypatch):
    """Blocks are small on their way, their pairs are not."""
    rows = [(i, f"text {i}", [float(i % 7 + 1), 1.0]) for i in range(100)]
    sentences = spark.createDataFrame(rows, "idx bigint, text string, embedding array<float>")
    monkeypatch.setattr(pairs, "TASK_PAIRS", 50)
    plan = plan_of(pairs.similar_pairs(sentences, block_size=10, partners=4, together=1 + 1))
    assert re.search(r"hashpartitioning\(_group#\d+L?, 8\)", plan)
    assert pairs.similar_pairs(sentences.limit(0), block_size=10, together=2).count() == 0
