"""Sampled sentence pairs, their similarity, and unordered-pair clean-up."""

from __future__ import annotations

import uuid
from decimal import Decimal

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lexiloom.functions.names import batch_id
from lexiloom.functions.vectors import batch_cosine, block_cosines

# Sampling defaults.
BLOCK_SIZE = 1000
REPEATS = 1
PARTNERS = 10
SEED = 42
# Pairs a task forms at most on average: with two texts of some kilobytes each,
# what it sorts by batch stays in memory.
TASK_PAIRS = 20_000


def _draw(seed: int, repeat: int, step: int) -> Column:
    """A 60-bit number that depends on the row, the repeat and the step alone."""
    text = F.concat_ws("|", F.lit(seed), F.lit(repeat), "idx", F.lit(step))
    return F.conv(F.substring(F.md5(text), 1, 15), 16, 10).cast("bigint")


def _draws(partners: int, repeats: int, seed: int) -> Column:
    """The draws of a row, by repeat; written out one by one, so that they are compiled."""
    return F.array(*[F.array(*[_draw(seed, r, s) for s in range(partners)]) for r in range(repeats)])


def _places(draws: Column, others: Column, own: Column, partners: int) -> Column:
    """Places in a block of that many different other rows than the one at ``own``.

    Floyd's sampling without replacement: ``partners`` draws, whatever the
    block size. With fewer others in the block, all of them.
    """
    nobody = F.array().cast("array<bigint>")

    def add(chosen: Column, step: Column) -> Column:
        top = others - partners + step
        drawn = F.pmod(F.get(draws, step), top + 1)
        return F.concat(
            chosen, F.array(F.when(F.array_contains(chosen, drawn), top).otherwise(drawn))
        )

    few = F.when(others > 0, F.sequence(F.lit(0).cast("bigint"), others - 1)).otherwise(nobody)
    many = F.aggregate(F.sequence(F.lit(0), F.lit(partners - 1)), nobody, add)
    # Drawn numbers count the other rows only, so step over the row itself.
    return F.transform(
        F.when(others <= partners, few).otherwise(many), lambda p: p + F.when(p >= own, 1).otherwise(0)
    )


def sample_partners(
    sentences: DataFrame,
    block_size: int = BLOCK_SIZE,
    partners: int = PARTNERS,
    repeats: int = REPEATS,
    seed: int = SEED,
) -> DataFrame:
    """(idx1, rep, partners): the sampled partners of each row, in draw order.

    No shuffle. ``idx`` must run from 0 without gaps, anything else is an error:
    ``similar_pairs`` takes tables with gaps. The lists go into the generator
    as an expression: from a named column Spark would infer a filter and
    sample again for it.
    """
    # The row count is a scalar subquery over the one column: no join.
    count, end = F.count(F.lit(1)), F.coalesce(F.max("idx") + 1, F.lit(0))
    gaps = F.raise_error(F.lit("idx does not run from 0 without gaps")).cast("bigint")
    total = sentences.agg(F.when(count == end, count).otherwise(gaps)).scalar()
    start = batch_id(F.col("idx"), block_size) * block_size
    placed = sentences.select(
        "*",
        start.alias("_start"),
        (F.least(F.lit(block_size).cast("bigint"), total - start) - 1).alias("_others"),
        _draws(partners, repeats, seed).alias("_draws"),
    )
    own = F.col("idx") - F.col("_start")

    def listed(draws: Column) -> Column:
        places = _places(draws, F.col("_others"), own, partners)
        return F.transform(places, lambda p: F.col("_start") + p)

    return placed.select(
        F.col("idx").alias("idx1"), F.posexplode(F.transform("_draws", listed)).alias("rep", "partners")
    )


def sample_pairs(sentences: DataFrame, **options: int) -> DataFrame:
    """(idx1, idx2, rep, rank), as drawn: mirrored pairs are still in it."""
    return (
        sample_partners(sentences, **options)
        .select("idx1", "rep", F.posexplode("partners").alias("rank", "idx2"))
        .select("idx1", "idx2", "rep", "rank")
    )


def _both_ends(pairs: DataFrame, sentences: DataFrame, names: dict[str, str]) -> DataFrame:
    """Adds ``names`` (column of ``sentences`` to name, less its 1 or 2) by two equi-joins."""
    found = pairs
    for end in ("1", "2"):
        side = [F.col(column).alias(name + end) for column, name in names.items()]
        found = found.join(sentences.select(F.col("idx").alias(f"idx{end}"), *side), f"idx{end}")
    return found


def with_texts(pairs: DataFrame, sentences: DataFrame) -> DataFrame:
    """Any list of pairs with both texts: for pairs scored without them, once few are left."""
    return _both_ends(pairs, sentences, {"text": "sentence"})


def with_block_texts(pairs: DataFrame, sentences: DataFrame, block_size: int, each: int) -> DataFrame:
    """As ``with_texts``, for pairs whose two rows lie in one block; another pair is an error.

    A text is shuffled once, not with each of its pairs: a block's pairs meet all its
    texts, and come out of one task. There are as many tasks as keep the pairs of one
    within ``TASK_PAIRS``, where a row makes about ``each``.
    """
    tasks = tasks_for(sentences, each)
    block = batch_id(F.col("idx"), block_size).alias("_block")
    texts = (
        sentences.select(block, "idx", F.struct("text").alias("_text"))
        .repartition(tasks, "_block")
        .groupBy("_block", "idx")
        .agg(F.collect_list("_text").alias("_texts"))
        .groupBy("_block")
        .agg(F.map_from_entries(F.collect_list(F.struct("idx", "_texts"))).alias("_texts"))
    )
    first, second = (batch_id(F.col(end), block_size) for end in ("idx1", "idx2"))
    apart = F.raise_error(F.lit("a pair lies in two blocks")).cast("bigint")
    placed = pairs.filter("idx1 IS NOT NULL AND idx2 IS NOT NULL").withColumn("_block", F.when(first == second, first).otherwise(apart))
    found = placed.repartition(tasks, "_block").join(texts, "_block")
    for end in ("1", "2"):
        found = found.withColumn(f"_text{end}", F.explode(F.try_element_at("_texts", F.col(f"idx{end}"))))
    named = [F.col(f"_text{end}.text").alias(f"sentence{end}") for end in ("1", "2")]
    return found.select(*[F.col(f"`{c}`") for c in pairs.columns], *named)


def score_pairs(pairs: DataFrame, sentences: DataFrame, texts: bool = True) -> DataFrame:
    """Texts and cosine for any list of pairs: two equi-joins on the row id.

    Without ``texts`` the cosine alone; ``with_texts`` adds them later.
    """
    names = {"text": "sentence", "embedding": "_v"} if texts else {"embedding": "_v"}
    scored = _both_ends(pairs, sentences, names)
    return scored.withColumn("similarity", F.round(batch_cosine(F.col("_v1"), F.col("_v2")), 6)).drop("_v1", "_v2")


def store_vectors(sentences: DataFrame, path: str, buckets: int = 64) -> str:
    """Writes (idx, text, embedding) as a table in sorted buckets of ``idx``; its name.

    Joins on ``idx`` then take its rows as they lie. ``buckets`` is for the table:
    as many as make files of a few hundred megabytes.
    """
    name = f"sentences_{uuid.uuid4().hex}"
    writer = sentences.select("idx", "text", "embedding").repartition(buckets, "idx").write
    writer.bucketBy(buckets, "idx").sortBy("idx").option("path", path).saveAsTable(name)
    return name


def score_stored(pairs: DataFrame, table: str) -> DataFrame:
    """Texts and cosine for any list of pairs from a table of ``store_vectors``.

    Only the pairs are shuffled: with a vector on the way to its partner, then, the
    vectors gone, with one text on the way to the other one.
    """
    stored = pairs.sparkSession.table(table)

    def side(n: int, column: str, name: str) -> DataFrame:
        return stored.select(F.col("idx").alias(f"idx{n}"), F.col(column).alias(name))

    scored = (
        pairs.join(side(1, "embedding", "_v1"), "idx1")
        .join(side(2, "embedding", "_v2"), "idx2")
        .withColumn("similarity", F.round(batch_cosine(F.col("_v1"), F.col("_v2")), 6))
        .drop("_v1", "_v2")
    )
    return scored.join(side(2, "text", "sentence2"), "idx2").join(side(1, "text", "sentence1"), "idx1")


def tasks_for(rows: DataFrame, each: int) -> int:
    """How many tasks are to form ``each`` pairs of every row, two at least."""
    return max(2, -(-rows.count() * each // TASK_PAIRS))


def similar_pairs(
    sentences: DataFrame,
    block_size: int = BLOCK_SIZE,
    partners: int = PARTNERS,
    repeats: int = REPEATS,
    seed: int = SEED,
    together: int = 1,
) -> DataFrame:
    """Sampled, scored and deduplicated pairs with a single shuffle.

    Partners never leave their block, so each block (at most ``block_size``
    rows) becomes one row and its pairs are formed inside it. A mirrored pair
    is recognised there too: when both rows drew each other, the lower id's
    draw is the first seen and the other one is left out. ``together``
    neighbouring blocks come out of the same task, and there are as many tasks as
    keep the pairs of one within ``TASK_PAIRS``: they hold each text many times
    over, which the size of the shuffled blocks does not tell. Partners are places in the
    sorted block, so ``idx`` may have gaps. A NULL vector gives a NULL score.
    """
    members = sentences.select(
        batch_id(F.col("idx"), block_size).alias("batch_id"),
        F.struct("idx", "text", "embedding", _draws(partners, repeats, seed).alias("draws")).alias("member"),
    )
    keys = ["batch_id"]
    if together > 1:
        # The aggregate below finds its keys together already and adds no shuffle.
        tasks = tasks_for(sentences, min(partners * repeats, block_size - 1))
        members = members.withColumn("_group", batch_id(F.col("batch_id"), together)).repartition(tasks, "_group")
        keys = ["_group", "batch_id"]
    blocks = members.groupBy(*keys).agg(F.sort_array(F.collect_list("member")).alias("block"))
    block, others = F.col("block"), (F.size("block") - 1).cast("bigint")

    def drawn(a: Column, at: Column) -> Column:
        """Places of the partners of ``a``, over all repeats."""
        places = F.transform(a["draws"], lambda d: _places(d, others, at.cast("bigint"), partners))
        return F.transform(F.array_distinct(F.flatten(places)), lambda p: p.cast("int"))

    def wanted(places: Column, at: Column) -> Column:
        """Those of them whose pair with the row at ``at`` is kept."""
        return F.filter(places, lambda p: (at < p) | ~F.array_contains(F.get("drawn", p), at))

    planned = blocks.withColumn("drawn", F.transform(block, drawn)).withColumn(
        "wanted", F.transform("drawn", wanted)
    )
    scored = planned.withColumn(
        "scores", block_cosines(F.transform("block", lambda m: m["embedding"]), F.col("wanted"))
    )

    def pairs_of(a: Column, at: Column) -> Column:
        return F.zip_with(
            F.get("wanted", at),
            F.get("scores", at),
            lambda p, score: F.struct(
                a["idx"].alias("idx1"),
                F.get(block, p)["idx"].alias("idx2"),
                a["text"].alias("sentence1"),
                F.get(block, p)["text"].alias("sentence2"),
                F.round(score, 6).alias("similarity"),
            ),
        )

    return scored.select("batch_id", F.inline(F.flatten(F.transform("block", pairs_of))))


def drop_self_pairs(pairs: DataFrame) -> DataFrame:
    return pairs.filter(F.col("idx1") != F.col("idx2"))


def _pair_key() -> list[Column]:
    return [F.least("idx1", "idx2").alias("_low"), F.greatest("idx1", "idx2").alias("_high")]


def dedup_pairs(pairs: DataFrame, order: list[str]) -> DataFrame:
    """One row per unordered pair, the first by ``order``; self-pairs go.

    An aggregate, so copies of a hot pair are reduced before the shuffle.
    """
    first = F.min_by(F.struct(*[F.col(c) for c in pairs.columns]), F.struct(*order))
    return (
        drop_self_pairs(pairs)
        .groupBy(*_pair_key())
        .agg(first.alias("_first"))
        .select("_first.*")
    )


def first_numbers(pairs: DataFrame, order: list[str], number: str) -> DataFrame:
    """(``number``): which rows ``dedup_pairs`` keeps, by a column that tells rows apart.

    Of rows alike in ``order`` it is the lowest number. Texts are not looked at.
    """
    first = F.min(F.struct(*order, number)).alias("_first")
    return drop_self_pairs(pairs).groupBy(*_pair_key()).agg(first).select(F.col(f"_first.{number}"))


def packed_order(order: list[tuple[Column, int]]) -> Column:
    """One number that orders rows as the columns do one after another.

    Each column comes with the bits its values need: whole numbers from 0, no more
    than 126 bits together. NULL comes first, as 0.
    """
    if sum(bits for _, bits in order) > 126:
        raise ValueError("the columns need more than 126 bits")
    total, shift = F.lit(Decimal(0)).cast("decimal(38,0)"), 0
    for column, bits in reversed(order):
        value = F.coalesce(column.cast("decimal(38,0)"), F.lit(Decimal(0)))
        fits = F.when((value >= 0) & (value < F.lit(Decimal(2**bits))), value).otherwise(
            F.raise_error(F.lit(f"a value of the order needs more than {bits} bits")).cast("decimal(38,0)")
        )
        total = (total + (fits * F.lit(Decimal(2**shift))).cast("decimal(38,0)")).cast("decimal(38,0)")
        shift += bits
    return total


def dedup_stored(pairs: DataFrame, order: list[tuple[Column, int]]) -> DataFrame:
    """As ``dedup_pairs``, of a written table: texts are fetched for the winners only.

    The first pass reads ids and ``order`` (see ``packed_order``; the pair's own
    direction can be told by ``F.col("idx1") > F.col("idx2")``) and reduces them to
    one number per pair, which hash aggregation can hold. Rows that agree in all of
    it are told apart by 30 bits of a hash of their place in the files. The second
    pass joins by that number as well, so the copies of a hot pair do not meet.
    """
    tie = F.xxhash64(F.col("_metadata.file_path"), F.col("_metadata.row_index")).bitwiseAND(F.lit(2**30 - 1))
    key = packed_order([*order, (tie, 30)]).alias("_key")
    stored = drop_self_pairs(pairs)
    first = stored.select(*_pair_key(), key).groupBy("_low", "_high").agg(F.min("_key").alias("_key"))
    return stored.select("*", *_pair_key(), key).join(first, ["_low", "_high", "_key"]).drop("_low", "_high", "_key")


def dedup_pairs_ranked(pairs: DataFrame, order: list[str]) -> DataFrame:
    """As ``dedup_pairs`` through a rank; Spark trims groups before the shuffle."""
    keyed = drop_self_pairs(pairs).select("*", *_pair_key())
    rank = F.row_number().over(Window.partitionBy("_low", "_high").orderBy(*order))
    return keyed.withColumn("_rank", rank).filter("_rank = 1").drop("_rank", "_low", "_high")


def pair_dedup_stats(pairs: DataFrame) -> DataFrame:
    """Pairs before, self-pairs removed, mirrored copies removed, pairs left."""
    per_pair = pairs.groupBy(*_pair_key()).agg(F.count(F.lit(1)).alias("n"))
    is_self = F.col("_low") == F.col("_high")
    total = F.coalesce(F.sum("n"), F.lit(0))
    own = F.coalesce(F.sum(F.when(is_self, F.col("n"))), F.lit(0))
    left = F.count_if(~is_self)
    return per_pair.agg(
        total.cast("bigint").alias("initial_pairs"),
        own.cast("bigint").alias("self_pairs_removed"),
        (total - own - left).cast("bigint").alias("duplicates_removed"),
        left.cast("bigint").alias("final_pairs"),
    )


def pairs_per_batch(pairs: DataFrame) -> DataFrame:
    return pairs.groupBy("batch_id").agg(F.count(F.lit(1)).alias("pairs"))
