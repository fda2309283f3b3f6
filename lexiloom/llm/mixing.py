"""Mixing sources to target weights.

Rows get hash-random keys; inside a source they are taken in key order until the
source's budget of words is used up, whole epochs first. The order is never
sorted as a whole: keys are cut into ranges by their leading digits, the sums of
the ranges are added up, and only the one range of a source in which the budget
ends is sorted. Built-in functions only.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lexiloom.session import stage

WEIGHTS = (5, 2, 1)
MOST_EPOCHS = 3
SEED = "mix"


def count_words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("bigint")


def source_targets(sizes: DataFrame, weights: tuple[int, ...], most: int) -> DataFrame:
    """(source, source_size) to the same with ``target``, one row per source.

    Sources in code point order, null last, weigh ``weights``, repeating, and
    share all words. A target above ``most`` times its source's size is cut to
    that and the excess shared by weight among the others, until none is above.
    Sources reach their cap in the order of cap over weight, so those that do
    are a prefix of that order and one pass finds them. The two windows see one
    row per source.
    """
    place = F.row_number().over(Window.orderBy(F.asc_nulls_last("source")))
    weight = F.element_at(F.array(*map(F.lit, weights)), ((place - 1) % len(weights) + 1).cast("int"))
    everything = Window.partitionBy()
    by_fill = Window.orderBy(F.col("cap") / F.col("weight"), F.asc_nulls_last("source"))
    before = by_fill.rowsBetween(Window.unboundedPreceding, -1)
    wide = "decimal(19,0)"
    filled = (
        sizes.withColumn("weight", weight.cast("bigint"))
        .withColumn("cap", F.col("source_size") * most)
        .withColumn("all_words", F.sum("source_size").over(everything))
        .withColumn("left_words", F.col("all_words") - F.coalesce(F.sum("cap").over(before), F.lit(0)))
        .withColumn("left_weight", F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(before), F.lit(0)))
        .withColumn(
            "capped",
            F.col("cap").cast(wide) * F.col("left_weight").cast(wide)
            <= F.col("left_words").cast(wide) * F.col("weight").cast(wide),
        )
    )
    free = ~F.col("capped")
    shared = F.max(F.when(free, F.col("left_words"))).over(everything)
    among = F.max(F.when(free, F.col("left_weight"))).over(everything)
    target = F.when(F.col("capped"), F.col("cap").cast("double")).otherwise(
        shared.cast("double") * F.col("weight").cast("double") / among.cast("double")
    )
    return filled.select("source", "source_size", target.alias("target"))


def mix_sources(
    docs: DataFrame,
    weights: tuple[int, ...] = WEIGHTS,
    most: int = MOST_EPOCHS,
    seed: str = SEED,
) -> DataFrame:
    """How many words of each document the mix takes.

    Returns one row per row of ``docs`` (doc_id, text, source): doc_id, source,
    size, source_size, target, taken. ``taken`` sums to each target, rounded, in
    each source; the document at the cut gives the words still missing. A null or
    empty text has size 0 and gives nothing; a null source is a source of its
    own, null ids share one key, repeated rows are taken one by one, and rows
    that agree in key and size are interchangeable. No rows give no rows.
    """
    name = F.coalesce(F.col("doc_id").cast("string"), F.concat(F.lit(":"), F.md5(F.coalesce("text", F.lit("")))))
    key = F.substring(F.md5(F.concat(F.lit(f"{seed}:"), name)), 1, 16)
    sized = stage(docs.select("doc_id", "source", count_words(F.col("text")).alias("size"), key.alias("key")), "mix-sizes")
    # So many leading hex digits of a key name its range: there are about as many
    # ranges as a range has rows, and one task sees either once for a source.
    digits = max(1, math.ceil(math.log(math.sqrt(max(sized.count(), 1)), 16)))
    sized = sized.withColumn("range", F.substring("key", 1, digits))

    ranges = stage(sized.groupBy("source", "range").agg(F.sum("size").alias("words")), "mix-ranges")
    sizes = ranges.groupBy("source").agg(F.sum("words").alias("source_size"))
    budget = F.floor(F.col("target") + 0.5).cast("bigint")
    epochs = F.coalesce(F.expr("try_divide(budget - pmod(budget, source_size), source_size)"), F.lit(0)).cast("bigint")
    sources = (
        source_targets(sizes, weights, most)
        .withColumn("budget", budget)
        .withColumn("epochs", F.when(F.col("source_size") > 0, epochs).otherwise(F.lit(0)).cast("bigint"))
        .withColumn("rest", F.col("budget") - F.col("epochs") * F.col("source_size"))
        .select(F.col("source").alias("of"), "source_size", "target", "epochs", "rest")
    )
    running = ranges.withColumn(
        "end", F.sum("words").over(Window.partitionBy("source").orderBy("range").rowsBetween(Window.unboundedPreceding, 0))
    )
    reached = F.min(
        F.when(F.col("end") >= F.col("rest"), F.struct("range", (F.col("end") - F.col("words")).alias("before")))
    ).alias("cut")
    # One row per source. Read back from a table, so that Spark knows its size
    # and decides by it whether to broadcast it.
    cuts = stage(
        running.join(sources, running["source"].eqNullSafe(sources["of"]))
        .groupBy("of", "source_size", "target", "epochs", "rest")
        .agg(reached),
        "mix-cuts",
    )
    rows = sized.join(cuts, sized["source"].eqNullSafe(cuts["of"])).drop("of")
    base = F.col("epochs") * F.col("size")
    at_cut = F.col("range") == F.col("cut.range")
    whole = rows.filter(~at_cut).withColumn(
        "taken", base + F.when(F.col("range") < F.col("cut.range"), F.col("size")).otherwise(F.lit(0))
    )
    in_range = Window.partitionBy("source", "range").orderBy("key", "size").rowsBetween(Window.unboundedPreceding, 0)
    start = F.col("cut.before") + F.sum("size").over(in_range) - F.col("size")
    part = rows.filter(at_cut).withColumn(
        "taken", base + F.greatest(F.lit(0).cast("bigint"), F.least(F.col("size"), F.col("rest") - start))
    )
    return whole.unionByName(part).select("doc_id", "source", "size", "source_size", "target", "taken")
