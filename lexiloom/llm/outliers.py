"""Robust multivariate outliers by minimum-covariance-determinant estimates.

Documents of one language and source form a pool, pools under ``LEAST_ROWS`` join
the rest of their language, and too small rests join each other; where even those
are too few, they are held against the estimate of the whole table. A pool's estimate
starts from medians and quartiles; each concentration step takes the three quarters
of its rows nearest by Mahalanobis distance and re-estimates mean and covariance
from those, which never raises the determinant. All steps run over all rows of the small table of statistics: sums
are folded before the shuffle, so a pool may hold any share of the rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexiloom.llm.statistics import count_documents
from lexiloom.session import stage

LEAST_ROWS = 200
# The pool of all rows.
WHOLE = "table"
CORE = 0.75
STEPS = 4
# Share of regular documents kept, were the statistics normally distributed.
KEEP = 0.999
# Base rules.
LEAST_WORDS = 20
MOST_REPEATED = 30


def per(part: str, whole: str, scale: float) -> Column:
    return F.log1p(F.lit(scale) * F.col(part) / F.greatest(F.col(whole), F.lit(1)))


def statistics() -> list[tuple[Column, float]]:
    """Transformed statistics, with the least standard deviation that counts: most
    are zero in most documents, and a stray character must not make an outlier."""
    words = F.greatest(F.col("n_words"), F.lit(1))
    letters = F.greatest(F.col("n_upper") + F.col("n_lower") + F.col("n_other"), F.lit(1))
    return [
        (F.log1p(F.col("n_words")), 0.5),
        (F.log1p(F.col("word_chars") / words), 0.1),
        (per("n_symbols", "n_words", 10.0), 0.25),
        (per("n_dup_lines", "n_lines", 10.0), 0.4),
        (per("n_repeat_words", "n_words", 10.0), 0.4),
        (F.log1p(F.lit(10.0) * F.col("n_upper") / letters), 0.2),
        (per("n_marks", "n_words", 10.0), 0.3),
    ]


def chi2_cdf(x: np.ndarray, degrees: int) -> np.ndarray:
    """Of the squared distance of normal vectors; by the trapezoid rule."""
    grid = np.linspace(0, 200, 400_001)
    density = np.exp((degrees / 2 - 1) * np.log(np.maximum(grid, 1e-12)) - grid / 2)
    total = np.concatenate([[0.0], np.cumsum((density[1:] + density[:-1]) / 2)])
    return np.interp(x, grid, total / total[-1])


def chi2_quantile(share: float, degrees: int) -> float:
    grid = np.linspace(0, 200, 400_001)
    return float(np.interp(share, chi2_cdf(grid, degrees), grid))


def _names(n: int) -> list[str]:
    return [f"f{i}" for i in range(n)]


def _pairs(n: int) -> list[tuple[int, int]]:
    return [(i, j) for i in range(n) for j in range(i, n)]


def _distance(n: int) -> Column:
    """Squared Mahalanobis distance from columns f*, m* and p*_*."""
    off = [F.col(f"f{i}") - F.col(f"m{i}") for i in range(n)]
    terms = [off[i] * off[j] * F.col(f"p{i}_{j}") * (1.0 if i == j else 2.0) for i, j in _pairs(n)]
    return sum(terms[1:], terms[0])


def _invert(n: int, least: list[float], factor: float):
    """Sums of each pool to its mean and precision."""

    def invert(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = batch.num_rows
            count = batch.column("n").to_numpy().astype(float)
            mean = np.stack([batch.column(f"s{i}").to_numpy() / count for i in range(n)], axis=1)
            cov = np.zeros((rows, n, n))
            for i, j in _pairs(n):
                cov[:, i, j] = cov[:, j, i] = batch.column(f"q{i}_{j}").to_numpy() / count - mean[:, i] * mean[:, j]
            # In units of the least deviations no direction has a variance under 1.
            units = np.array(least)
            values, axes = np.linalg.eigh(cov * factor / np.outer(units, units))
            precision = (axes / np.maximum(values, 1)[:, None, :]) @ axes.transpose(0, 2, 1) / np.outer(units, units)
            columns = {"pool": batch.column("pool")}
            columns |= {f"m{i}": pa.array(mean[:, i]) for i in range(n)}
            columns |= {f"p{i}_{j}": pa.array(precision[:, i, j]) for i, j in _pairs(n)}
            yield pa.RecordBatch.from_arrays(list(columns.values()), names=list(columns))

    return invert


def fit(rows: DataFrame, least: list[float], core: float = CORE, steps: int = STEPS) -> DataFrame:
    """(pool, m*, p*_*) of each pool of ``rows`` (pool, f*), one row per pool."""
    n = len(least)
    quartiles = rows.groupBy("pool").agg(
        *(F.percentile_approx(f, F.array(F.lit(0.25), F.lit(0.5), F.lit(0.75))).alias(f) for f in _names(n))
    )
    scale = [F.greatest((F.col(f"f{i}")[2] - F.col(f"f{i}")[0]) / 1.349, F.lit(least[i])) for i in range(n)]
    params = quartiles.select(
        "pool",
        *(F.col(f"f{i}")[1].alias(f"m{i}") for i in range(n)),
        *((1 / (scale[i] * scale[i]) if i == j else F.lit(0.0)).alias(f"p{i}_{j}") for i, j in _pairs(n)),
    )
    # The covariance of the nearest share of a normal sample is this much too small.
    edge = chi2_quantile(core, n)
    factor = core / float(chi2_cdf(np.array(edge), n + 2))
    shape = ", ".join(["pool string", *(f"m{i} double" for i in range(n)), *(f"p{i}_{j} double" for i, j in _pairs(n))])
    for _ in range(steps):
        params = stage(params, "mcd")
        near = rows.join(params, "pool").withColumn("d", _distance(n)).select("pool", "d", *_names(n))
        edges = stage(near.groupBy("pool").agg(F.percentile_approx("d", core, 10_000).alias("edge")), "mcd-edge")
        sums = (
            near.join(edges, "pool")
            .filter("d <= edge")
            .groupBy("pool")
            .agg(
                F.count(F.lit(1)).alias("n"),
                *(F.sum(f"f{i}").alias(f"s{i}") for i in range(n)),
                *(F.sum(F.col(f"f{i}") * F.col(f"f{j}")).alias(f"q{i}_{j}") for i, j in _pairs(n)),
            )
        )
        params = sums.mapInArrow(_invert(n, least, factor), shape)
    return stage(params, "mcd")


def pools(rows: DataFrame, least_rows: int) -> DataFrame:
    """(group, pool): every (lang, source) group of ``rows`` and the pool it is in.
    Groups without a pool of ``least_rows`` rows have the pool ``WHOLE``, and are
    left out where not even the whole table has so many."""
    counts = rows.groupBy("group", "lang_key").agg(F.count(F.lit(1)).alias("n"))
    small = counts.filter(F.col("n") < least_rows)
    rest = small.groupBy("lang_key").agg(F.sum("n").alias("m"))
    joined = small.join(rest, "lang_key")
    own = counts.filter(F.col("n") >= least_rows).select("group", F.concat(F.lit("group "), "group").alias("pool"))
    by_lang = joined.filter(F.col("m") >= least_rows).select("group", F.concat(F.lit("language "), "lang_key").alias("pool"))
    last = joined.filter(F.col("m") < least_rows)
    sums = last.agg(F.sum("n").alias("left")).join(counts.agg(F.sum("n").alias("all")), F.lit(True))
    pool = F.when(F.col("left") >= least_rows, F.lit("rest")).otherwise(F.lit(WHOLE))
    by_rest = last.join(sums.filter(F.col("all") >= least_rows), F.lit(True)).select("group", pool.alias("pool"))
    return own.unionByName(by_lang).unionByName(by_rest)


def robust_outliers(docs: DataFrame, least_rows: int = LEAST_ROWS, keep: float = KEEP) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text, lang, source): doc_id, n_words,
    word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept, distance
    (squared, null where no estimate was made).

    Estimates are made from rows that pass the base rules. A null text has no
    words and fails them; a null language or source is a value of its own; where
    the whole table has too few rows for an estimate, only the base rules decide;
    repeated rows count as often as they come; no rows give no rows.
    """
    listed = statistics()
    n = len(listed)
    counted = count_documents(
        docs.select(
            "doc_id",
            F.to_json(F.struct("lang", "source")).alias("group"),
            F.to_json(F.struct("lang")).alias("lang_key"),
            "text",
        )
    )
    failed = (F.col("n_words") < LEAST_WORDS) | (100 * F.col("n_repeat_words") > MOST_REPEATED * F.col("n_words"))
    rows = counted.withColumn("base_failed", failed).select(
        "doc_id", "group", "lang_key", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        "base_failed", *(c.cast("double").alias(f"f{i}") for i, (c, _) in enumerate(listed)),
    )
    rows = stage(rows, "statistics")
    regular = rows.filter(~F.col("base_failed"))
    assigned = stage(pools(regular, least_rows), "pools")
    pooled = regular.join(assigned.filter(F.col("pool") != WHOLE), "group").select("pool", *_names(n))
    if not assigned.filter(F.col("pool") == WHOLE).isEmpty():
        pooled = pooled.unionByName(regular.select(F.lit(WHOLE).alias("pool"), *_names(n)))
    params = fit(pooled, [s for _, s in listed])
    of_group = stage(assigned.join(params, "pool"), "group-estimates")
    distance = rows.join(of_group, "group", "left").withColumn("distance", _distance(n))
    near = F.coalesce(F.col("distance") <= chi2_quantile(keep, n), F.lit(True))
    return distance.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed",
        (~F.col("base_failed") & near).alias("kept"), "distance",
    )
