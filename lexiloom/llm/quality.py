"""Quality classifier: random Fourier features, ridge regression, isotonic scores.

Cosines of random projections of the document statistics approximate a Gaussian
kernel. Every partition sums its part of the normal equations, the parts are added
up row by row, and only the sum, whose size is fixed, is solved on the driver. Texts
are read once, for their counts; all else works on the small table of counts.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexiloom.llm.calibration import Calibration, calibrate, fold_of
from lexiloom.llm.outliers import per, statistics
from lexiloom.llm.statistics import count_documents
from lexiloom.session import stage

FOLDS = 5
HELD_OUT = 0
CALIBRATION = 4
FEATURES = 256
# Width of the kernel, in standard deviations of the statistics.
WIDTH = 4.0
RIDGE = 1.0
THRESHOLD = 0.3
LOW, HIGH = -0.5, 1.5
SEED = 7


def quality_statistics() -> list:
    """Bounded transforms of the counts: the outlier statistics and three more."""
    return [c for c, _ in statistics()] + [
        per("n_digits", "n_words", 10.0),
        F.log1p("n_lines"),
        F.log1p(F.col("n_words") / F.greatest(F.col("n_lines"), F.lit(1))),
    ]


class Features:
    """sqrt(2 / D) cos(W z + b) of standardised statistics, and a constant."""

    def __init__(self, mean: np.ndarray, spread: np.ndarray, count: int = FEATURES, width: float = WIDTH, seed: int = SEED):
        random = np.random.default_rng(seed)
        self.mean, self.spread = mean, np.where(spread > 1e-9, spread, 1.0)
        self.weights = random.standard_normal((len(mean), count)) / width
        self.phase = random.uniform(0, 2 * np.pi, count)

    def __call__(self, values: np.ndarray) -> np.ndarray:
        z = np.clip((values - self.mean) / self.spread, -8, 8)
        waves = np.sqrt(2 / len(self.phase)) * np.cos(z @ self.weights + self.phase)
        return np.hstack([waves, np.ones((len(values), 1))])


def _matrix(batch: pa.RecordBatch, n: int) -> np.ndarray:
    return np.stack([batch.column(f"f{i}").to_numpy() for i in range(n)], axis=1)


def _normal_equations(features: Features):
    n, size = len(features.mean), len(features.phase) + 1

    def add_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((size, size + 1))
        for batch in batches:
            if batch.num_rows:
                x = features(_matrix(batch, n))
                y = batch.column("label").to_numpy().astype(float)
                total += x.T @ np.column_stack([x, y])
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.arange(size)), pa.array(list(total), pa.list_(pa.float64()))], ["row", "sums"]
        )

    return add_up


# Partitions whose sums are first added up among themselves: one in so many.
BRANCHES = 256


def _add_rows(table: pa.Table) -> pa.Table:
    sums = np.sum(table.column("sums").combine_chunks().flatten().to_numpy().reshape(table.num_rows, -1), axis=0)
    return pa.table({"row": table.column("row")[:1], "sums": pa.array([sums], pa.list_(pa.float64()))})


def solve(train: DataFrame, features: Features, ridge: float = RIDGE) -> np.ndarray:
    """Ridge weights over all rows of ``train`` (f*, label)."""
    shape = "row long, sums array<double>"
    parts = train.mapInArrow(_normal_equations(features), shape).withColumn("branch", F.pmod(F.spark_partition_id(), F.lit(BRANCHES)))
    # Folded twice, so that no group has a row from every partition.
    branches = parts.groupBy("row", "branch").applyInArrow(_add_rows, shape)
    rows = branches.groupBy("row").applyInArrow(_add_rows, shape).orderBy("row").collect()
    size = len(features.phase) + 1
    if not rows:
        return np.zeros(size)
    system = np.array([r["sums"] for r in rows])
    penalty = ridge * np.eye(size)
    penalty[-1, -1] = 1e-9  # the constant is not held down
    return np.linalg.solve(system[:, :size] + penalty, system[:, size])


def _raw(features: Features, weights: np.ndarray, scores: Calibration | None = None):
    n, name = len(features.mean), "score" if scores else "raw"

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            raw = features(_matrix(batch, n)) @ weights if batch.num_rows else np.zeros(0)
            kept = [c for c in batch.schema.names if not c.startswith("f")]
            arrays = [batch.column(c) for c in kept]
            yield pa.RecordBatch.from_arrays([*arrays, pa.array(scores(raw) if scores else raw)], [*kept, name])

    return score


def score_quality(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text): doc_id, held_out, score, predicted.

    Learns from rows of ``labels`` (doc_id, quality) with a label whose fold is not
    ``HELD_OUT``; fold ``CALIBRATION`` sets the scores, the others the weights. A
    null text counts as empty and is scored like one; a null id is in no fold, so
    it is scored and not learned from; a row labelled twice counts twice; without
    any label the score is one half. No rows give no rows.
    """
    listed = quality_statistics()
    n = len(listed)
    counted = count_documents(docs.select("doc_id", "text"))
    rows = stage(counted.select("doc_id", *(c.cast("double").alias(f"f{i}") for i, c in enumerate(listed))), "statistics")
    moments = rows.agg(*(F.avg(f"f{i}") for i in range(n)), *(F.stddev_pop(f"f{i}") for i in range(n))).first()
    moments = np.array([0.0 if m is None else m for m in moments])
    features = Features(moments[:n], moments[n:])

    known = labels.filter("quality IN (0, 1)").select(F.col("doc_id"), F.col("quality").cast("double").alias("label"))
    fold = fold_of("doc_id", FOLDS)
    known = stage(rows.join(known.filter(fold != HELD_OUT), "doc_id").withColumn("held", fold == CALIBRATION), "quality-labels")
    weights = solve(known.filter("NOT held"), features)
    scored = known.filter("held").select("label", *(f"f{i}" for i in range(n)))
    calibration = calibrate(scored.mapInArrow(_raw(features, weights), "label double, raw double"), LOW, HIGH)
    ids = docs.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(_raw(features, weights, calibration), f"doc_id {ids}, score double").select(
        "doc_id",
        F.coalesce(fold == HELD_OUT, F.lit(False)).alias("held_out"),
        "score",
        (F.col("score") >= threshold).cast("int").alias("predicted"),
    )
