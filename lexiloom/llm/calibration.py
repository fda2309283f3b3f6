"""Isotonic calibration of raw scores, from counts of a fixed number of bins."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BINS = 1024


def fold_of(doc_id: str, folds: int) -> Column:
    """crc32 of the id as text, modulo ``folds``; null for a null id."""
    return F.pmod(F.crc32(F.col(doc_id).cast("string")), F.lit(folds))


@dataclass(frozen=True)
class Calibration:
    """Rising steps, joined by straight lines between the middles of the steps."""

    x: np.ndarray
    y: np.ndarray

    def __call__(self, raw: np.ndarray) -> np.ndarray:
        return np.clip(np.interp(raw, self.x, self.y), 0.0, 1.0)


def pool_violators(weight: np.ndarray, mean: np.ndarray, at: np.ndarray) -> list[list[float]]:
    """Blocks (weight, mean, middle) with rising means: each falling pair is pooled."""
    blocks: list[list[float]] = []
    for w, m, x in zip(weight.tolist(), mean.tolist(), at.tolist()):
        blocks.append([w, m, x])
        while len(blocks) > 1 and blocks[-2][1] >= blocks[-1][1]:
            w2, m2, x2 = blocks.pop()
            w1, m1, x1 = blocks[-1]
            total = w1 + w2
            blocks[-1] = [total, (w1 * m1 + w2 * m2) / total, (w1 * x1 + w2 * x2) / total]
    return blocks


def calibrate(scored: DataFrame, low: float, high: float, bins: int = BINS) -> Calibration:
    """Of ``scored`` (raw, label), label 0 or 1. All rows count; what reaches the
    driver is a count and two sums per bin. Without rows, every score is one half."""
    place = F.floor((F.greatest(F.least("raw", F.lit(high)), F.lit(low)) - low) / (high - low) * (bins - 1))
    rows = (
        scored.groupBy(place.alias("bin"))
        .agg(F.count(F.lit(1)).alias("n"), F.avg("raw").alias("x"), F.sum("label").alias("ones"))
        .orderBy("bin")
        .collect()
    )
    if not rows:
        return Calibration(np.array([low, high]), np.array([0.5, 0.5]))
    n, x, ones = (np.array([float(r[c]) for r in rows]) for c in ("n", "x", "ones"))
    # One row of either label is added, so that no step is at 0 or 1 exactly.
    n, x, ones = np.append(n, 1.0), np.append(x, x[-1]), np.append(ones, 1.0)
    n, x, ones = np.insert(n, 0, 1.0), np.insert(x, 0, x[0]), np.insert(ones, 0, 0.0)
    blocks = pool_violators(n, ones / n, x)
    return Calibration(np.array([b[2] for b in blocks]), np.array([b[1] for b in blocks]))
