"""Vector expressions over ``array<float>`` columns, computed in DOUBLE.

Spark evaluates array lambdas element by element, so the native ``cosine`` is
meant for few or short vectors. The Arrow forms hand whole batches of vectors
to numpy and are what the pair operators use.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

# Pairs worked on at a time inside a task.
SLICE = 4096


def dot(a: Column, b: Column) -> Column:
    return F.aggregate(
        F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")),
        F.lit(0.0),
        lambda total, term: total + term,
    )


def norm(a: Column) -> Column:
    return F.sqrt(
        F.aggregate(a, F.lit(0.0), lambda total, x: total + x.cast("double") * x.cast("double"))
    )


def cosine(a: Column, b: Column) -> Column:
    """Between -1 and 1; NULL when a vector is all zero."""
    return F.try_divide(dot(a, b), norm(a) * norm(b))


def _matrix(vectors: pa.ListArray) -> np.ndarray:
    """A list column as a two-dimensional array; NaN where a vector is NULL."""
    there = vectors.is_valid().to_numpy(zero_copy_only=False)
    widths = vectors.value_lengths().drop_null().unique().to_pylist()
    if len(widths) > 1:
        raise ValueError(f"vectors of different lengths: {sorted(widths)}")
    out = np.full((len(vectors), widths[0] if widths else 0), np.nan)
    if there.any():
        out[there] = vectors.flatten().to_numpy(zero_copy_only=False).reshape(int(there.sum()), -1)
    return out


def _cosines(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Row by row; NaN where a vector is NULL or all zero."""
    if not a.shape[1] or not b.shape[1]:  # NULL vectors only, on one side at least
        return np.full(len(a), np.nan)
    lengths = np.linalg.norm(a, axis=1) * np.linalg.norm(b, axis=1)
    with np.errstate(divide="ignore", invalid="ignore"):
        return np.where(lengths > 0, np.einsum("ij,ij->i", a, b) / lengths, np.nan)


def _nullable(values: np.ndarray) -> pa.Array:
    return pa.array(values, type=pa.float64(), from_pandas=True)


def batch_cosine(a: Column, b: Column) -> Column:
    """``cosine`` batch by batch; vectors of different lengths are an error."""

    @F.arrow_udf("double")
    def run(left: pa.Array, right: pa.Array) -> pa.Array:
        return _nullable(_cosines(_matrix(left), _matrix(right)))

    return run(a, b)


def block_cosines(vectors: Column, partners: Column) -> Column:
    """Cosines inside a block: of each vector with those at its partner places.

    ``vectors`` is ``array<array<float>>``, ``partners`` ``array<array<int>>``
    of places in it; the result has the shape of ``partners``. Each vector
    crosses to Python once, however many pairs it is in.
    """

    @F.arrow_udf("array<array<double>>")
    def run(blocks: pa.Array, wanted: pa.Array) -> pa.Array:
        parts = []
        for block, lists in zip(blocks, wanted):
            matrix, partners_of = _matrix(block.values), lists.values
            right = partners_of.flatten().to_numpy(zero_copy_only=False)
            left = np.repeat(np.arange(len(partners_of)), partners_of.value_lengths())
            scores = [
                _cosines(matrix[left[at : at + SLICE]], matrix[right[at : at + SLICE]])
                for at in range(0, len(left), SLICE)
            ]
            ends = np.concatenate([[0], np.cumsum(partners_of.value_lengths())]).astype(np.int32)
            flat = _nullable(np.concatenate(scores) if scores else np.empty(0))
            parts.append(pa.ListArray.from_arrays(pa.array(ends), flat))
        sizes = np.concatenate([[0], np.cumsum([len(p) for p in parts])]).astype(np.int32)
        inner = pa.concat_arrays(parts) if parts else pa.array([], pa.list_(pa.float64()))
        return pa.ListArray.from_arrays(pa.array(sizes), inner)

    return run(vectors, partners)
