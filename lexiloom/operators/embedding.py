"""Text vectors: an offline hashed form and a pluggable one."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _unit_counts(dimensions: int) -> Callable[[Column], Column]:
    @F.arrow_udf("array<float>")
    def unit(places: pa.Array) -> pa.Array:
        """How often each place occurs in each row's list, as vectors of length one."""
        row = pc.list_parent_indices(places).to_numpy().astype(np.int64)
        at = places.flatten().to_numpy(zero_copy_only=False)
        counts = np.bincount(row * dimensions + at, minlength=len(places) * dimensions).reshape(-1, dimensions)
        lengths = np.sqrt((counts**2).sum(axis=1, keepdims=True))
        vectors = pa.array((counts / np.maximum(lengths, 1)).astype(np.float32).ravel())
        offsets = pa.array(np.arange(len(places) + 1, dtype=np.int32) * dimensions, mask=None)
        made = pa.ListArray.from_arrays(offsets, vectors)
        return pc.if_else(places.is_valid(), made, pa.scalar(None, made.type))

    return unit


def embed_hashed(
    df: DataFrame, column: str = "text", dimensions: int = 64, output: str = "embedding"
) -> DataFrame:
    """Unit-length hashed counts of lower-cased words; nothing to fit, so one pass
    without a shuffle.

    A word's place is the first 32 bits of its MD5 modulo ``dimensions``. A text
    without words gives zeros, NULL gives NULL.
    """
    words = F.filter(F.split(F.lower(F.col(column)), r"\s+"), lambda w: w != "")
    place = F.transform(words, lambda w: F.conv(F.substring(F.md5(w.cast("binary")), 1, 8), 16, 10).cast("bigint") % dimensions)
    return df.withColumn(output, _unit_counts(dimensions)(place))


def embed_with(
    df: DataFrame,
    encoder: Callable[[], Callable[[list[str]], list[list[float]]]],
    column: str = "text",
    output: str = "embedding",
) -> DataFrame:
    """Vectors from an outside encoder, built once per partition, asked per batch."""

    @F.pandas_udf("array<float>")
    def encode(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        run = encoder()
        for texts in batches:
            yield pd.Series(list(run(texts.tolist())), dtype="object")

    return df.withColumn(output, encode.asNondeterministic()(F.col(column)))
