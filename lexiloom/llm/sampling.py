"""The rows with the least hashes, found without one task seeing many rows."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def least_by_hash(df: DataFrame, digest: str, count: int, total: int, *order: str, distinct: bool = False) -> DataFrame:
    """The ``count`` rows of ``df`` of least ``digest`` (lowercase hex), ties by ``order``;
    with ``distinct``, that many different rows.

    ``total`` is the number of rows. Digests are spread evenly, so a bound on them
    that about ``count`` rows pass is known beforehand; only rows under it are
    sorted. Where too few pass (as rows repeat), the bound is raised.
    """
    wanted, share = min(count, total), (count + 10 * math.sqrt(count) + 20) / max(total, 1)
    while True:
        under = df if share >= 1 else df.filter(F.col(digest) < f"{int(share * 2**60):015x}")
        under = under.distinct() if distinct else under
        if share >= 1 or under.count() >= wanted:
            return under.orderBy(digest, *order).limit(count)
        share *= 4
