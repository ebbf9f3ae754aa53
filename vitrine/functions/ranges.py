"""Range buckets: which of some sorted cut values a key falls between."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def range_bucket(key: Column, cuts: list) -> Column:
    """How many of the sorted ``cuts`` are at most ``key``: a binary search over an array literal."""
    if not cuts:
        return F.lit(0)
    steps = F.array(*[F.lit(1 << k) for k in range(len(cuts).bit_length() - 1, -1, -1)])
    table = F.array(*[F.lit(c) for c in cuts]) if isinstance(cuts[0], bytes) else F.lit(list(cuts))
    return F.aggregate(steps, F.lit(0), lambda at, step: F.when(
        (at + step <= len(cuts)) & (F.element_at(table, F.least(at + step, F.lit(len(cuts)))) <= key), at + step).otherwise(at))


def quantile_cuts(df: DataFrame, key: str, buckets: int) -> list:
    """At most ``buckets - 1`` distinct values that cut a numeric column evenly (approximate quantiles)."""
    if buckets < 2:
        return []
    shares = [i / buckets for i in range(1, buckets)]
    found = df.select(F.percentile_approx(key, shares, 20 * buckets).alias("cuts")).first()["cuts"]
    return sorted(set(found or []))
