"""Bounded samples that reach the driver whole."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def hash_sample(df: DataFrame, key: list[str], value, n: int, total: int) -> list:
    """At most ``n`` values of rows with the smallest hashes of ``key`` (equal keys count once).

    ``total``: rows of ``df``.  Only about ``2 n`` rows pass the first filter, so what tasks send to the driver is
    bounded however many partitions there are.
    """
    if total <= 0:
        return []
    low, span = -(1 << 63), 1 << 64
    cut = low + min(span - 1, span * 2 * n // total)
    rows = df.select(F.xxhash64(*key).alias("h"), value.alias("value")).where((F.col("h") <= cut) & F.col("value").isNotNull())
    return [r["value"] for r in rows.groupBy("h").agg(F.min("value").alias("value")).orderBy("h").limit(n).collect()]
