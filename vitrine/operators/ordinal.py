"""Dense 0-based numbering of rows in a global order without a
single-partition window.

Rows are put into range buckets between literal cut values (approximate
quantiles, found once), numbered inside their bucket, and offset by the
counts of the buckets before.  The cuts are literals, so the counts and
the rows agree on the buckets however often either is computed.  Only the
offsets (one row a bucket) are broadcast.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.ranges import quantile_cuts, range_bucket


def ordinal(df: DataFrame, order_col: str, out_col: str = "ordinal", partitions: int | None = None) -> DataFrame:
    """Add ``out_col`` = 0-based position of each row in ``order_col`` order.

    ``order_col`` is numeric; it must be unique for a deterministic
    numbering.  Null keys come first.
    """
    n = partitions or 4 * int(df.sparkSession.conf.get("spark.sql.shuffle.partitions", "200"))
    bucket = F.when(F.col(order_col).isNull(), -1).otherwise(range_bucket(F.col(order_col), quantile_cuts(df, order_col, n)))
    rows = df.withColumn("_bucket", bucket)
    before = Window.orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)  # over at most n + 1 rows
    counts = rows.groupBy("_bucket").agg(F.count(F.lit(1)).alias("_n"))
    offsets = counts.select("_bucket", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_off"))
    inside = F.row_number().over(Window.partitionBy("_bucket").orderBy(order_col))
    return (rows.withColumn("_rn", inside).join(F.broadcast(offsets), "_bucket")
                .withColumn(out_col, (F.col("_off") + F.col("_rn") - 1).cast("bigint"))
                .drop("_bucket", "_rn", "_off"))
