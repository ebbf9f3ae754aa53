"""Structured Streaming forms of the append-only parts of the reference.

* The search query history is an append-only log summarised on demand
  (A15).  ``windowed_summary`` keeps that summary incrementally per event
  time window, with a watermark bounding the state kept for late rows.
* New listings are checked against the stored catalog and each other as
  they arrive (:mod:`.duplicates`).

State and progress live under the session's shared checkpoint folder.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..session import ensure_checkpoint_dir
from .duplicates import duplicate_check  # noqa: F401

LOG_SCHEMA = "event_id BIGINT, ts TIMESTAMP, user_id BIGINT, event_type STRING, value DOUBLE, props STRING"


def read_log(spark: SparkSession, path: str, schema: str = LOG_SCHEMA, max_files_per_trigger: int | None = None) -> DataFrame:
    r = spark.readStream.schema(schema)
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    return r.parquet(path)


def windowed_summary(log: DataFrame, window: str = "1 hour", watermark: str = "10 minutes", ts_col: str = "ts",
                     query_col: str = "event_type", latency_col: str = "value") -> DataFrame:
    """Per (event-time window, query): count, average and max latency."""
    return (log.withWatermark(ts_col, watermark)
               .groupBy(F.window(ts_col, window).alias("window"), F.col(query_col).alias("query"))
               .agg(F.count(F.lit(1)).alias("total_queries"), F.avg(latency_col).alias("avg_latency_ms"),
                    F.max(latency_col).alias("max_latency_ms")))


def checkpoint_location(spark: SparkSession, name: str) -> str:
    return ensure_checkpoint_dir(spark).rstrip("/") + f"/streams/{name}-{uuid.uuid4().hex[:8]}"


def run_upserts(df: DataFrame, sink_path: str, checkpoint: str) -> StreamingQuery:
    """Process everything available now in update mode: every micro-batch
    writes its changed rows to ``sink_path/epoch=<batch id>``, replacing its
    own output when it is retried.  ``latest`` reads the newest row per key,
    so windows that are still open are there too."""
    def batch(changed: DataFrame, epoch_id: int) -> None:
        changed.write.mode("overwrite").parquet(f"{sink_path.rstrip('/')}/epoch={epoch_id}")
    q = (df.writeStream.foreachBatch(batch).outputMode("update").option("checkpointLocation", checkpoint)
           .trigger(availableNow=True).start())
    q.awaitTermination()
    return q


def latest(spark: SparkSession, sink_path: str, keys: list[str]) -> DataFrame:
    """Newest row per key of an epoch-partitioned sink."""
    rows = spark.read.parquet(sink_path)
    values = [c for c in rows.columns if c not in (*keys, "epoch")]
    newest = rows.groupBy(*keys).agg(F.max_by(F.struct(*values), "epoch").alias("v"))
    return newest.select(*keys, *[F.col(f"v.{c}").alias(c) for c in values])


def run_available(df: DataFrame, sink_path: str, checkpoint: str, fmt: str = "parquet",
                  output_mode: str = "append") -> StreamingQuery:
    """Process everything available now, then stop (batch-like run of a stream)."""
    q = (df.writeStream.format(fmt).outputMode(output_mode).option("checkpointLocation", checkpoint)
           .option("path", sink_path).trigger(availableNow=True).start())
    q.awaitTermination()
    return q
