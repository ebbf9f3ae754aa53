"""Running search history with state (A15): totals, latency and similarity per query, kept across micro-batches.

Every query text has a state of sums (a query is dealt over ``SALTS`` states, so a popular one is no hot key).  A
micro-batch adds its rows and emits the states it changed.  A state that saw nothing for ``idle`` of event time is
closed by a timer and forgotten; rows that come later open a new session.  Sums of all sessions and salts, newest
row each, are the history: ``summary`` gives the figures of the batch summary, whatever the batches were, and a
restarted query goes on from its checkpoint.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from .query_log import latest, run_upserts

SALTS = 8
PROVIDER = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
_CONF = "spark.sql.streaming.stateStore.providerClass"

_STATE = ("started TIMESTAMP, last TIMESTAMP, n BIGINT, latency_n BIGINT, latency_sum DOUBLE, latency_max DOUBLE, "
          "similarity_n BIGINT, similarity_sum DOUBLE")
OUTPUT = f"query STRING, salt INT, {_STATE}, closed BOOLEAN"
_FIELDS = [f.split(" ")[0] for f in _STATE.split(", ")]


class QueryHistory(StatefulProcessor):
    """Sums of one query (and salt) since its session began."""

    def __init__(self, idle_ms: int):
        self.idle_ms = idle_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.state = handle.getValueState("history", _STATE)

    def _row(self, key, values: dict, closed: bool) -> pd.DataFrame:
        return pd.DataFrame([{"query": key[0], "salt": key[1], **values, "closed": closed}])

    def _set_timer(self, last) -> None:
        for t in list(self.handle.listTimers()):
            self.handle.deleteTimer(t if isinstance(t, int) else t[0])
        self.handle.registerTimer(int(last.timestamp() * 1000) + self.idle_ms)

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        held = dict(zip(_FIELDS, self.state.get())) if self.state.exists() else None
        for part in rows:
            first, last = part["ts"].min(), part["ts"].max()
            new = {"started": first, "last": last, "n": len(part), "latency_n": int(part["latency"].count()), "latency_sum": float(part["latency"].sum()),
                   "latency_max": float(part["latency"].max()) if part["latency"].count() else None,
                   "similarity_n": int(part["similarity"].count()), "similarity_sum": float(part["similarity"].sum())}
            if held is None:
                held = new
                continue
            peaks = [x for x in (held["latency_max"], new["latency_max"]) if x is not None and x == x]
            held = {k: held[k] + new[k] for k in ("n", "latency_n", "latency_sum", "similarity_n", "similarity_sum")} | {
                # (a session is named by its first row as first seen: a late row does not rename it)
                "started": held["started"], "last": max(pd.Timestamp(held["last"]), pd.Timestamp(new["last"])), "latency_max": max(peaks, default=None)}
        held = {k: held[k] for k in _FIELDS}
        held["started"], held["last"] = (pd.Timestamp(held[k]).to_pydatetime() for k in ("started", "last"))
        self.state.update(tuple(held.values()))
        self._set_timer(held["last"])
        yield self._row(key, held, False)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        if self.state.exists():
            held = dict(zip(_FIELDS, self.state.get()))
            self.state.clear()
            yield self._row(key, held, True)

    def close(self) -> None:
        pass


def running_history(log: DataFrame, idle_ms: int = 30 * 86_400_000, watermark: str = "10 minutes", salts: int = SALTS) -> DataFrame:
    """Changed states of ``log(ts, query, latency, similarity)``, in update mode; rows without a time or query are left out."""
    rows = (log.select("ts", "query", F.col("latency").cast("double").alias("latency"), F.col("similarity").cast("double").alias("similarity"))
            .where("ts IS NOT NULL AND query IS NOT NULL").withWatermark("ts", watermark)
            .withColumn("salt", F.pmod(F.xxhash64("ts", "latency", "similarity"), F.lit(salts)).cast("int")))
    return rows.groupBy("query", "salt").transformWithStateInPandas(
        statefulProcessor=QueryHistory(idle_ms), outputStructType=OUTPUT, outputMode="Update", timeMode="EventTime")


def run(spark: SparkSession, states: DataFrame, sink_path: str, checkpoint: str):
    """Process everything available now; the state store that this operator needs is set for the query alone."""
    old = spark.conf.get(_CONF, None)
    spark.conf.set(_CONF, PROVIDER)
    try:
        return run_upserts(states, sink_path, checkpoint)
    finally:
        spark.conf.unset(_CONF) if old is None else spark.conf.set(_CONF, old)


def _mean(total: Column, n: Column, digits: int) -> Column:
    return F.when(n > 0, F.round(total / n, digits))


def by_query(spark: SparkSession, sink_path: str) -> DataFrame:
    """Sums of every query over its salts and sessions."""
    rows = latest(spark, sink_path, ["query", "salt", "started"])
    return rows.groupBy("query").agg(*[F.sum(c).alias(c) for c in ("n", "latency_n", "latency_sum", "similarity_n", "similarity_sum")],
                                     F.max("latency_max").alias("latency_max"))


def summary(sums: DataFrame, *keys: str) -> DataFrame:
    """The history's summary (A15), of all queries or by ``keys``: number, mean and highest latency, mean similarity."""
    n, total = (lambda c: F.sum(f"{c}_n")), (lambda c: F.sum(f"{c}_sum"))
    return sums.groupBy(*keys).agg(F.sum("n").alias("total_queries"), _mean(total("latency"), n("latency"), 2).alias("avg_latency_ms"),
                                   F.round(F.max("latency_max"), 2).alias("max_latency_ms"), _mean(total("similarity"), n("similarity"), 4).alias("avg_similarity"))
