"""Text search (J7) and its metrics.

Batch form of the reference's one-query-at-a-time search: a table of
queries is encoded, joined to the text index with the blocked top-k
kernel, optionally filtered, re-ranked and summarised per query.
"""

from __future__ import annotations

import time
from functools import reduce
from typing import Mapping

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .. import config
from ..functions.encoder import hashed_text_vector
from ..functions.text import format_score, prefix, strip
from ..session import stored
from .knn import attach_metadata
from .blocks import topk_join

# Result attributes a filter may name (snake_case, as in the result rows).
FILTERABLE = ("product_id", "image_path", "product_name", "article_type", "master_category", "sub_category",
              "base_colour", "brand", "usage")


def text_index(catalog: DataFrame, text_col: str = "productDisplayName", id_col: str = "id") -> DataFrame:
    """Vector per catalog row from its text (the searchable index)."""
    return catalog.select(F.col(id_col).alias("id"), hashed_text_vector(F.col(text_col)).alias("embedding"))


def split_queries(queries: DataFrame, query_col: str = "query") -> tuple[DataFrame, DataFrame]:
    """(accepted, rejected): blank queries are rejected (P22); accepted ones are stripped."""
    blank = F.coalesce(strip(query_col), F.lit("")) == ""
    return (queries.where(~blank).withColumn(query_col, strip(query_col)), queries.where(blank))


def filter_predicate(filters: Mapping[str, str] | None) -> Column | None:
    """AND of case-insensitive equalities on result attributes.
    An unknown attribute is an error (it would silently match nothing)."""
    if not filters:
        return None
    preds = []
    for k, v in filters.items():
        if k not in FILTERABLE:
            raise ValueError(f"unknown filter attribute {k!r}; use one of {FILTERABLE}")
        preds.append(F.lower(F.col(k).cast("string")) == F.lower(F.lit(str(v))))
    return reduce(lambda a, b: a & b, preds)


def text_search(queries: DataFrame, index: DataFrame, catalog: DataFrame, top_k: int = config.TOP_K_SEARCH_RESULTS,
                filters: Mapping[str, str] | None = None, mode: str = "pre", qid_col: str = "qid",
                query_col: str = "query") -> DataFrame:
    """Top-k products per text query.

    ``mode="pre"`` (default) filters the index first, so every match counts.
    ``mode="post"`` keeps the older behaviour: retrieve top_k + 10 by raw
    similarity, then filter, then keep the first top_k (it may return fewer
    than top_k although more matches exist).
    """
    if mode not in ("post", "pre"):
        raise ValueError("mode must be 'post' or 'pre'")
    return _searched(encoded_queries(queries, qid_col, query_col), queries, index, catalog, top_k, filters, mode, qid_col, query_col)


def encoded_queries(queries: DataFrame, qid_col: str = "qid", query_col: str = "query") -> DataFrame:
    """``(id, embedding)`` of the accepted queries."""
    ok, _ = split_queries(queries, query_col)
    return ok.select(F.col(qid_col).alias("id"), hashed_text_vector(F.col(query_col)).alias("embedding"))


def _searched(q: DataFrame, queries: DataFrame, index: DataFrame, catalog: DataFrame, top_k: int, filters, mode: str,
              qid_col: str, query_col: str) -> DataFrame:
    ok, _ = split_queries(queries, query_col)
    pred = filter_predicate(filters)
    idx = index
    fetch = top_k + config.SEARCH_OVERFETCH
    if mode == "pre":
        fetch = top_k
        if pred is not None:
            meta = attach_metadata(index.select(F.col("id").alias("r_id")), catalog).where(pred)
            idx = index.join(meta.select(F.col("product_id").alias("id")), "id", "left_semi")
    hits = topk_join(q, idx, fetch).select(F.col("l_id").alias(qid_col), F.col("rank").alias("_r"), "r_id", "raw")
    hits = attach_metadata(hits, catalog)
    if mode == "post" and pred is not None:
        hits = hits.where(pred)
    w = Window.partitionBy(qid_col).orderBy(F.col("_r"))
    hits = hits.withColumn("rank", F.row_number().over(w).cast("bigint")).where(F.col("rank") <= top_k)
    sim = F.least(F.greatest(F.col("raw"), F.lit(0.0)), F.lit(1.0))
    return (hits.withColumn("similarity", sim)
                .withColumn("similarity_pct", format_score(F.col("similarity")))
                .drop("_r", "raw")
                .join(ok.select(qid_col, query_col), qid_col))


def timed_search(queries: DataFrame, index: DataFrame, catalog: DataFrame, top_k: int = config.TOP_K_SEARCH_RESULTS,
                 filters: Mapping[str, str] | None = None, mode: str = "pre", qid_col: str = "qid",
                 query_col: str = "query") -> tuple[DataFrame, DataFrame]:
    """``(results, metrics)`` of a batch of queries with its times (A14): the encoding of the queries and the search
    are jobs of their own, each run once and stored, timed on the driver's clock.  A query's ``encode_ms``,
    ``search_ms`` and ``total_ms`` are its share of the batch; ``batch_ms`` is the whole."""
    start = time.perf_counter()
    encoded = stored(encoded_queries(queries, qid_col, query_col), "search-queries")
    middle = time.perf_counter()
    results = stored(_searched(encoded, queries, index, catalog, top_k, filters, mode, qid_col, query_col), "search-results")
    end = time.perf_counter()
    n = max(encoded.count(), 1)
    times = {"encode_ms": (middle - start) * 1000 / n, "search_ms": (end - middle) * 1000 / n, "total_ms": (end - start) * 1000 / n, "batch_ms": (end - start) * 1000}
    return results, search_metrics(queries, results, top_k, qid_col, query_col).withColumns({k: F.lit(round(v, 3)) for k, v in times.items()})


def search_metrics(queries: DataFrame, results: DataFrame, top_k: int = config.TOP_K_SEARCH_RESULTS,
                   qid_col: str = "qid", query_col: str = "query") -> DataFrame:
    """One row per accepted query (A14); 0 similarity stats for no results.  ``timed_search`` adds times."""
    ok, _ = split_queries(queries, query_col)
    agg = results.groupBy(qid_col).agg(
        F.count(F.lit(1)).alias("n_results"),
        F.max("similarity").alias("mx"), F.min("similarity").alias("mn"), F.avg("similarity").alias("av"))
    j = ok.select(qid_col, query_col).join(agg, qid_col, "left")
    return j.select(
        qid_col, query_col, F.lit(top_k).cast("bigint").alias("top_k"),
        F.coalesce("n_results", F.lit(0)).cast("bigint").alias("n_results"),
        F.coalesce(F.round("mx", 4), F.lit(0.0)).alias("max_similarity"),
        F.coalesce(F.round("mn", 4), F.lit(0.0)).alias("min_similarity"),
        F.coalesce(F.round("av", 4), F.lit(0.0)).alias("avg_similarity"))


def precision_at_k(results: DataFrame, truth: DataFrame, k: int = 5, attr: str = "article_type",
                   qid_col: str = "qid") -> DataFrame:
    """Precision@K per query (A16): hits among the first k results / k
    (denominator k even when fewer results; k <= 0 gives 0).

    ``truth``: ``(qid, relevant)`` one row per relevant value.
    """
    rel = truth.select(qid_col, F.lower(F.col("relevant")).alias("_rel")).where(F.col("_rel").isNotNull()).distinct()
    r = results.where(F.col("rank") <= k).select(qid_col, F.lower(F.col(attr)).alias("_rel"))
    hit = r.join(rel, [qid_col, "_rel"], "left_semi").groupBy(qid_col).agg(F.count(F.lit(1)).alias("hits"))
    qs = truth.select(qid_col).distinct().join(hit, qid_col, "left")
    p = F.coalesce(F.col("hits"), F.lit(0)).cast("double") / F.lit(float(k)) if k > 0 else F.lit(0.0)
    return qs.select(qid_col, F.coalesce("hits", F.lit(0)).cast("bigint").alias("hits"), p.alias("precision"))


def mean_precision(per_query: DataFrame) -> DataFrame:
    return per_query.agg(F.count(F.lit(1)).alias("n_queries"), F.avg("precision").alias("mean_precision"))


def history_summary(log: DataFrame, query_col: str = "query", latency_col: str = "total_ms",
                    sim_col: str | None = "avg_sim") -> DataFrame:
    """Summary of a query log (A15): totals and latency stats.  The list of
    queries is the log itself (not gathered into one row)."""
    aggs = [F.count(F.lit(1)).alias("total_queries"),
            F.round(F.avg(latency_col), 2).alias("avg_latency_ms"),
            F.round(F.max(latency_col), 2).alias("max_latency_ms")]
    if sim_col:
        aggs.append(F.round(F.avg(sim_col), 4).alias("avg_similarity"))
    return log.agg(*aggs)


def metrics_series(metrics: DataFrame, latency_col: str | None = "total_ms", query_col: str = "query") -> DataFrame:
    """Chart series (A18): label = first 20 chars, latency (where the metrics have it), avg similarity x 100."""
    return metrics.select(prefix(query_col, config.QUERY_LABEL_CHARS).alias("label"),
                          *([F.col(latency_col).alias("latency_ms")] if latency_col else []),
                          (F.col("avg_similarity") * 100).alias("avg_similarity_pct"))
