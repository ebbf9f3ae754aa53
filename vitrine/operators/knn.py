"""Top-k similarity search.

* one literal query vector: score column + ``orderBy(...).limit(k)``
  (TakeOrderedAndProject: a bounded heap per task, no shuffle of rows);
* many queries (a table of vectors, or every product against the rest):
  the blocked kernel in :mod:`.blocks`, then a per-query WindowGroupLimit.
Ordering is always (raw inner product desc, id asc); the similarity shown
is clipped to [0, 1] after ranking.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import or_unknown
from ..functions.vectors import clip01, dot
from .blocks import topk_join
from .pivots import pruned_topk

def _meta_cols(prefix: str = "") -> list[Column]:
    """Result metadata from a catalog row; absent values become 'Unknown' ('' for the path)."""
    return [
        F.coalesce(F.col("image_path").cast("string"), F.lit("")).alias("image_path"),
        or_unknown("productDisplayName").alias("product_name"),
        or_unknown("articleType").alias("article_type"),
        or_unknown("masterCategory").alias("master_category"),
        or_unknown("subCategory").alias("sub_category"),
        or_unknown("baseColour").alias("base_colour"),
        or_unknown("brand").alias("brand"),
        or_unknown("usage").alias("usage"),
    ]


def attach_metadata(hits: DataFrame, catalog: DataFrame, id_col: str = "r_id") -> DataFrame:
    """Join hit ids to catalog metadata (J6).  Hits without a catalog row keep 'Unknown' fields."""
    meta_cols = [c for c in ("image_path", "productDisplayName", "articleType", "masterCategory", "subCategory",
                             "baseColour", "brand", "usage") if c in catalog.columns]
    meta = catalog.select(F.col("id").alias(id_col), *meta_cols)
    j = hits.join(meta, id_col, "left")
    for c in ("image_path", "productDisplayName", "articleType", "masterCategory", "subCategory",
              "baseColour", "brand", "usage"):
        if c not in j.columns:
            j = j.withColumn(c, F.lit(None).cast("string"))
    keep = [c for c in hits.columns if c != id_col]
    return j.select(*keep, F.col(id_col).alias("product_id"), *_meta_cols())


def exclude(index: DataFrame, exclude_ids: DataFrame | None, id_col: str = "id") -> DataFrame:
    """Drop excluded ids before ranking (J3) - same result as over-fetching then dropping, since ids are unique."""
    if exclude_ids is None:
        return index
    return index.join(exclude_ids.select(F.col(id_col)), id_col, "left_anti")


def knn_by_vector(index: DataFrame, query: Sequence[float], k: int = 5, catalog: DataFrame | None = None,
                  exclude_ids: DataFrame | None = None, id_col: str = "id", vec_col: str = "embedding") -> DataFrame:
    """Top-k rows of ``index`` for one query vector."""
    q = F.array(*[F.lit(float(x)).cast("double") for x in query])
    idx = exclude(index.where(F.col(vec_col).isNotNull()), exclude_ids, id_col)
    scored = idx.select(F.col(id_col).alias("r_id"), dot(vec_col, q).alias("raw"))
    top = scored.orderBy(F.col("raw").desc(), F.col("r_id").asc()).limit(k)
    w = Window.orderBy(F.col("raw").desc(), F.col("r_id").asc())  # k rows only
    top = top.withColumn("rank", F.row_number().over(w).cast("bigint"))
    top = top.withColumn("similarity", clip01("raw"))
    return attach_metadata(top, catalog) if catalog is not None else top.withColumnRenamed("r_id", "product_id")


def knn_batch(queries: DataFrame, index: DataFrame, k: int = 5, catalog: DataFrame | None = None,
              exclude_self: bool = False, id_col: str = "id", vec_col: str = "embedding",
              query_id: str = "qid", query_vec: str = "embedding", method: str = "blocks") -> DataFrame:
    """Top-k of ``index`` for every row of ``queries`` (J5); ``method="pivots"`` skips blocks by bounds (:mod:`.pivots`).

    Returns ``query_id, rank, product_id, raw, similarity`` (+ metadata with a catalog).
    Passing the same frame as queries and index packs its blocks once.
    """
    same = queries is index and query_id == id_col and query_vec == vec_col
    idx = index.where(F.col(vec_col).isNotNull()).select(F.col(id_col).alias("id"), F.col(vec_col).alias("embedding"))
    q = idx if same else queries.where(F.col(query_vec).isNotNull()).select(
        F.col(query_id).alias("id"), F.col(query_vec).alias("embedding"))
    hits = (pruned_topk if method == "pivots" else topk_join)(q, idx, k, exclude_self=exclude_self)
    hits = hits.select(F.col("l_id").alias(query_id), F.col("rank").cast("bigint").alias("rank"), "r_id", "raw",
                       clip01("raw").alias("similarity"))
    if catalog is not None:
        return attach_metadata(hits, catalog)
    return hits.withColumnRenamed("r_id", "product_id")


def knn_by_product(index: DataFrame, product_ids: DataFrame | None = None, k: int = 5,
                   catalog: DataFrame | None = None, id_col: str = "id", vec_col: str = "embedding", method: str = "blocks") -> DataFrame:
    """Neighbours of given products (default: every product), each excluding
    itself (J4).  Ids without a vector produce no rows; ``unknown_ids``
    reports them."""
    q = index if product_ids is None else index.join(product_ids.select(id_col).distinct(), id_col, "left_semi")
    return knn_batch(q, index, k, catalog, exclude_self=True, id_col=id_col, vec_col=vec_col,
                     query_id=id_col, query_vec=vec_col, method=method).withColumnRenamed(id_col, "source_id")


def unknown_ids(index: DataFrame, product_ids: DataFrame, id_col: str = "id") -> DataFrame:
    return product_ids.select(id_col).distinct().join(index.select(id_col), id_col, "left_anti")


def centroid(index: DataFrame, vec_col: str = "embedding") -> DataFrame:
    """Mean vector of an index as a one-row ``(id=-1, embedding)`` frame:
    a per-dimension average (partial aggregation), then the D values
    (bounded by the dimension) gathered in dimension order."""
    per_dim = (index.select(F.posexplode(vec_col).alias("dim", "x"))
                    .groupBy("dim").agg(F.avg(F.col("x").cast("double")).alias("mu")))
    return per_dim.agg(F.sort_array(F.collect_list(F.struct("dim", "mu"))).alias("s")).select(
        F.lit(-1).cast("bigint").alias("id"), F.transform("s", lambda e: e["mu"]).alias("embedding"))


def knn_by_query_frame(query: DataFrame, index: DataFrame, k: int = 5, catalog: DataFrame | None = None) -> DataFrame:
    """Top-k for query vectors held in a (small or large) frame ``(id, embedding)``
    without moving them through the driver."""
    return knn_batch(query.withColumnRenamed("id", "qid"), index, k, catalog)
