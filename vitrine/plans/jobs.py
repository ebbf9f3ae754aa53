"""User-level jobs (C1-C7): the operators chained the way the catalog
application runs them, as whole-catalog batch jobs.

Each returns lazy DataFrames (or writes tables); nothing data-sized is
collected to the driver.
"""

from __future__ import annotations

import uuid
from typing import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import config
from ..functions.encoder import hashed_text_vector
from ..functions.text import prefix
from ..functions.vectors import assert_valid, validate_vectors
from ..operators import clean as cl
from ..operators import dedup as dd
from ..operators import profile as prof
from ..operators import recommend as rec
from ..operators import search as srch
from ..operators.project import project_embeddings
from ..session import ensure_checkpoint_dir
from ..sources import catalog_io as io


def load_catalog(spark: SparkSession, csv_path: str, image_dir: str, cap: int | None = None) -> DataFrame:
    """CSV -> clean -> keep products with an image -> optional cap."""
    raw = io.read_catalog_csv(spark, csv_path)
    return cl.load_catalog(raw, io.image_inventory(spark, image_dir), cap)


def build_search_table(catalog: DataFrame, vectors: DataFrame, path: str, validate: bool = True) -> DataFrame:
    """Validate vectors against the catalog, store catalog+vectors as Parquet."""
    if validate:
        bad = assert_valid(validate_vectors(vectors, catalog))
        bad.collect()  # one row; raises inside the job when the table is invalid
    io.save_search_table(catalog, vectors, path)
    return catalog.sparkSession.read.parquet(path)


def refresh_vectors(catalog: DataFrame, cache: DataFrame, text_col: str = "productDisplayName") -> DataFrame:
    """S10 with the default encoder: vectors only for rows missing from the cache or changed since."""
    todo = io.vectors_to_refresh(catalog, cache, text_col)
    return todo.select("id", hashed_text_vector(F.col(text_col)).alias("embedding"), io.content_hash(text_col).alias("content_hash"))


def csv_round_trip(df: DataFrame) -> DataFrame:
    """Export a frame as CSV into the shared checkpoint folder and ingest it again."""
    path = f"{ensure_checkpoint_dir(df.sparkSession).rstrip('/')}/csv-{uuid.uuid4().hex}"
    io.write_csv(df, path)
    return io.read_catalog_csv(df.sparkSession, path)


def profile_catalog(raw: DataFrame, images: DataFrame, final: DataFrame) -> dict[str, DataFrame]:
    """Home statistics."""
    return {
        "scalars": prof.scalars(raw, images),
        "master_category": prof.master_category_counts(final),
        "article_type": prof.article_type_counts(final),
        "usage": prof.usage_counts(final),
        "colour": prof.colour_counts(final),
        "sample": cl.display_sample(final),
    }


def projection(catalog: DataFrame) -> DataFrame:
    """C4: embedding projection data."""
    return project_embeddings(catalog)


def recommend(catalog: DataFrame, name: str | None = None, top_k: int = config.TOP_K_RECOMMENDATIONS) -> dict[str, DataFrame]:
    """Recommendations (for one name, or for every product) + confidence."""
    recs = rec.recommend_by_name(catalog, name, top_k) if name else rec.recommend(catalog, None, top_k)
    shown = recs.select("source_id", "rank", prefix("product_name", config.NAME_DISPLAY_CHARS).alias("product_name"),
                        prefix("reason", config.REASON_DISPLAY_CHARS).alias("reason"), "score")
    return {"recommendations": recs, "display": shown, "confidence": rec.confidence(recs)}


def deduplicate(catalog: DataFrame, threshold: float = config.DUPLICATE_SIMILARITY_THRESHOLD,
                out_dir: str | None = None, method: str = "exact") -> dict[str, DataFrame]:
    """Duplicate clusters, unique catalog, report, summary; optional CSV exports."""
    res = dd.deduplicate(catalog, threshold, method=method)
    if out_dir:
        io.export_unique_catalog(res["unique"], out_dir.rstrip("/") + "/unique_catalog")
        io.export_duplicate_report(res["report"], out_dir.rstrip("/") + "/duplicate_report")
    return res


def search(queries: DataFrame, catalog: DataFrame, top_k: int = config.TOP_K_SEARCH_RESULTS,
           filters: Mapping[str, str] | None = None, mode: str = "pre") -> dict[str, DataFrame]:
    """Text search for a table of queries + per-query metrics."""
    idx = srch.text_index(catalog)
    res = srch.text_search(queries, idx, catalog, top_k, filters, mode)
    _, rejected = srch.split_queries(queries)
    return {"results": res, "metrics": srch.search_metrics(queries, res, top_k), "rejected": rejected}
