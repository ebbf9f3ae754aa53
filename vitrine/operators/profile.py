"""Catalog profile (A1-A7): counts, distinct counts and frequency tables.
All are single aggregates (partial + final, map-side combined)."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import config
from ..functions.text import strip
from .clean import null_tokens_to_null, numeric_id, strip_column_names


def scalars(raw: DataFrame, images: DataFrame) -> DataFrame:
    """One row (A1, A2): raw / clean / final counts, removed counts split by
    cause, and the combined figure, plus distinct counts.

    One pass: raw rows are aggregated per product id (the first row of an id
    counts), joined to the images, and counted per (category, type, season),
    which is small; distinct counts are taken over that.
    """
    df = null_tokens_to_null(strip_column_names(raw))
    valid = reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in config.REQUIRED_COLUMNS if c in df.columns]) & numeric_id(F.col("id")).isNotNull()
    kept = F.struct(*[strip(c).alias(c) for c in ("masterCategory", "articleType", "season")])
    rows = df.select(F.when(valid, numeric_id(F.col("id"))).alias("id"), F.col("src_pos" if "src_pos" in df.columns else "id").alias("pos"), kept.alias("kept"))
    per_id = rows.groupBy("id").agg(F.count(F.lit(1)).alias("rows"), F.min_by("kept", "pos").alias("kept"))
    per_id = per_id.join(images.select("id", F.lit(True).alias("img")), "id", "left")
    img = F.coalesce("img", F.lit(False))
    groups = per_id.groupBy(*[F.when(img, F.col(f"kept.{c}")).alias(c) for c in ("masterCategory", "articleType", "season")]).agg(
        F.sum("rows").alias("rows"), F.count("id").alias("clean"), F.count_if(img).alias("final"))
    one = groups.agg(F.coalesce(F.sum("rows"), F.lit(0)).alias("raw_rows"), F.coalesce(F.sum("clean"), F.lit(0)).alias("clean_rows"),
                     F.coalesce(F.sum("final"), F.lit(0)).alias("total_products"),
                     *[F.size(F.collect_set(c)).alias(n) for c, n in  # values of a category vocabulary
                       (("masterCategory", "master_categories"), ("articleType", "article_types"), ("season", "seasons"))])
    n = {c: F.col(c).cast("bigint") for c in ("total_products", "raw_rows", "clean_rows", "master_categories", "article_types", "seasons")}
    return one.select(n["total_products"].alias("total_products"), n["raw_rows"].alias("raw_rows"), n["clean_rows"].alias("clean_rows"),
                      (n["raw_rows"] - n["clean_rows"]).alias("removed_by_clean"), (n["clean_rows"] - n["total_products"]).alias("removed_after_clean"),
                      (n["raw_rows"] - n["total_products"]).alias("missing_before"),
                      *[n[c].alias(c) for c in ("master_categories", "article_types", "seasons")])


def frequency(df: DataFrame, col: str, top: int | None = None) -> DataFrame:
    """Value counts, nulls dropped, count desc then value asc, optional top-n."""
    t = (df.where(F.col(col).isNotNull()).groupBy(F.col(col).alias("value"))
           .agg(F.count(F.lit(1)).alias("n")))
    t = t.orderBy(F.col("n").desc(), F.col("value").asc())
    return t.limit(top) if top else t


def master_category_counts(df: DataFrame) -> DataFrame:
    return frequency(df, "masterCategory")


def article_type_counts(df: DataFrame, top: int = config.TOP_ARTICLE_TYPES) -> DataFrame:
    return frequency(df, "articleType", top)


def usage_counts(df: DataFrame) -> DataFrame:
    return frequency(df, "usage")


def colour_counts(df: DataFrame, top: int = config.TOP_COLOURS) -> DataFrame:
    return frequency(df, "baseColour", top)


def chart_article_types(df: DataFrame, top_n: int = config.CHART_TOP_TYPES) -> DataFrame:
    """Chart cut (A7): the first top_n of the top-20 article type table."""
    return article_type_counts(df).limit(top_n)


PROFILE_COLUMNS = ("masterCategory", "articleType", "season", "usage", "baseColour")
HLL_BITS = 14        # distinct counts within about 1 % (one standard error: 0.8 / 2 ** (bits / 2))
TRACKED = 10_000     # values that a frequency sketch of one column follows


def profile_sketches(df: DataFrame, columns=PROFILE_COLUMNS) -> DataFrame:
    """One row per column of a batch: ``column, rows, present`` and mergeable sketches of its values (``distinct``: HLL,
    ``frequent``: heavy hitters).  Sketches of batches are stored and merged later; no batch is read twice."""
    present = [c for c in columns if c in df.columns]
    tall = df.select(F.explode(F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("value")) for c in present])).alias("x")).select("x.*")
    return tall.groupBy("column").agg(F.count(F.lit(1)).alias("rows"), F.count("value").alias("present"),
                                      F.hll_sketch_agg("value", HLL_BITS).alias("distinct"),
                                      F.expr(f"approx_top_k_accumulate(value, {TRACKED}) FILTER (WHERE value IS NOT NULL)").alias("frequent"))


def merged_profile(sketches: DataFrame, top: int = config.TOP_ARTICLE_TYPES) -> DataFrame:
    """Totals over the sketches of many batches (A2-A6): ``column, rows, present, distinct, top`` with ``top`` an array of
    ``(item, count)``.  Distinct counts are within the HLL's error; counts are exact while a column has at most
    ``TRACKED`` values, beyond that they are estimates (``scalars`` and ``frequency`` stay exact)."""
    return sketches.groupBy("column").agg(
        F.sum("rows").alias("rows"), F.sum("present").alias("present"), F.hll_sketch_estimate(F.hll_union_agg("distinct")).alias("distinct"),
        F.expr(f"approx_top_k_estimate(approx_top_k_combine(frequent, {TRACKED}), {top})").alias("top"))
