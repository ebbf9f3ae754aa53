"""Readers for the supplied parquet tables and the catalog fixtures derived
from them (see FIXTURES.md).

All fixtures are lazy DataFrames over the supplied tables, so their size
grows with the scale factor; the only literal inputs are the 10-row type
map and the 5-row query list, both broadcast (size fixed by construction).
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.vectors import l2_normalize

TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem",
    "events", "documents", "embeddings", "pages", "benchmark", "labels",
    "conversations",
)

# Fixture type map: label -> (articleType, masterCategory, subCategory).
TYPE_MAP = (
    (0, "Shirts", "Apparel", "Topwear"),
    (1, "Jeans", "Apparel", "Bottomwear"),
    (2, "Watches", "Accessories", "Watches"),
    (3, "Sarees", "Apparel", "Saree"),
    (4, "Casual Shoes", "Footwear", "Shoes"),
    (5, "Socks", "Apparel", "Socks"),
    (6, "Tshirts", "Apparel", "Topwear"),
    (7, "Capris", "Apparel", "Bottomwear"),
    (8, "Sunglasses", "Accessories", "Eyewear"),
    (9, "Accessories", "Accessories", "Misc"),
)

# Fixture text queries: (qid, query, relevant baseColour).
FIXTURE_QUERIES = (
    (1, "red ring", "red"),
    (2, "small widget", "small"),
    (3, "hot plate", "hot"),
    (4, "zzz", None),
    (5, " ", None),
)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def type_map(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(
        list(TYPE_MAP), "label INT, articleType STRING, masterCategory STRING, subCategory STRING")


def catalog(spark: SparkSession, sf_dir: str, with_embedding: bool = True) -> DataFrame:
    """Clean product catalog: ``part`` left-joined to ``embeddings``."""
    p = table(spark, sf_dir, "part").alias("p")
    e = table(spark, sf_dir, "embeddings").alias("e")
    t = F.broadcast(type_map(spark)).alias("t")
    j = (p.join(e, F.col("e.vec_id") == F.col("p.p_partkey"), "left")
          .join(t, F.col("t.label") == F.coalesce(F.col("e.label"), (F.col("p.p_partkey") % 10).cast("int"))))
    season = (F.when(F.col("p.p_size") % 4 == 0, "Summer").when(F.col("p.p_size") % 4 == 1, "Fall")
               .when(F.col("p.p_size") % 4 == 2, "Winter").otherwise("Spring"))
    cols = [
        F.col("p.p_partkey").alias("id"),
        F.col("p.p_name").alias("productDisplayName"),
        F.col("t.articleType"), F.col("t.masterCategory"), F.col("t.subCategory"),
        F.split_part(F.col("p.p_name"), F.lit(" "), F.lit(1)).alias("baseColour"),
        F.col("p.p_type").alias("usage"),
        F.col("p.p_brand").alias("brand"),
        season.alias("season"),
        (F.lit(2010) + F.col("p.p_size") % 10).cast("int").alias("year"),
        F.round(F.col("p.p_retailprice") * 100).cast("bigint").alias("image_bytes"),
        F.concat(F.lit("images/"), F.col("p.p_partkey").cast("string"), F.lit(".jpg")).alias("image_path"),
    ]
    if with_embedding:
        cols.append(F.col("e.embedding"))
    return j.select(*cols)


def vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The supplied vector table as ``(id, embedding)``."""
    return table(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("id"), "embedding")


def raw_catalog(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Dirty, all-string input for the cleaning pipeline (FIXTURES 2.2)."""
    c = catalog(spark, sf_dir, with_embedding=False)
    ids = F.col("id").cast("string")
    dirty = c.select(
        (F.col("id") * 2).alias("src_pos"),
        F.when(F.col("id") % 17 == 0, F.concat(F.lit("x"), ids))
         .when(F.col("id") % 19 == 0, F.concat(ids, F.lit(".7"))).otherwise(ids).alias("id"),
        F.when(F.col("id") % 13 == 0, F.lit(None).cast("string"))
         .otherwise(F.concat(F.lit(" "), "articleType", F.lit(" "))).alias("articleType"),
        "masterCategory", "subCategory", "baseColour", "season",
        F.col("year").cast("string").alias("year"),
        F.when(F.col("id") % 23 == 0, F.lit("NA")).otherwise(F.col("usage")).alias("usage"),
        F.when(F.col("id") % 29 == 0, F.lit("   ")).otherwise(F.col("productDisplayName")).alias("productDisplayName"),
        F.when(F.col("id") % 11 == 0, F.lit(None).cast("string")).otherwise(F.col("brand")).alias("brand"),
    )
    dups = c.where(F.col("id") % 10 == 0).select(
        (F.col("id") * 2 + 1).alias("src_pos"), ids.alias("id"), "articleType", "masterCategory",
        "subCategory", F.lit("DUP").alias("baseColour"), "season", F.col("year").cast("string").alias("year"),
        "usage", "productDisplayName", "brand")
    return dirty.unionByName(dups)


def image_inventory(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stand-in for a file listing: ``(id, ext, image_bytes)`` (FIXTURES 2.3)."""
    c = catalog(spark, sf_dir, with_embedding=False).select("id", "image_bytes")
    i = F.col("id")
    parts = [
        c.where((i % 7 != 0) & (i % 5 != 0)).select("id", F.lit(".jpg").alias("ext"), "image_bytes"),
        c.where((i % 7 != 0) & (i % 5 == 0)).select("id", F.lit(".png").alias("ext"), (F.col("image_bytes") + 1).alias("image_bytes")),
        c.where(i % 3 == 0).select("id", F.lit(".webp").alias("ext"), (F.col("image_bytes") + 2).alias("image_bytes")),
        c.where(i % 49 == 0).select("id", F.lit(".JPG").alias("ext"), "image_bytes"),
    ]
    return reduce(DataFrame.unionByName, parts)


def _edit(e: Column, idx: int, delta: float) -> Column:
    return F.transform(e, lambda x, j: F.when(j == idx, x + F.lit(delta)).otherwise(x))


def planted_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Vectors with planted near-copies (FIXTURES 2.4a): ``(id, base_id, copy_no, embedding DOUBLE[])``."""
    v = vectors(spark, sf_dir).select(F.col("id").alias("base_id"),
                                      F.col("embedding").cast("array<double>").alias("e"))
    b = F.col("base_id")
    z = F.transform(F.col("e"), lambda x: F.lit(0.0).cast("double"))
    parts = [
        v.select((b * 4).alias("id"), b, F.lit(0).alias("copy_no"), F.col("e")),
        v.where(b % 10 == 0).select((b * 4 + 1).alias("id"), b, F.lit(1).alias("copy_no"), _edit(F.col("e"), 0, 0.1).alias("e")),
        v.where(b % 20 == 0).select((b * 4 + 2).alias("id"), b, F.lit(2).alias("copy_no"), _edit(F.col("e"), 1, 0.3).alias("e")),
        v.where(b % 100 == 0).select((b * 4 + 3).alias("id"), b, F.lit(3).alias("copy_no"), z.alias("e")),
    ]
    u = reduce(DataFrame.unionByName, parts)
    return u.select("id", "base_id", "copy_no", l2_normalize(F.col("e")).alias("embedding"))


def planted_catalog(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Catalog rows for the planted vectors; copies inherit their base
    product's metadata, with image sizes that make the representative vary."""
    pv = planted_vectors(spark, sf_dir)
    c = catalog(spark, sf_dir, with_embedding=False).drop("image_path")
    j = pv.join(c.withColumnRenamed("id", "base_id"), "base_id")
    size = (F.when(F.col("copy_no") == 1, F.col("image_bytes") - 1)
             .when(F.col("copy_no") == 2, F.col("image_bytes") + 1).otherwise(F.col("image_bytes")))
    return j.select(
        "id", "productDisplayName", "articleType", "masterCategory", "subCategory", "baseColour",
        "usage", "brand", "season", "year", size.alias("image_bytes"),
        F.concat(F.lit("images/"), F.col("id").cast("string"), F.lit(".jpg")).alias("image_path"),
        "embedding")


def fixture_queries(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(list(FIXTURE_QUERIES), "qid BIGINT, query STRING, relevant STRING")


def name_queries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Data-derived query set: every distinct product name, relevant = its colour word."""
    p = table(spark, sf_dir, "part")
    return (p.select(F.col("p_name").alias("query")).where(F.col("query").isNotNull()).distinct()
             .select("query", F.split_part(F.col("query"), F.lit(" "), F.lit(1)).alias("relevant")))
