"""Catalog lookups and choice lists."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import strip


GRAM = 3


def _pos(df: DataFrame) -> str:
    return "src_pos" if "src_pos" in df.columns else "id"


def _grams(text: str, n: Column) -> Column:
    """Distinct substrings of length ``n`` of a column (one empty string for n = 0)."""
    size = F.length(text)
    return F.when(n == 0, F.array(F.lit(""))).when(size < n, F.array().cast("array<string>")).otherwise(
        F.array_distinct(F.transform(F.sequence(F.lit(1), F.greatest(size - n + 1, F.lit(1))), lambda i: F.substring(text, i, n))))


def containing(needles: DataFrame, needle: str, texts: DataFrame, text: str) -> DataFrame:
    """Rows of ``needles`` joined to the rows of ``texts`` whose ``text`` contains ``needle``.

    An equi-join on one substring (of up to ``GRAM`` characters) per needle
    finds the candidates, so neither side has to be small: the substring of
    the needle that the fewest texts hold, by a count over all texts of the
    substrings that needles have.  The containment itself is checked on the
    candidates.  Both sides are joined on distinct values.
    """
    n = F.least(F.length(needle), F.lit(GRAM))
    own = needles.select(needle).distinct().withColumn("_n", n).withColumn("_gram", F.explode(_grams(needle, F.col("_n"))))
    asked = own.select("_n", "_gram").distinct()
    sizes = F.explode(F.array(*[F.lit(i) for i in range(GRAM + 1)]))
    grams = texts.select(text).distinct().select(text, sizes.alias("_n")).withColumn("_gram", F.explode(_grams(text, F.col("_n"))))
    held = grams.join(asked, ["_n", "_gram"], "left_semi").groupBy("_n", "_gram").agg(F.count(F.lit(1)).alias("_texts"))
    # (a substring that no text holds ends its needle's search)
    rarest = F.min_by("_gram", F.struct(F.coalesce("_texts", F.lit(0)).alias("t"), "_gram"))
    wanted = own.join(held, ["_n", "_gram"], "left").groupBy(needle, "_n").agg(rarest.alias("_gram"))
    found = grams.join(wanted, ["_n", "_gram"]).where(F.contains(F.col(text), F.col(needle))).select(needle, text)
    return needles.join(found, needle).join(texts, text)


def products_by_id(catalog: DataFrame, ids: DataFrame) -> DataFrame:
    """Batch id lookup (P10): one catalog row per requested id (first by position)."""
    return catalog.join(ids.select("id").distinct(), "id", "left_semi")


def products_by_type(catalog: DataFrame, article_type: str) -> DataFrame:
    """Case-insensitive article type equality."""
    return catalog.where(F.lower(F.col("articleType")) == F.lit(article_type.lower()))


def product_names(catalog: DataFrame) -> DataFrame:
    """Sorted distinct product names, nulls dropped."""
    return catalog.select(F.col("productDisplayName").alias("name")).where(F.col("name").isNotNull()).distinct().orderBy("name")


def product_ids(catalog: DataFrame) -> DataFrame:
    return catalog.select("id")


def category_choices(catalog: DataFrame) -> DataFrame:
    """"All" followed by the sorted distinct master categories."""
    mc = (catalog.select(F.col("masterCategory").alias("choice")).where(F.col("choice").isNotNull()).distinct()
                 .withColumn("ord", F.lit(1)))
    allrow = catalog.sparkSession.createDataFrame([("All", 0)], "choice STRING, ord INT")
    return allrow.unionByName(mc).orderBy("ord", "choice")


def name_match(catalog: DataFrame, names: DataFrame, query_col: str = "query") -> DataFrame:
    """For each query text: the first product (by position) whose lower-cased
    name contains the lower-cased, stripped text (P16; literal, never regex).

    A query without a match gives no row (``unmatched`` lists them)."""
    pos = _pos(catalog)
    q = names.select(F.col(query_col).alias("q")).distinct().withColumn("needle", F.lower(strip(F.col("q"))))
    c = catalog.select("id", F.col(pos).alias("_pos"), F.lower(F.col("productDisplayName")).alias("lname"),
                       F.col("productDisplayName").alias("pname"))
    first = F.min_by(F.struct("id", "pname"), F.col("_pos")).alias("m")
    m = containing(q.where("needle <> ''"), "needle", c, "lname").groupBy("q").agg(first)
    # An empty text is in every name: the first product of all, found once.
    every = q.where("needle = ''").select("q", c.where("lname IS NOT NULL").agg(first).scalar().alias("m")).where("m.id IS NOT NULL")
    return m.unionByName(every).select(F.col("q").alias(query_col), F.col("m.id").alias("id"), F.col("m.pname").alias("productDisplayName"))


def unmatched(names: DataFrame, matches: DataFrame, query_col: str = "query") -> DataFrame:
    """Queries that matched no product: the batch form of a "not found" error."""
    return names.select(query_col).distinct().join(matches.select(query_col), query_col, "left_anti")


def display_lookup_batch(catalog: DataFrame, names: DataFrame, query_col: str = "query") -> DataFrame:
    """Display row for chosen names (P17): per query, the exact name match
    first, else the first containing match (by position)."""
    pos = _pos(catalog)
    q = names.select(F.col(query_col).alias("q")).distinct()
    c = catalog.select("id", F.col(pos).alias("_pos"), F.col("productDisplayName").alias("pname"))
    m = containing(q, "q", c, "pname")
    pri = F.when(F.col("pname") == F.col("q"), 0).otherwise(1)
    return m.groupBy("q").agg(F.min_by(F.struct("id", "pname"), F.struct(pri, F.col("_pos"))).alias("m")).select(
        F.col("q").alias(query_col), F.col("m.id").alias("id"), F.col("m.pname").alias("productDisplayName"))


def filter_categories(df: DataFrame, category: str | None, col: str = "masterCategory") -> DataFrame:
    """"All" or empty means no filter."""
    if not category or category == "All":
        return df
    return df.where(F.col(col) == F.lit(category))
