"""Complementary-product recommendation (J9-J13, A17), batch form.

For every source product with a vector:
  1. resolve its type's target types (J8, on distinct types);
  2. candidates = catalog rows whose type is a target (an equi-join on
     type, never a product-level cross join);
  3. if *no catalog row at all* has a target type, fall back to every
     product of another master category (J12);
  4. score = min(clip(cos, 0, 1) + 0.02 [same master category]
     + 0.01 [same usage], 1); candidates without a vector are skipped;
     the source itself is not excluded on the rule path;
  5. top-k by (score desc, candidate position asc).

Scoring runs in the blocked kernel grouped by (source type -> target
type) or (source master category -> other master category), so a hot
type is split into bounded blocks instead of one huge group.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import config
from ..functions.text import fallback_reason, or_unknown, rule_reason, strip
from .blocks import topk_join
from .rules import resolve_types, rule_table, type_key

OUT_COLS = ("source_id", "rank", "product_id", "image_path", "product_name", "article_type", "master_category",
            "base_colour", "brand", "reason", "score", "path")


def _prepare(catalog: DataFrame) -> DataFrame:
    return (catalog.withColumn("type_lower", type_key("articleType"))
                   .withColumn("mc_code", F.coalesce(F.xxhash64("masterCategory"), F.lit(-1)))
                   .withColumn("us_code", F.coalesce(F.xxhash64("usage"), F.lit(-1))))


def _cand_codes(df: DataFrame) -> DataFrame:
    # Candidates carry different null sentinels so a null never equals a null.
    return (df.withColumn("mc_code", F.when(F.col("masterCategory").isNull(), F.lit(-2)).otherwise(F.col("mc_code")))
              .withColumn("us_code", F.when(F.col("usage").isNull(), F.lit(-2)).otherwise(F.col("us_code"))))


_NULL = "\x1e"   # stands for a null category inside group keys (never occurs in labels)


def recommend(catalog: DataFrame, sources: DataFrame | None = None, top_k: int = config.TOP_K_RECOMMENDATIONS,
              rules: DataFrame | None = None, exclude_self: bool = False, path: str | None = None) -> DataFrame:
    """Recommendations for ``sources`` (ids; default: every product), on both
    paths or only on ``path`` ("rule" or "fallback").

    ``catalog`` needs id, articleType, masterCategory, usage, embedding and
    the display columns.  Sources without a vector produce no rows.

    Both paths run in one grouped kernel call.  Candidates are packed under
    two keys, ``T:<type>`` and ``M:<master category>``; rule-path sources
    (key ``T:<own type>``) meet the live target types, fallback sources (key
    ``M:<own category>``) meet every other category (a null category differs
    from everything, as in the reference).  The pair map therefore has at
    most (rule edges + categories^2) rows, whatever the catalog size.
    """
    spark = catalog.sparkSession
    rules = rules if rules is not None else rule_table(spark)
    meta = _prepare(catalog)
    with_vec = meta.where(F.col("embedding").isNotNull())

    types = meta.select("type_lower").distinct()
    resolved = resolve_types(types, rules)
    edges = resolved.select(F.col("type_lower").alias("lt"), F.explode(F.array_distinct("targets")).alias("rt"))
    live = edges.join(types.select(F.col("type_lower").alias("rt")), "rt", "left_semi")  # targets present in the catalog
    has_cand = live.select(F.col("lt").alias("type_lower")).distinct().withColumn("rule_path", F.lit(1))

    mc_key = F.coalesce(F.col("masterCategory"), F.lit(_NULL))
    src = with_vec if sources is None else with_vec.join(sources.select("id").distinct(), "id", "left_semi")
    src = (src.join(has_cand, "type_lower", "left")
              .withColumn("rule_path", F.coalesce(F.col("rule_path"), F.lit(0)))
              .withColumn("fb_self", (1 - F.col("rule_path")) if not exclude_self else F.lit(1))
              .withColumn("gkey", F.when(F.col("rule_path") == 1, F.concat(F.lit("T:"), F.col("type_lower")))
                                   .otherwise(F.concat(F.lit("M:"), mc_key))))
    if path is not None:
        src = src.where(F.col("rule_path") == (1 if path == "rule" else 0))
    cand = _cand_codes(with_vec)
    cand = (cand.withColumn("gkey", F.concat(F.lit("T:"), F.col("type_lower")))
                .unionByName(cand.withColumn("gkey", F.concat(F.lit("M:"), mc_key))))

    rule_pairs = live.select(F.concat(F.lit("T:"), F.col("lt")).alias("lg"), F.concat(F.lit("T:"), F.col("rt")).alias("rg"))
    # Category vocabulary (a handful of values) as one scalar array.
    mcs = with_vec.select(mc_key.alias("mc"), F.col("masterCategory").alias("raw_mc")).distinct()
    vocab = mcs.agg(F.collect_list(F.struct("mc", "raw_mc"))).scalar()
    fb_pairs = (src.where(F.col("rule_path") == 0).select(mc_key.alias("lmc"), F.col("masterCategory").alias("raw_lmc"))
                   .distinct().select("lmc", "raw_lmc", F.explode(vocab).alias("c"))
                   .where(F.coalesce(F.col("c.raw_mc") != F.col("raw_lmc"), F.lit(True)))
                   .select(F.concat(F.lit("M:"), F.col("lmc")).alias("lg"), F.concat(F.lit("M:"), F.col("c.mc")).alias("rg")))
    pairs = rule_pairs.unionByName(fb_pairs)
    if sources is not None or path is not None:
        # Only some sources: pack only the candidate groups that one of them meets.
        pairs = pairs.join(src.select(F.col("gkey").alias("lg")).distinct(), "lg", "left_semi")
        cand = cand.join(pairs.select(F.col("rg").alias("gkey")).distinct(), "gkey", "left_semi")

    bonus = [("mc_code", "mc_code", config.BONUS_SAME_MASTER_CATEGORY),
             ("us_code", "us_code", config.BONUS_SAME_USAGE)]
    hits = topk_join(src, cand, top_k, left_group=F.col("gkey"), right_group=F.col("gkey"),
                     group_pairs=pairs, bonus=bonus, clip_bonus=True, cap=config.SCORE_CAP, exclude_self="fb_self")
    shown = [
        F.coalesce(F.col("image_path").cast("string"), F.lit("")).alias("image_path"),
        or_unknown("productDisplayName").alias("product_name"), or_unknown("articleType").alias("article_type"),
        or_unknown("masterCategory").alias("master_category"), or_unknown("baseColour").alias("base_colour"),
        or_unknown("brand").alias("brand")]
    hits = (hits.join(src.select(F.col("id").alias("l_id"), F.col("type_lower").alias("s_type"), "rule_path"), "l_id")
                .join(meta.select(F.col("id").alias("r_id"), F.col("type_lower").alias("c_type"), *shown), "r_id")
                .withColumn("reason", F.when(F.col("rule_path") == 1, rule_reason(F.col("s_type"), F.col("c_type")))
                                        .otherwise(fallback_reason(F.col("s_type"))))
                .withColumn("path", F.when(F.col("rule_path") == 1, "rule").otherwise("fallback")))
    return hits.select(F.col("l_id").alias("source_id"), F.col("rank").cast("bigint").alias("rank"),
                      F.col("r_id").alias("product_id"), "image_path", "product_name", "article_type",
                      "master_category", "base_colour", "brand", "reason", "score", "path")


def product_by_name(catalog: DataFrame, name: str) -> DataFrame:
    """First product (lowest position) whose lower-cased name contains the
    lower-cased, stripped text (P16), as a one-row ``(id)`` frame; empty if none."""
    needle = name.lower().strip()
    m = catalog.where(F.contains(F.lower(F.col("productDisplayName")), F.lit(needle)))
    pos = "src_pos" if "src_pos" in catalog.columns else "id"
    return m.agg(F.min_by("id", F.col(pos)).alias("id")).where(F.col("id").isNotNull())


def recommend_by_name(catalog: DataFrame, name: str, top_k: int = config.TOP_K_RECOMMENDATIONS) -> DataFrame:
    return recommend(catalog, product_by_name(catalog, name), top_k)


def confidence(recs: DataFrame) -> DataFrame:
    """Average score per source."""
    return recs.groupBy("source_id").agg(F.count(F.lit(1)).alias("n"), F.avg("score").alias("avg_confidence"))
