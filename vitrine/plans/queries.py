"""Named queries over the supplied tables: one per operator of the survey
inventory.  Every callable takes ``(spark, sf_dir)`` and returns a lazy
DataFrame whose work grows with the input tables."""

from __future__ import annotations

from typing import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import config
from ..functions import encoder as enc
from ..functions import text as ft
from ..functions import vectors as fv
from ..operators import catalog as cat_ops
from ..operators import clean as cl
from ..operators import dedup as dd
from ..operators import knn
from ..operators import profile as prof
from ..operators import recommend as rec
from ..operators import rules as rl
from ..operators import search as srch
from ..operators.components import connected_components
from ..operators.ordinal import ordinal
from ..session import stored
from ..sources import testdata as td

R6 = 6
CHAIN_T = 0.40
PLANT_T = config.DUPLICATE_SIMILARITY_THRESHOLD
NAME_PROBES = (("q1", "ring"), ("q2", " Red "), ("q3", "small widget"), ("q4", "zzz"))


def _catalog(spark, sf):
    return td.catalog(spark, sf)


def _index(spark, sf):
    return _catalog(spark, sf).where(F.col("embedding").isNotNull()).select("id", "embedding")


# ---------------------------------------------------------------- kNN / search
def q_knn_by_product(spark, sf):
    c = _catalog(spark, sf)
    idx = c.where(F.col("embedding").isNotNull()).select("id", "embedding")
    r = knn.knn_by_product(idx, None, 5, c)
    return r.select("source_id", "rank", "product_id", F.round("similarity", R6).alias("similarity"),
                    "product_name", "article_type")


def q_knn_exclude(spark, sf):
    c = _catalog(spark, sf)
    idx = c.where(F.col("embedding").isNotNull()).select("id", "embedding")
    excluded = c.where(F.col("articleType") == "Watches").select("id")
    r = knn.knn_batch(idx.withColumnRenamed("id", "qid"), knn.exclude(idx, excluded), 5, exclude_self=True)
    return r.select(F.col("qid").alias("source_id"), "rank", "product_id", F.round("similarity", R6).alias("similarity"))


def _name_queries(spark, sf):
    return td.name_queries(spark, sf).withColumn("qid", F.xxhash64("query"))


def _name_search(spark, sf):
    c = _catalog(spark, sf)
    return srch.text_search(_name_queries(spark, sf), srch.text_index(c), c, 5)


def q_text_search(spark, sf):
    r = _name_search(spark, sf)
    return r.select("query", "rank", "product_id", F.round("similarity", R6).alias("similarity"), "similarity_pct",
                    "product_name")


def _fixture_search(spark, sf, mode):
    c = _catalog(spark, sf)
    r = srch.text_search(td.fixture_queries(spark), srch.text_index(c), c, 5,
                         filters={"master_category": "apparel"}, mode=mode)
    return r.select("qid", "query", "rank", "product_id", F.round("similarity", R6).alias("similarity"),
                    "master_category")


def q_text_search_post_filter(spark, sf):
    return _fixture_search(spark, sf, "post")


def q_text_search_pre_filter(spark, sf):
    return _fixture_search(spark, sf, "pre")


def q_search_metrics(spark, sf):
    m = srch.search_metrics(_name_queries(spark, sf), _name_search(spark, sf), 5)
    return m.drop("qid")


def q_precision_at_k(spark, sf):
    qs = _name_queries(spark, sf)
    p = srch.precision_at_k(_name_search(spark, sf), qs.select("qid", "relevant"), 5, attr="base_colour")
    return p.join(qs.select("qid", "query"), "qid").select("query", "hits", F.round("precision", R6).alias("precision"))


def q_history_summary(spark, sf):
    ev = td.table(spark, sf, "events").select(F.col("event_type").alias("query"), F.col("value").alias("total_ms"))
    return srch.history_summary(ev, sim_col=None)


def q_history_by_query(spark, sf):
    ev = td.table(spark, sf, "events")
    return ev.groupBy(F.col("event_type").alias("query")).agg(
        F.count(F.lit(1)).alias("total_queries"), F.round(F.avg("value"), 2).alias("avg_latency_ms"),
        F.round(F.max("value"), 2).alias("max_latency_ms"))


def q_text_embed(spark, sf):
    c = _catalog(spark, sf)
    t = fv.vector_tall(srch.text_index(c), "id", "embedding")
    return t.select("id", "dim", F.round("value", R6).alias("value"))


def q_embed_incremental(spark, sf):
    """Rows with no cached vector (catalog anti-join cache) get encoded."""
    c = _catalog(spark, sf).drop("embedding")
    cache = td.vectors(spark, sf)
    todo = c.join(cache.select("id"), "id", "left_anti")
    t = fv.vector_tall(todo.select("id", enc.hashed_text_vector(F.col("productDisplayName")).alias("embedding")),
                       "id", "embedding")
    return t.select("id", "dim", F.round("value", R6).alias("value"))


def _doc_search(spark, sf):
    """Text search over whole documents: every benchmark passage is a query,
    every document (whole text, tall-encoded) is a searchable item."""
    docs = td.table(spark, sf, "documents").select(F.col("doc_id").alias("id"), "text")
    idx = enc.hashed_text_vectors(docs, "id", "text")
    qs = td.table(spark, sf, "benchmark").select(F.col("item_id").alias("id"), "text")
    qv = enc.hashed_text_vectors(qs, "id", "text")
    return knn.knn_batch(qv.withColumnRenamed("id", "qid"), idx, 5)


def q_doc_search(spark, sf):
    r = _doc_search(spark, sf)
    return r.select(F.col("qid").alias("item_id"), "rank", F.col("product_id").alias("doc_id"),
                    F.round("similarity", R6).alias("similarity"))


def q_doc_embed(spark, sf):
    docs = td.table(spark, sf, "documents").select(F.col("doc_id").alias("id"), "text")
    t = fv.vector_tall(enc.hashed_text_vectors(docs, "id", "text"), "id", "embedding")
    return t.select(F.col("id").alias("doc_id"), "dim", F.round("value", R6).alias("value"))


# ---------------------------------------------------------------- vectors
def q_l2_normalize(spark, sf):
    pv = td.planted_vectors(spark, sf)
    t = fv.vector_tall(pv, "id", "embedding", keep_zeros=True)
    return t.select("id", "dim", F.round("value", R6).alias("value"))


def q_vector_validate(spark, sf):
    v = td.vectors(spark, sf)
    part = td.table(spark, sf, "part").select(F.col("p_partkey").alias("id"))
    return fv.validate_vectors(v, part)


def q_zero_fill(spark, sf):
    c = _catalog(spark, sf).drop("embedding")
    z = fv.with_zero_fill(c, td.vectors(spark, sf), config.HASH_DIM)
    return z.select("id", (fv.sq_norm("embedding") > 0).alias("has_vector"), F.round(fv.norm("embedding"), R6).alias("norm"))


# ---------------------------------------------------------------- recommendation
def q_rule_resolution(spark, sf):
    c = _catalog(spark, sf).withColumn("type_lower", rl.type_key("articleType"))
    r = rl.resolve_types(c.select("type_lower"), rl.rule_table(spark))
    return r.select("type_lower", "rule_key", "branch", F.array_join("targets", "|").alias("targets"))


def _recs(spark, sf, sources=None):
    return rec.recommend(_catalog(spark, sf), sources, 5)


def _rec_cols(r):
    return r.select("source_id", "rank", "product_id", F.round("score", R6).alias("score"), "reason", "path",
                    "product_name", "article_type")


def q_recommend_all(spark, sf):
    return _rec_cols(_recs(spark, sf))


def q_recommend_fallback(spark, sf):
    return _rec_cols(rec.recommend(_catalog(spark, sf), None, 5, path="fallback"))


def q_recommend_by_name(spark, sf):
    c = _catalog(spark, sf)
    return _rec_cols(rec.recommend(c, rec.product_by_name(c, "ring"), 5))


def q_recommend_confidence(spark, sf):
    a = rec.confidence(_recs(spark, sf))
    return a.select("source_id", F.col("n").cast("bigint").alias("n"), F.round("avg_confidence", R6).alias("avg_confidence"))


def q_reason_text(spark, sf):
    c = _catalog(spark, sf).withColumn("type_lower", rl.type_key("articleType"))
    r = rl.resolve_types(c.select("type_lower"), rl.rule_table(spark))
    e = r.select("type_lower", F.explode(F.array_distinct("targets")).alias("target"))
    return e.select("type_lower", "target", ft.rule_reason(F.col("type_lower"), F.col("target")).alias("reason"),
                    ft.fallback_reason(F.col("type_lower")).alias("fallback_reason"))


def q_score_band(spark, sf):
    r = _recs(spark, sf)
    return r.select("source_id", "rank", ft.score_band("score").alias("band"), ft.format_score("score").alias("score_pct"))


# ---------------------------------------------------------------- dedup
def _chain(spark, sf):
    c = _catalog(spark, sf)
    vec = c.where(F.col("embedding").isNotNull()).select("id", "embedding")
    return c, vec, CHAIN_T


def _planted(spark, sf):
    c = td.planted_catalog(spark, sf)
    vec = c.select("id", "embedding")
    return c, vec, PLANT_T


def _pairs_cols(p):
    return p.select("id_a", "id_b", F.round("sim", R6).alias("sim"))


def q_dup_pairs_planted(spark, sf):
    _, vec, t = _planted(spark, sf)
    return _pairs_cols(dd.duplicate_pairs(vec, t))


def q_dup_pairs_chain(spark, sf):
    _, vec, t = _chain(spark, sf)
    return _pairs_cols(dd.duplicate_pairs(vec, t))


def q_dup_components(spark, sf):
    _, vec, t = _chain(spark, sf)
    return connected_components(dd.duplicate_links(vec, t))


def _dedup(spark, sf, which):
    c, _, t = _chain(spark, sf) if which == "chain" else _planted(spark, sf)
    c = stored(c, "dedup-catalog")
    vec = c.where(F.col("embedding").isNotNull()).select("id", "embedding")
    members = stored(dd.cluster_members(c, connected_components(dd.duplicate_links(vec, t))), "dedup-members")
    clus = dd.clusters(members, vec)
    return c, members, clus


def _cluster_cols(clus):
    return clus.select("cluster_id", "representative_id", "representative_name", "size",
                       F.round("avg_similarity", 4).alias("avg_similarity"))


def q_dup_clusters(spark, sf):
    return _cluster_cols(_dedup(spark, sf, "chain")[2])


def q_dup_clusters_planted(spark, sf):
    return _cluster_cols(_dedup(spark, sf, "planted")[2])


def q_duplicate_report(spark, sf):
    _, m, clus = _dedup(spark, sf, "planted")
    return dd.duplicate_report(m, clus)


def q_unique_catalog(spark, sf):
    c, m, clus = _dedup(spark, sf, "chain")
    u = dd.unique_catalog(c, m, clus)
    return u.select(*[x for x in config.EXPORT_COLUMNS if x in u.columns])


def q_dedup_summary(spark, sf):
    c, m, clus = _dedup(spark, sf, "chain")
    return dd.summary(c, m, clus, CHAIN_T)


def q_dedup_series(spark, sf):
    c, m, clus = _dedup(spark, sf, "planted")
    return dd.summary_series(dd.summary(c, m, clus, PLANT_T)).select("label", F.col("value").cast("bigint").alias("value"))


def q_cluster_preview(spark, sf):
    _, m, clus = _dedup(spark, sf, "chain")
    return dd.cluster_preview(m, clus)


# ---------------------------------------------------------------- cleaning / catalog
def _clean(spark, sf):
    return cl.clean(td.raw_catalog(spark, sf))


def _images(spark, sf):
    return cl.resolve_images(td.image_inventory(spark, sf))


def _with_images(spark, sf):
    return cl.keep_with_image(_clean(spark, sf), _images(spark, sf))


def q_clean_catalog(spark, sf):
    return _clean(spark, sf).select("id", "src_pos", "articleType", "masterCategory", "subCategory", "baseColour",
                                     "season", "year", "usage", "productDisplayName", "brand")


def q_image_resolve(spark, sf):
    return _images(spark, sf)


def q_catalog_with_images(spark, sf):
    return _with_images(spark, sf).select("id", "productDisplayName", "articleType", "image_path", "image_bytes")


def q_cap_sample(spark, sf):
    return cl.cap_rows(_with_images(spark, sf), 500).select("id", "productDisplayName")


def q_display_sample(spark, sf):
    return cl.display_sample(_with_images(spark, sf))


def q_dq_counters(spark, sf):
    return cl.dq_counters(td.raw_catalog(spark, sf), _images(spark, sf))


def q_products_by_type(spark, sf):
    return cat_ops.products_by_type(_catalog(spark, sf), "shirts").select("id", "productDisplayName", "articleType")


def q_product_names(spark, sf):
    return cat_ops.product_names(_catalog(spark, sf))


def q_category_choices(spark, sf):
    return cat_ops.category_choices(_catalog(spark, sf)).select("choice", F.col("ord").cast("bigint").alias("ord"))


def q_name_match(spark, sf):
    probes = spark.createDataFrame(list(NAME_PROBES), "pid STRING, query STRING")
    m = cat_ops.name_match(_catalog(spark, sf), probes)
    return m.select("query", "id", "productDisplayName")


def q_truncate_name(spark, sf):
    c = _catalog(spark, sf)
    return c.select("id", ft.truncate("productDisplayName", 10).alias("short_name"),
                    ft.prefix("productDisplayName", config.NAME_DISPLAY_CHARS).alias("display_name"),
                    ft.title_case("productDisplayName").alias("title_name"))


def q_label_colour(spark, sf):
    from ..operators.project import label_colours
    return label_colours(_catalog(spark, sf), "articleType")


# ---------------------------------------------------------------- profile
def _final(spark, sf):
    return _with_images(spark, sf)


def q_profile_scalars(spark, sf):
    return prof.scalars(td.raw_catalog(spark, sf), _images(spark, sf))


def q_freq_master_category(spark, sf):
    return prof.master_category_counts(_final(spark, sf))


def q_freq_article_type_top20(spark, sf):
    return prof.article_type_counts(_final(spark, sf))


def q_freq_usage(spark, sf):
    return prof.usage_counts(_final(spark, sf))


def q_freq_colour_top15(spark, sf):
    return prof.colour_counts(_final(spark, sf))


def q_chart_article_types(spark, sf):
    return prof.chart_article_types(_final(spark, sf))


def q_knn_centroid(spark, sf):
    idx = _index(spark, sf)
    r = knn.knn_by_query_frame(knn.centroid(idx), idx, 10)
    return r.select("rank", "product_id", F.round("similarity", R6).alias("similarity"))


def q_knn_by_vector(spark, sf):
    """One query vector (the encoded text "red ring", computed once on the
    driver) against the whole name index: a bounded top-k, no shuffle of rows."""
    c = _catalog(spark, sf)
    qv = enc.embed_text(spark, "red ring")
    r = knn.knn_by_vector(srch.text_index(c), qv, 5, c)
    return r.select("rank", "product_id", F.round("similarity", R6).alias("similarity"), "product_name")


def q_recommend_one(spark, sf):
    """Recommendations for one product: the first product (lowest id) that has a vector."""
    c = _catalog(spark, sf)
    first = c.where(F.col("embedding").isNotNull()).agg(F.min("id").alias("id"))
    return _rec_cols(rec.recommend(c, first, 5))


def q_dup_representatives(spark, sf):
    _, m, clus = _dedup(spark, sf, "planted")
    reps = clus.select("component", "cluster_id", "representative_id")
    return (m.join(reps, "component").where(F.col("id") == F.col("representative_id"))
             .select("cluster_id", "representative_id", F.col("image_bytes").alias("representative_bytes"), "size"))


def q_format_score(spark, sf):
    c = _catalog(spark, sf)
    idx = c.where(F.col("embedding").isNotNull()).select("id", "embedding")
    r = knn.knn_by_product(idx, None, 5)
    return r.select("source_id", "rank", ft.format_score("similarity").alias("similarity_pct"))


def q_vector_by_id(spark, sf):
    """Vector lookup by id (V5) for every part that appears in an order line."""
    ids = td.table(spark, sf, "lineitem").select(F.col("l_partkey").alias("id")).distinct()
    v = td.vectors(spark, sf).join(ids, "id", "left_semi")
    t = fv.vector_tall(v, "id", "embedding", keep_zeros=True)
    return t.select("id", "dim", F.round("value", R6).alias("value"))


def q_product_ids(spark, sf):
    return cat_ops.product_ids(_catalog(spark, sf))


def q_product_by_id(spark, sf):
    """Batch id lookup: catalog rows of every part that appears in an order line."""
    ids = td.table(spark, sf, "lineitem").select(F.col("l_partkey").alias("id"))
    return cat_ops.products_by_id(_catalog(spark, sf), ids).select("id", "productDisplayName")


def q_display_lookup(spark, sf):
    probes = spark.createDataFrame(list(NAME_PROBES) + [("q5", "red ring"), ("q6", "Ring")], "pid STRING, query STRING")
    return cat_ops.display_lookup_batch(_catalog(spark, sf), probes).select("query", "id", "productDisplayName")


def q_rejected_queries(spark, sf):
    """Blank names among the raw catalog rows, taken as search queries."""
    rows = td.raw_catalog(spark, sf).select(F.col("src_pos").alias("qid"), F.col("productDisplayName").alias("query"))
    return srch.split_queries(rows)[1].select("qid", "query")


def q_category_filter(spark, sf):
    """"All" keeps every row, a category its own rows."""
    c = _catalog(spark, sf)
    return cat_ops.filter_categories(c, "All").select(F.lit("All").alias("choice"), "id").unionByName(
        cat_ops.filter_categories(c, "Apparel").select(F.lit("Apparel").alias("choice"), "id"))


def q_name_unmatched(spark, sf):
    """Probe texts that no product name contains: first words of the event types and the name probes."""
    probes = td.table(spark, sf, "events").select(F.col("event_type").alias("query")).distinct().unionByName(
        spark.createDataFrame([(q,) for _, q in NAME_PROBES], "query STRING"))
    return cat_ops.unmatched(probes, cat_ops.name_match(_catalog(spark, sf), probes))


def q_unknown_products(spark, sf):
    """Ordered parts without a vector: the ids that a neighbour lookup cannot answer."""
    ids = td.table(spark, sf, "lineitem").select(F.col("l_partkey").alias("id"))
    return knn.unknown_ids(td.vectors(spark, sf), ids)


def q_ordinal(spark, sf):
    """Dense numbering of every order line in the order of (order, line)."""
    lines = td.table(spark, sf, "lineitem").select((F.col("l_orderkey") * 1000 + F.col("l_linenumber")).alias("line"), "l_partkey")
    return ordinal(lines.groupBy("line").agg(F.min("l_partkey").alias("part")), "line")


def q_pca_variance(spark, sf):
    """Share of variance of the first 50 principal components of all vectors."""
    from ..operators.project import explained_variance
    return explained_variance(td.vectors(spark, sf))


def q_mean_precision(spark, sf):
    qs = _name_queries(spark, sf)
    p = srch.precision_at_k(_name_search(spark, sf), qs.select("qid", "relevant"), 5, attr="base_colour")
    m = srch.mean_precision(p)
    return m.select(F.col("n_queries").cast("bigint").alias("n_queries"), F.round("mean_precision", R6).alias("mean_precision"))


def q_metrics_series(spark, sf):
    m = srch.search_metrics(_name_queries(spark, sf), _name_search(spark, sf), 5)
    return srch.metrics_series(m, None).withColumn("avg_similarity_pct", F.round("avg_similarity_pct", R6))


# ---------------------------------------------------------------- rows-only (no SQL oracle)
def q_lsh_pairs(spark, sf):
    """Pairs by banded hashes at a recall of 0.9999 a pair (the planted pairs lie well above the threshold)."""
    _, vec, _ = _planted(spark, sf)
    return _pairs_cols(dd.lsh_pairs(vec, PLANT_T, recall=0.9999))


def q_lsh_recall(spark, sf):
    """Number of exact pairs, and whether the banded hashes find at least 95 % of them."""
    _, vec, t = _planted(spark, sf)
    exact, found = dd.duplicate_pairs(vec, t).select("id_a", "id_b"), dd.lsh_pairs(vec, t).select("id_a", "id_b", F.lit(1).alias("hit"))
    both = exact.join(found, ["id_a", "id_b"], "left")
    return both.agg(F.count(F.lit(1)).alias("exact_pairs"), (F.count("hit") >= 0.95 * F.count(F.lit(1))).alias("recall_reached"))


def q_pca_projection(spark, sf):
    from ..operators.project import project_embeddings
    return project_embeddings(_catalog(spark, sf))


def q_csv_ingest(spark, sf):
    """Catalog written as CSV to the shared checkpoint folder, read back by the tolerant reader."""
    from .jobs import csv_round_trip
    c = _catalog(spark, sf).drop("embedding")
    back = csv_round_trip(c.select(*[x for x in config.EXPORT_COLUMNS if x in c.columns]))
    return back.select(F.col("id").cast("bigint").alias("id"), *[x for x in config.EXPORT_COLUMNS if x in back.columns and x != "id"])


def q_refresh_changed(spark, sf):
    """Products to encode again when the stored vectors know the names of most, but every seventh has changed."""
    from ..sources.catalog_io import content_hash, vectors_to_refresh
    c = _catalog(spark, sf)
    known = c.where(F.col("embedding").isNotNull()).withColumn(
        "old", F.when(F.col("id") % 7 == 0, F.concat(F.lit("old "), "productDisplayName")).otherwise(F.col("productDisplayName")))
    return vectors_to_refresh(c, known.select("id", content_hash("old").alias("content_hash"))).select("id", "productDisplayName")


def q_stream_history(spark, sf):
    """Structured Streaming over the query log (events): per 1-day event-time
    window and query, count / avg / max latency, watermark 1 hour; run with an
    availableNow trigger into the shared checkpoint folder and read back."""
    from ..streaming import query_log as ql
    log = ql.read_log(spark, f"{sf.rstrip('/')}/events*.parquet")
    ck = ql.checkpoint_location(spark, "history")
    ql.run_upserts(ql.windowed_summary(log, "1 day", "1 hour"), ck + "-sink", ck)
    out = ql.latest(spark, ck + "-sink", ["window", "query"])
    text = "yyyy-MM-dd HH:mm:ss"
    return out.select(F.date_format("window.start", text).alias("window_start"), F.date_format("window.end", text).alias("window_end"), "query",
                      "total_queries", F.round("avg_latency_ms", 2).alias("avg_latency_ms"),
                      F.round("max_latency_ms", 2).alias("max_latency_ms"))


def q_stream_duplicates(spark, sf):
    """New listings (planted vectors: every twentieth product and all copies) streamed against the others."""
    from ..streaming import query_log as ql
    from ..streaming.duplicates import duplicate_check
    v = td.planted_vectors(spark, sf)
    old = (F.col("copy_no") == 0) & (F.col("base_id") % 20 != 0)
    ck = ql.checkpoint_location(spark, "listings")
    v.where(~old).select("id", "embedding").write.parquet(ck + "-incoming")
    incoming = spark.readStream.schema("id BIGINT, embedding ARRAY<DOUBLE>").parquet(ck + "-incoming")
    duplicate_check(incoming, v.where(old).select("id", "embedding"), ck + "-sink", ck, PLANT_T)
    found = spark.read.schema("new_id BIGINT, existing_id BIGINT, similarity DOUBLE").parquet(f"{ck}-sink/epoch=*")
    return found.select("new_id", "existing_id", F.round("similarity", R6).alias("similarity"))


def q_stream_history_state(spark, sf):
    """The query log (events) through the stateful history; similarity stands for a figure of the log (event_id % 100 / 100)."""
    from ..streaming import history, query_log as ql
    log = ql.read_log(spark, f"{sf.rstrip('/')}/events*.parquet").select(
        "ts", F.col("event_type").alias("query"), F.col("value").alias("latency"), ((F.col("event_id") % 100) / 100).alias("similarity"))
    ck = ql.checkpoint_location(spark, "running")
    history.run(spark, history.running_history(log, watermark="1 hour"), ck + "-sink", ck)
    return history.summary(history.by_query(spark, ck + "-sink"), "query")


def q_search_latency(spark, sf):
    """Metrics of a timed batch of queries: similarity, and that every query has its share of the batch's time."""
    c = _catalog(spark, sf)
    _, m = srch.timed_search(_name_queries(spark, sf), srch.text_index(c), c, 5)
    timed = (F.col("total_ms") > 0) & (F.abs(F.col("encode_ms") + F.col("search_ms") - F.col("total_ms")) < 0.01) & (F.col("batch_ms") >= F.col("total_ms"))
    return m.select("query", "n_results", "avg_similarity", timed.alias("timed"))


def q_history_similarity(spark, sf):
    """Summary of a log of searches with its mean similarity."""
    m = srch.search_metrics(_name_queries(spark, sf), _name_search(spark, sf), 5)
    return srch.history_summary(m.withColumn("total_ms", F.lit(0.0)), sim_col="avg_similarity").select("total_queries", "avg_similarity")


def q_projection_sample(spark, sf):
    """The products of a display sample of the projection, with their colours."""
    from ..operators.project import project_embeddings
    return project_embeddings(_catalog(spark, sf), 200).select("id", "label", "colour")


def q_pca_checks(spark, sf):
    """Checks of the principal components on all vectors."""
    from ..operators.project import pca_checks
    return pca_checks(td.vectors(spark, sf), 10).withColumn("total_variance", F.round("total_variance", R6))


def q_profile_merged(spark, sf):
    """Profile of the catalog from stored sketches of three batches."""
    c = _catalog(spark, sf).drop("embedding")
    batches = [stored(prof.profile_sketches(c.where(F.col("id") % 3 == n)), "profile-batch") for n in range(3)]
    merged = prof.merged_profile(batches[0].unionByName(batches[1]).unionByName(batches[2]))
    return merged.select("column", "rows", "present", "distinct", F.col("top")[0]["count"].alias("most"))


def q_dup_pairs_pivots(spark, sf):
    """The pairs of ``dup_pairs_planted``, block pairs skipped by pivots."""
    _, vec, t = _planted(spark, sf)
    return _pairs_cols(dd.duplicate_pairs(vec, t, method="pivots"))


def q_knn_pivots(spark, sf):
    """The neighbours of ``knn_by_product``, block pairs skipped by bounds from pivots."""
    c = _catalog(spark, sf)
    idx = c.where(F.col("embedding").isNotNull()).select("id", "embedding")
    r = knn.knn_by_product(idx, None, 5, c, method="pivots")
    return r.select("source_id", "rank", "product_id", F.round("similarity", R6).alias("similarity"),
                    "product_name", "article_type")


REGISTRY: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    name[2:]: fn for name, fn in sorted(globals().items()) if name.startswith("q_") and callable(fn)
}
