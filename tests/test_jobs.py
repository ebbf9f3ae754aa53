"""Composite jobs end to end on the sf0.001 fixtures."""

import tempfile

from pyspark.sql import functions as F

from vitrine.plans import jobs
from vitrine.sources import testdata as td


def test_dedup_job_exports(spark, sf):
    cat = td.planted_catalog(spark, sf)
    out = tempfile.mkdtemp(prefix="vitrine-dedup-")
    res = jobs.deduplicate(cat, 0.92, out_dir=out)
    s = res["summary"].first()
    n_comp = res["pairs"].select("id_a").union(res["pairs"].select("id_b")).distinct().count()
    assert s.duplicate_clusters > 0 and s.products_in_clusters == n_comp
    assert s.unique_products == s.total_products - (s.products_in_clusters - s.duplicate_clusters)
    rep = spark.read.option("header", True).csv(out + "/duplicate_report")
    assert rep.count() == s.products_in_clusters
    uniq = spark.read.option("header", True).csv(out + "/unique_catalog")
    assert uniq.count() == s.unique_products
    assert uniq.columns[:3] == ["id", "productDisplayName", "masterCategory"]


def test_search_and_recommend_jobs(spark, sf):
    cat = td.catalog(spark, sf)
    r = jobs.search(td.fixture_queries(spark), cat, 5, {"master_category": "Apparel"}, "pre")
    assert r["rejected"].count() == 1
    m = {x.qid: x for x in r["metrics"].collect()}
    assert m[1].n_results == 5 and 0 <= m[1].min_similarity <= m[1].max_similarity <= 1
    rec = jobs.recommend(cat, "ring")
    assert rec["confidence"].count() <= 1
    assert rec["display"].where(F.length("reason") > 60).count() == 0


def test_search_table_validation(spark, sf):
    cat = td.catalog(spark, sf).drop("embedding")
    vecs = td.vectors(spark, sf).join(cat.select("id"), "id", "left_semi")
    d = tempfile.mkdtemp(prefix="vitrine-st-")
    t = jobs.build_search_table(cat, vecs, d + "/t")
    assert t.count() == vecs.count()
