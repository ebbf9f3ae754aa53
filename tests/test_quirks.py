"""Behaviours that are easy to get wrong, on tiny frames."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from vitrine import config
from vitrine.functions import text as ft
from vitrine.functions.encoder import hashed_text_vector
from vitrine.functions.vectors import l2_normalize
from vitrine.operators import clean as cl
from vitrine.operators import dedup as dd
from vitrine.operators import recommend as rec
from vitrine.operators import rules as rl
from vitrine.operators import search as srch

CAT_SCHEMA = ("id BIGINT, productDisplayName STRING, articleType STRING, masterCategory STRING, subCategory STRING, "
              "baseColour STRING, usage STRING, brand STRING, image_path STRING, embedding ARRAY<DOUBLE>")


def _cat(spark, rows):
    return spark.createDataFrame(rows, CAT_SCHEMA)


def _row(i, name, typ, mc, vec, usage="Casual"):
    return (i, name, typ, mc, "sub", "Blue", usage, "B", f"images/{i}.jpg", vec)


def test_q4_rule_resolution_order(spark):
    types = spark.createDataFrame([("tshirts",), ("capris",), ("",), ("flats",), ("jeans",), ("sports shoes",)], "type_lower STRING")
    got = {r.type_lower: (r.rule_key, r.branch) for r in rl.resolve_types(types, rl.rule_table(spark)).collect()}
    assert got["tshirts"] == ("shirts", "partial")      # not t-shirts
    assert got["capris"] == ("cap", "partial")
    assert got[""] == ("shoes", "partial")              # first rule
    assert got["flats"] == (None, "default")
    assert got["jeans"] == ("jeans", "exact")
    assert got["sports shoes"] == ("sports shoes", "exact")  # exact beats the earlier partial "shoes"


def test_q5_accessories_recommends_itself(spark):
    e = [1.0, 0.0, 0.0]
    c = _cat(spark, [_row(1, "a", "Accessories", "Accessories", e), _row(2, "b", "Accessories", "Accessories", [0.0, 1.0, 0.0]),
                     _row(3, "c", "Watches", "Accessories", [0.6, 0.8, 0.0])])
    r = rec.recommend(c, spark.createDataFrame([(1,)], "id BIGINT")).orderBy("rank").collect()
    assert r[0].product_id == 1 and r[0].score == 1.0 and r[0].rank == 1
    # negatives/zero clip to 0 and keep the bonuses: product 2 = 0 + 0.02 + 0.01
    assert [x.product_id for x in r] == [1, 3, 2]
    assert r[2].score == pytest.approx(0.03)


def test_q6_fallback_only_without_candidate_rows(spark):
    # sarees targets (blouses, flats, ...) absent -> fallback to other master categories
    c = _cat(spark, [_row(1, "s", "Sarees", "Apparel", [1.0, 0.0]), _row(2, "w", "Watches", "Accessories", [0.9, 0.1]),
                     _row(3, "x", "Shirts", "Apparel", [1.0, 0.0]), _row(4, "f", "Flats", "Footwear", None)])
    r = rec.recommend(c, spark.createDataFrame([(1,)], "id BIGINT")).collect()
    # a 'flats' row exists (no vector): candidates exist -> rule path, and it has no vector -> empty
    assert r == []
    c2 = c.where(F.col("id") != 4)
    r2 = rec.recommend(c2, spark.createDataFrame([(1,)], "id BIGINT")).orderBy("rank").collect()
    assert [x.product_id for x in r2] == [2] and r2[0].path == "fallback"
    assert r2[0].reason == "Complementary accessory for sarees (embedding similarity)"


def test_q7_and_q2_search_semantics(spark):
    idx = spark.createDataFrame([(i, [float(v) for v in vec]) for i, vec in
                                 [(1, [1, 0]), (2, [-1, 0]), (3, [0.5, 0.5]), (4, [0, 1])]], "id BIGINT, embedding ARRAY<DOUBLE>")
    from vitrine.operators.knn import knn_by_vector
    r = knn_by_vector(idx, [-1.0, 0.0], k=4).orderBy("rank").collect()
    assert [x.product_id for x in r] == [2, 4, 3, 1]        # ranked by raw value
    assert [x.similarity for x in r][-1] == 0.0             # clipped only after ranking


def test_post_filter_can_return_fewer(spark):
    names = [(i, f"red item{i}" if i < 20 else "blue thing", "Shirts", "Apparel" if i in (3, 4) or i >= 30 else "Footwear", None) for i in range(40)]
    c = _cat(spark, [_row(i, n, t, m, v) for i, n, t, m, v in names])
    q = spark.createDataFrame([(1, "red")], "qid BIGINT, query STRING")
    idx = srch.text_index(c)
    post = srch.text_search(q, idx, c, 5, filters={"master_category": "apparel"}, mode="post").collect()
    pre = srch.text_search(q, idx, c, 5, filters={"master_category": "apparel"}, mode="pre").collect()
    assert len(pre) == 5 and [r.product_id for r in sorted(post, key=lambda r: r.rank)] == [3, 4]
    with pytest.raises(ValueError):
        srch.filter_predicate({"masterCategory": "x"})


def test_q8_clean_strings_and_ids(spark):
    raw = spark.createDataFrame([
        (0, "12.7", " Shirts ", "A", "s", "c", "Summer", "2012", "Casual", "   ", None),
        (1, "x3", "Shirts", "A", "s", "c", "Summer", "2012", "Casual", "n", "b"),
        (2, "12", "Jeans", "A", "s", "c", "Summer", "2012", "Casual", "later", "b"),
        (3, "7", "Jeans", "A", "s", "c", "Summer", "2012", "NA", "n", "b"),
        (4, "8", "Jeans ", "A", "s", "c", "Summer", "2012", "Casual", "n", "b"),
    ], "src_pos BIGINT, id STRING, articleType STRING, masterCategory STRING, subCategory STRING, baseColour STRING, "
       "season STRING, year STRING, usage STRING, productDisplayName STRING, brand STRING")
    got = {r.id: r for r in cl.clean(raw).collect()}
    assert set(got) == {12, 8}                       # x3 unparsable, NA usage null -> dropped, dup 12 keeps first
    assert got[12].productDisplayName == "" and got[12].articleType == "Shirts" and got[12].brand == "Unknown"
    assert got[8].articleType == "Jeans"             # NBSP stripped like str.strip


def test_q1_gram_mean_identity(spark):
    rng = np.random.default_rng(0)
    E = rng.normal(size=(5, 8))
    E /= np.linalg.norm(E, axis=1, keepdims=True)
    vecs = spark.createDataFrame([(i, [float(x) for x in E[i]]) for i in range(5)], "id BIGINT, embedding ARRAY<DOUBLE>")
    members = spark.createDataFrame([(0, i) for i in range(5)], "component BIGINT, id BIGINT")
    got = dd.avg_similarity(members, vecs).first().avg_similarity
    assert got == pytest.approx(float(np.mean(E @ E.T)), abs=1e-12)


def test_q10_zero_vectors_and_representative(spark):
    e = [1.0, 0.0]
    rows = [(1, "a", "T", "M", "s", "c", "u", "b", "p1", e, 10), (2, "b", "T", "M", "s", "c", "u", "b", "p2", [0.99, 0.141], 30),
            (3, "c", "T", "M", "s", "c", "u", "b", "p3", [0.0, 0.0], 99), (4, "d", "T", "M", "s", "c", "u", "b", "p4", [0.995, 0.0998], 30)]
    c = spark.createDataFrame(rows, CAT_SCHEMA + ", image_bytes BIGINT")
    out = dd.deduplicate(c, 0.9)
    cl_ = out["clusters"].collect()
    assert len(cl_) == 1 and cl_[0].size == 3
    assert cl_[0].representative_id == 2             # largest image, first wins the 30/30 tie
    assert {r.id for r in out["unique"].collect()} == {2, 3}
    s = out["summary"].first()
    assert (s.total_products, s.duplicate_clusters, s.products_in_clusters, s.unique_products) == (4, 1, 3, 2)
    with pytest.raises(ValueError):
        dd.duplicate_pairs(c.select("id", "embedding"), 0.0)


def test_scalar_functions(spark):
    df = spark.createDataFrame([("t-shirts", 0.873, "abcdefghijklmnop")], "t STRING, x DOUBLE, s STRING")
    r = df.select(ft.title_case("t").alias("t"), ft.format_score("x").alias("p"), ft.truncate("s", 5).alias("s"),
                  ft.score_band("x").alias("b")).first()
    assert (r.t, r.p, r.s, r.b) == ("T-Shirts", "87.3%", "abcd…", "green")
    v = df.select(hashed_text_vector(F.lit("Red  ring")).alias("v"), l2_normalize(F.array(F.lit(0.0), F.lit(0.0))).alias("z")).first()
    assert abs(sum(x * x for x in v.v) - 1.0) < 1e-12 and v.z == [0.0, 0.0]
    assert config.COMPLEMENTARY_RULES[0][0] == "shoes" and len(config.COMPLEMENTARY_RULES) == 39
