"""Invariance properties: results do not depend on input row
order or partitioning; dedup outputs partition the catalog."""

from pyspark.sql import functions as F

from vitrine.operators import dedup as dd
from vitrine.operators import recommend as rec
from vitrine.sources import testdata as td


def _rows(df, cols):
    return sorted(tuple(r[c] for c in cols) for r in df.select(*cols).collect())


def test_recommend_invariant_to_order_and_partitions(spark, sf):
    cat = td.catalog(spark, sf)
    shuffled = cat.repartition(7).orderBy(F.rand(3))
    cols = ["source_id", "rank", "product_id", "score", "reason"]
    assert _rows(rec.recommend(cat), cols) == _rows(rec.recommend(shuffled), cols)


def test_dedup_partitions_catalog(spark, sf):
    cat = td.planted_catalog(spark, sf)
    res = dd.deduplicate(cat.repartition(5), 0.92)
    members = {r.id for r in res["members"].collect()}
    reps = {r.representative_id for r in res["clusters"].collect()}
    unique = {r.id for r in res["unique"].collect()}
    all_ids = {r.id for r in cat.select("id").collect()}
    assert reps <= members and reps <= unique
    assert unique | (members - reps) == all_ids and not (unique & (members - reps))
    scores = [r.avg_similarity for r in res["clusters"].collect()]
    assert all(0.0 < s <= 1.0 + 1e-9 for s in scores)
    ids = sorted(r.cluster_id for r in res["clusters"].collect())
    assert ids == list(range(len(ids)))


def test_containment_join_matches_brute_force(spark):
    import random
    from vitrine.operators.catalog import containing
    rng = random.Random(6)
    texts = ["".join(rng.choice("abc ") for _ in range(rng.randint(0, 12))) for _ in range(300)] + [None]
    needles = ["", "a", "bc", "abc", "c a", "abca", "zz", "abcabcabcabcabc", None] + [t for t in texts[:40]]
    left = spark.createDataFrame([(x,) for x in needles], "q string").distinct()
    right = spark.createDataFrame(list(enumerate(texts)), "id long, t string")
    got = {(r.q, r.id) for r in containing(left, "q", right, "t").collect()}
    assert got == {(q, i) for q in set(needles) if q is not None for i, t in enumerate(texts) if t is not None and q in t}


def test_spread_only_splits_under_partitioned_inputs(spark):
    from vitrine.session import default_parallelism, spread
    one = spark.range(100).coalesce(1)
    assert spread(one, "id").rdd.getNumPartitions() == default_parallelism(spark)
    many = spark.range(100).repartition(default_parallelism(spark) + 3)
    assert spread(many, "id") is many
