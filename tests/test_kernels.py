"""Block kernels and components against brute force on small random data."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from vitrine.operators.blocks import threshold_self_join, topk_join
from vitrine.operators.components import connected_components


def _frame(spark, ids, vecs, **extra):
    rows = [(int(i), [float(x) for x in v], *[int(e[j]) for e in extra.values()]) for j, (i, v) in enumerate(zip(ids, vecs))]
    schema = "id BIGINT, embedding ARRAY<DOUBLE>" + "".join(f", {k} BIGINT" for k in extra)
    return spark.createDataFrame(rows, schema)


def _brute_topk(lid, L, rid, R, k, exclude_self=False, bonus=None):
    S = L @ R.T
    out = {}
    for i, a in enumerate(lid):
        sc = S[i].copy()
        if bonus is not None:
            sc = np.minimum(np.clip(sc, 0, 1) + bonus[i], 1.0)
        order = sorted(range(len(rid)), key=lambda j: (-sc[j], rid[j]))
        order = [j for j in order if not (exclude_self and rid[j] == a)][:k]
        out[int(a)] = [int(rid[j]) for j in order]
    return out


@pytest.mark.parametrize("block_rows", [7, 64, 4096])
def test_topk_matches_brute_force_with_ties(spark, block_rows):
    rng = np.random.default_rng(3)
    n = 150
    V = rng.integers(-2, 3, size=(n, 4)).astype(float)  # many exact ties
    ids = rng.permutation(10_000)[:n]
    df = _frame(spark, ids, V)
    got = topk_join(df, df, 5, exclude_self=True, block_rows=block_rows).toPandas()
    want = _brute_topk(ids, V, ids, V, 5, exclude_self=True)
    for a, rows in got.groupby("l_id"):
        assert list(rows.sort_values("rank")["r_id"]) == want[a]
    assert set(got["l_id"]) == set(int(i) for i in ids)


def test_topk_bonus_and_groups(spark):
    rng = np.random.default_rng(5)
    n = 120
    V = rng.normal(size=(n, 6))
    V /= np.linalg.norm(V, axis=1, keepdims=True)
    ids = np.arange(n)
    grp = ids % 3
    mc = ids % 2
    df = _frame(spark, ids, V, grp=grp, mc=mc)
    pairs = spark.createDataFrame([(0, 1), (0, 2), (1, 0), (2, 2)], "lg BIGINT, rg BIGINT")
    got = topk_join(df, df, 4, left_group=F.col("grp"), right_group=F.col("grp"), group_pairs=pairs,
                    bonus=[("mc", "mc", 0.02)], clip_bonus=True, block_rows=16).toPandas()
    meet = {0: {1, 2}, 1: {0}, 2: {2}}
    for a in ids:
        cand = np.array([j for j in ids if grp[j] in meet[grp[a]]])
        b = np.where(mc[cand] == mc[a], 0.02, 0.0)[None, :]
        want = _brute_topk(np.array([a]), V[[a]], cand, V[cand], 4, bonus=b)[int(a)]
        rows = got[got.l_id == a].sort_values("rank")
        assert list(rows["r_id"]) == want


@pytest.mark.parametrize("block_rows", [10, 1000])
def test_threshold_join_matches_brute_force(spark, block_rows):
    rng = np.random.default_rng(11)
    n = 200
    V = rng.normal(size=(n, 5))
    V /= np.linalg.norm(V, axis=1, keepdims=True)
    ids = rng.permutation(100_000)[:n]
    df = _frame(spark, ids, V)
    got = {(r.id_a, r.id_b) for r in threshold_self_join(df, 0.8, block_rows=block_rows).collect()}
    S = V @ V.T
    want = {(int(min(ids[i], ids[j])), int(max(ids[i], ids[j])))
            for i in range(n) for j in range(i + 1, n) if S[i, j] >= 0.8}
    assert got == want


def _union_find(edges):
    parent = {}

    def find(x):
        parent.setdefault(x, x)
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x
    for a, b in edges:
        ra, rb = find(a), find(b)
        if ra != rb:
            parent[max(ra, rb)] = min(ra, rb)
    return {x: find(x) for x in list(parent)}


@pytest.mark.parametrize("seed", [1, 2])
def test_components_match_union_find(spark, seed):
    rng = np.random.default_rng(seed)
    # a long chain (deep), a star (hub) and random sparse edges
    edges = [(i, i + 1) for i in range(100, 160)] + [(500, j) for j in range(501, 540)]
    edges += [tuple(int(x) for x in rng.integers(0, 300, 2)) for _ in range(120)]
    edges = [(a, b) for a, b in edges if a != b]
    df = spark.createDataFrame(edges, "id_a BIGINT, id_b BIGINT")
    got = {r.id: r.component for r in connected_components(df).collect()}
    want = _union_find(edges)
    # union-find root is the minimum here (we always attach to the smaller root)
    assert got == {k: min(n for n in want if want[n] == v) for k, v in want.items()}


def test_ordinal_matches_global_order(spark):
    from vitrine.operators.ordinal import ordinal
    rng = np.random.default_rng(9)
    keys = rng.permutation(5000)[:997]
    df = spark.createDataFrame([(int(k),) for k in keys], "k BIGINT")
    got = {r.k: r.ordinal for r in ordinal(df, "k", partitions=7).collect()}
    assert got == {int(k): i for i, k in enumerate(sorted(int(x) for x in keys))}


def test_ordinal_is_dense_beyond_a_million_rows(spark):
    from vitrine.operators.ordinal import ordinal
    df = spark.range(1_500_000).select(F.xxhash64("id").alias("k"), F.col("id").alias("v"), F.lit("text").alias("t"))
    out = ordinal(df, "k")
    r = out.agg(F.count(F.lit(1)).alias("n"), F.count_distinct("ordinal").alias("d"), F.min("ordinal").alias("a"), F.max("ordinal").alias("b")).first()
    assert tuple(r) == (1_500_000, 1_500_000, 0, 1_499_999)
    some = out.where("ordinal between 700000 and 700999").orderBy("ordinal").collect()
    assert [x.k for x in some] == sorted(x.k for x in some)


def test_identical_vectors_give_one_link_each(spark):
    from vitrine.operators import dedup as dd
    v = spark.range(20_000).select("id", F.array(F.lit(0.6), F.lit(0.8)).alias("embedding")).unionByName(
        spark.createDataFrame([(30_000, [1.0, 0.0]), (30_001, [0.999, 0.0447])], "id BIGINT, embedding ARRAY<DOUBLE>"))
    links = dd.duplicate_links(v, 0.92).collect()
    assert len(links) == 20_000
    from tests.test_kernels import _union_find
    assert len(set(_union_find([(r.id_a, r.id_b) for r in links]).values())) == 2


def test_lsh_pairs_subset_of_exact_with_high_recall(spark, sf):
    from vitrine.operators import dedup as dd
    from vitrine.sources import testdata as td
    vec = td.planted_vectors(spark, sf).select("id", "embedding")
    exact = {(r.id_a, r.id_b) for r in dd.duplicate_pairs(vec, 0.92).collect()}
    approx = {(r.id_a, r.id_b) for r in dd.lsh_pairs(vec, 0.92, recall=0.98).collect()}
    assert approx <= exact
    assert len(approx) >= 0.95 * len(exact)
