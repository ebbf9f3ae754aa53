"""Pivot-pruned joins equal the plain block joins; bounds hold; clustered data is mostly skipped."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from vitrine.operators import blocks, pivots


def frame(spark, x, ids=None):
    ids = range(len(x)) if ids is None else ids
    return spark.createDataFrame([(int(i), [float(v) for v in r]) for i, r in zip(ids, x)], "id BIGINT, embedding ARRAY<DOUBLE>")


def clustered(seed=3, clusters=30, each=60, dim=16, spread=0.03, hot=300):
    rng = np.random.default_rng(seed)
    centre = rng.standard_normal((clusters, dim))
    x = np.repeat(centre / np.linalg.norm(centre, axis=1)[:, None], each, axis=0) + spread * rng.standard_normal((clusters * each, dim))
    x = np.vstack([x, np.repeat(x[:1], hot, axis=0)])  # one row repeated: a seventh of all
    return x / np.linalg.norm(x, axis=1)[:, None]


@pytest.mark.parametrize("kind", ["clustered", "isotropic", "norms"])
def test_pairs_equal_the_plain_join(spark, kind):
    x = clustered()
    if kind != "clustered":
        x = np.random.default_rng(1).standard_normal((400, 12))
        x = x / np.linalg.norm(x, axis=1)[:, None] * (np.random.default_rng(2).uniform(0, 3, (400, 1)) if kind == "norms" else 1)
        x[7] = 0 if kind == "norms" else x[7]
    t = 0.9 if kind != "isotropic" else 0.5
    df, report = frame(spark, x), {}
    got = {(r.id_a, r.id_b): r.sim for r in pivots.pruned_pairs(df, t, block_rows=40, report=report).collect()}
    s = x @ x.T
    a, b = np.nonzero(np.triu(s >= t, 1))
    sure = {(i, j) for i, j in zip(a.tolist(), b.tolist())}
    assert set(got) == sure and all(abs(got[k] - s[k]) < 1e-12 for k in got)
    if kind == "clustered":
        assert report["share"] < 0.2 and report["block_pairs"] > 200


@pytest.mark.parametrize("kind,exclude", [("clustered", True), ("clustered", False), ("isotropic", True)])
def test_topk_equals_the_plain_join(spark, kind, exclude):
    x = clustered() if kind == "clustered" else np.random.default_rng(4).standard_normal((300, 10))
    x = np.vstack([x, np.zeros((1, x.shape[1]))])
    df, report = frame(spark, x), {}
    got = sorted((r.l_id, r["rank"], r.r_id) for r in pivots.pruned_topk(df, df, 5, exclude_self=exclude, block_rows=60, report=report).collect())
    want = sorted((r.l_id, r["rank"], r.r_id) for r in blocks.topk_join(df, df, 5, exclude_self=exclude).collect())
    if kind == "isotropic":
        assert got == want
    else:  # (scores of repeated rows differ in the last digit with the shape of the product, so their ids may)
        s = x @ x.T
        assert len(got) == len(want)
        assert max(abs(s[g[0], g[2]] - s[w[0], w[2]]) for g, w in zip(got, want)) < 1e-12
        assert report["share"] < 0.5


def test_other_left_side_and_few_rows(spark):
    x = clustered(hot=0)
    right, left = frame(spark, x), frame(spark, x[::50] + 0.01, [5000 + i for i in range(len(x[::50]))])
    got = sorted((r.l_id, r["rank"], r.r_id) for r in pivots.pruned_topk(left, right, 3, block_rows=50).collect())
    assert got == sorted((r.l_id, r["rank"], r.r_id) for r in blocks.topk_join(left, right, 3).collect())
    two = frame(spark, x[:2])
    assert sorted((r.l_id, r.r_id) for r in pivots.pruned_topk(two, two, 5).collect()) == [(0, 0), (0, 1), (1, 0), (1, 1)]
    none = two.where("id < 0")
    assert pivots.pruned_pairs(none, 0.5).collect() == [] and pivots.pruned_topk(none, none, 3).collect() == []
    zero = frame(spark, np.zeros((3, 4)))
    assert pivots.pruned_topk(zero, zero, 2).count() == 6


def test_bounds_hold():
    rng = np.random.default_rng(8)
    pivot = rng.standard_normal((5, 6))
    pivot /= np.linalg.norm(pivot, axis=1)[:, None]
    for _ in range(200):
        sides = [rng.standard_normal((rng.integers(1, 5), 6)) * rng.uniform(0, 2) + rng.standard_normal(6) * rng.uniform(0, 4) for _ in range(2)]
        made = []
        for x in sides:
            angle, norm = pivots._angles(x, pivot)
            made.append({"low": angle.min(0)[None], "high": angle.max(0)[None], "norm_low": norm.min()[None], "norm_high": norm.max()[None]})
        assert pivots.upper_bounds(*made)[0, 0] >= (sides[0] @ sides[1].T).max() - 1e-9


def test_hot_rows_make_bounded_blocks(spark):
    x = np.repeat(np.eye(4), [500, 20, 20, 20], axis=0)
    df = frame(spark, x)
    _, sums = pivots.pivot_blocks(df, np.eye(4), "id", "embedding", 50)
    sizes = [r.n for r in sums.collect()]
    assert sum(sizes) == 560 and max(sizes) < 100
    assert df.where(F.size("embedding") == 4).count() == 560
