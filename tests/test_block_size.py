"""Similarity joins move few large blocks and score them in small tiles; results equal brute force over tile borders."""

import tracemalloc

import numpy as np
import pyarrow as pa
import pytest

from vitrine.operators import blocks


def unit(n, dim, seed=5):
    x = np.random.default_rng(seed).standard_normal((n, dim))
    return x / np.linalg.norm(x, axis=1)[:, None]


def batch(l_ids, left, r_ids, right, same):
    return pa.RecordBatch.from_arrays([pa.array([l_ids.tolist()]), pa.array([left.ravel()]), pa.array([r_ids.tolist()]), pa.array([right.ravel()]), pa.array([same])],
                                      names=["l_ids", "l_vecs", "r_ids", "r_vecs", "_same"])


def peak_mb(kernel, b):
    tracemalloc.start()
    out = pa.Table.from_batches(list(kernel([b])))
    peak = tracemalloc.get_traced_memory()[1] / 1e6
    tracemalloc.stop()
    return out.to_pydict(), peak


def test_kernels_hold_tiles_and_equal_brute_force():
    x, ids = unit(5000, 16), np.arange(5000) * 3
    b, s = batch(ids, x, ids, x, True), None
    top, mb = peak_mb(blocks._topk_kernel(3, True, False, [], 1.0), b)
    assert mb < 100  # (all scores: 200 MB)
    pairs, mb = peak_mb(blocks._pair_kernel(0.8), b)
    assert mb < 100
    links, mb = peak_mb(blocks._forest_kernel(0.8), b)
    assert mb < 100
    s = x @ x.T
    np.fill_diagonal(s, -np.inf)
    want = np.argsort(-s, axis=1, kind="stable")[:, :3]
    got = {}
    for i, j in zip(top["l_id"], top["r_id"]):
        got.setdefault(i // 3, set()).add(j // 3)
    assert all(got[i] == set(want[i].tolist()) for i in range(5000))
    a, c = np.nonzero(np.triu(s >= 0.8, 1))
    sure = set(zip((a * 3).tolist(), (c * 3).tolist()))
    assert set(zip(pairs["id_a"], pairs["id_b"])) == sure and len(pairs["id_a"]) == len(sure) > 100
    low = np.arange(5000)
    while True:
        new = low.copy()
        np.minimum.at(new, a, low[c]), np.minimum.at(new, c, low[a])
        if (new == low).all():
            break
        low = new
    assert dict(zip(links["id_b"], links["id_a"])) == {3 * i: 3 * int(low[i]) for i in range(5000) if low[i] != i}


def test_ties_over_tile_borders_go_to_the_smaller_id():
    right = np.repeat(np.eye(2), 3000, axis=0)
    found = [np.concatenate(c) for c in zip(*blocks.topk_rows(np.eye(2), right, 4, lambda raw, a, b: raw.copy()))]
    assert found[1].tolist() == [0, 1, 2, 3, 3000, 3001, 3002, 3003]


@pytest.mark.parametrize("join", [lambda d: blocks.threshold_self_join(d, 2.0), lambda d: blocks.topk_join(d, d, 2)])
def test_the_number_of_blocks_follows_the_cores_not_the_rows(spark, join, monkeypatch):
    most = []
    real = blocks._block_count
    monkeypatch.setattr(blocks, "_block_count", lambda n, *a: most.append((a, spark.range(1).select(real(blocks.F.lit(30_000), *a)).first()[0])) or real(n, *a))
    join(spark.range(4).selectExpr("id", "array(1D, 0D) embedding"))
    assert most and all(n <= 8 for _, n in most)  # 30,000 rows: before, 15 blocks of 2,048
