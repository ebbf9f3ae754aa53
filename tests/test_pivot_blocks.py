"""Pivot blocks: thin cells share one, and a block travels once to a band in which it has partners."""

import numpy as np
import pyarrow as pa

from vitrine.operators import pivots


def unit(n, dim, seed=5):
    x = np.random.default_rng(seed).standard_normal((n, dim))
    return x / np.linalg.norm(x, axis=1)[:, None]


def test_thin_cells_share_a_block(spark):
    x = unit(3000, 8)
    df = spark.createDataFrame([(i, r.tolist()) for i, r in enumerate(x)], "id BIGINT, embedding ARRAY<DOUBLE>")
    _, sums = pivots.pivot_blocks(df, unit(64, 8, 1), "id", "embedding", 40)
    n = [r.n for r in sums.collect()]
    assert sum(n) == 3000 and len(n) <= 2 * 75 + 64 and max(n) < 100


def test_a_pivot_block_travels_once_to_a_band(spark):
    x = unit(600, 8)
    df = spark.createDataFrame([(i, r.tolist()) for i, r in enumerate(x)], "id BIGINT, embedding ARRAY<DOUBLE>")
    got = {(r.id_a, r.id_b) for r in pivots.pruned_pairs(df, 0.6, block_rows=10).collect()}
    a, b = np.nonzero(np.triu(x @ x.T >= 0.6, 1))
    assert got == set(zip(a.tolist(), b.tolist()))
    moved = []

    def kernel(block, ids, rows, partners):
        moved.append(len(partners))
        yield pa.RecordBatch.from_arrays([pa.array([block]), pa.array([len(partners)])], names=["block", "n"])
    blocks_, sums = pivots.pivot_blocks(df, unit(8, 8, 1), "id", "embedding", 10)
    n = sums.count()
    s = sums.select("block")
    pairs = s.withColumnRenamed("block", "x").crossJoin(s.withColumnRenamed("block", "y"))
    rows = pivots._met(pairs, blocks_, blocks_, (3, 4), kernel, "block BIGINT, n BIGINT").collect()
    assert len(rows) <= 4 * n and sum(r.n for r in rows) == n * n
