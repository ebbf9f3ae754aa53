"""Buckets of signs get a short form of each vector; no pair is lost or invented by it."""

import inspect

import numpy as np
from pyspark.sql import functions as F

from vitrine.operators import dedup as dd


def test_forms_bound_the_inner_product():
    x = np.random.default_rng(1).standard_normal((200, 24)) * np.random.default_rng(2).uniform(0.01, 5, (200, 1))
    x[3] = 0
    form, norm, off = dd._decoded(np.stack([np.frombuffer(c, np.uint8) for c in dd._codes(x)]))
    spare = norm[:, None] * off[None, :] + off[:, None] * (norm + off)[None, :] + 1e-9
    assert (np.abs(form @ form.T - x @ x.T) <= spare).all() and (off <= 0.01 * np.linalg.norm(x, axis=1) * 24 ** 0.5).all()


def test_pairs_over_the_tiles_of_a_hot_bucket(spark, monkeypatch):
    """One band of one sign: buckets of hundreds of rows, cut into tiles of 64; every pair that shares one is found."""
    monkeypatch.setattr(dd, "LSH_TILE", 64)
    monkeypatch.setattr(dd, "lsh_bands", lambda *a, **k: 1)
    x = np.abs(np.random.default_rng(3).standard_normal((500, 6)))
    x /= np.linalg.norm(x, axis=1)[:, None]
    df = spark.createDataFrame([(i, r.tolist()) for i, r in enumerate(x)], "id BIGINT, embedding ARRAY<DOUBLE>")
    got = {(r.id_a, r.id_b): r.sim for r in dd.lsh_pairs(df, 0.97, bits=1, probes=1).collect()}
    s = x @ x.T
    a, b = np.nonzero(np.triu(s >= 0.97, 1))
    sure = set(zip(a.tolist(), b.tolist()))
    assert set(got) <= sure and all(abs(got[k] - s[k]) < 1e-9 for k in got) and len(got) > 0.8 * len(sure) > 100


def test_no_vector_travels_to_the_buckets(spark):
    df = spark.createDataFrame([(i, [float(i % 7), 1.0, 0.5 * i]) for i in range(50)], "id BIGINT, embedding ARRAY<DOUBLE>")
    rows = df.mapInArrow(dd._sign_hashes(3, 4, 2, 7), "bucket BIGINT, home BOOLEAN, id BIGINT, code BINARY")
    assert rows.count() == 50 * 3 * 3 and {r.n for r in rows.select(F.length("code").alias("n")).distinct().collect()} == {16 + 3}
    assert inspect.signature(dd.lsh_pairs).parameters["bits"].default == 12
