"""Components: hubs, chains, incremental merging."""

import random

import pytest
from pyspark.sql import functions as F

from vitrine.operators import components as cc


def brute(edges):
    label = {}

    def root(x):
        while label[x] != x:
            x = label[x]
        return x
    for a, b in edges:
        for x in (a, b):
            label.setdefault(x, x)
        a, b = root(a), root(b)
        label[max(a, b)] = min(a, b)
    return {x: root(x) for x in label}


def frame(spark, edges):
    return spark.createDataFrame([(int(a), int(b)) for a, b in edges], "id_a BIGINT, id_b BIGINT")


def graph(seed, n=300):
    rng = random.Random(seed)
    edges = [(rng.randrange(n), rng.randrange(n)) for _ in range(n // 2)]
    edges += [(900, 1000 + i) for i in range(200)]               # a hub
    edges += [(3000 - i, 3001 - i) for i in range(40)]           # a chain
    edges += [(4000 + i, 4000 + j) for i in range(12) for j in range(i)]  # a clique
    return edges + [(7, 7), (8, 8), edges[0], edges[0][::-1]]


@pytest.mark.parametrize("hubs", [1000, 3])
def test_components_with_hubs(spark, monkeypatch, hubs):
    monkeypatch.setattr(cc, "HUBS", hubs)
    edges = graph(1)
    got = {r.id: r.component for r in cc.connected_components(frame(spark, edges)).collect()}
    want = brute([e for e in edges if e[0] != e[1]])
    assert got == want


def test_no_join_key_holds_more_than_its_share(spark):
    """On a star of a third of all nodes, the rows that meet by shuffle have no hot key."""
    n = 9000
    rows = spark.range(n).select(F.when(F.col("id") < n // 3, F.lit(0)).otherwise(F.col("id")).alias("u"), (F.col("id") + n).alias("v"))
    least = cc._least(rows, n)
    assert {r.u: r.m for r in least.collect()}[0] == n and least.count() == n
    assert "BroadcastHashJoin" in least._jdf.queryExecution().executedPlan().toString()
    hub = rows.groupBy("u").count().where(f"count * {cc.HUBS} > {n}")
    keys = rows.join(hub, "u", "left").select(F.when(F.col("count").isNull(), F.col("u")).otherwise(F.xxhash64("u", "v")).alias("key"))
    assert keys.groupBy("key").count().agg(F.max("count")).first()[0] <= n / cc.HUBS and hub.count() <= cc.HUBS


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_incremental_equals_full(spark, seed):
    edges = [e for e in graph(seed) if e[0] != e[1]]
    rng = random.Random(seed)
    rng.shuffle(edges)
    old, new = edges[: len(edges) // 2], edges[len(edges) // 2:] + [(50_000, 50_001), (60_000, 60_000)]
    base = cc.connected_components(frame(spark, old))
    got = {r.id: r.component for r in cc.merge_components(base, frame(spark, new)).collect()}
    want = brute(old + new)
    assert got == want


def test_merging_no_edges_or_into_nothing(spark):
    base = cc.connected_components(frame(spark, [(1, 2), (4, 3)]))
    none = frame(spark, [])
    assert {(r.id, r.component) for r in cc.merge_components(base, none).collect()} == {(1, 1), (2, 1), (3, 3), (4, 3)}
    empty = spark.createDataFrame([], "id BIGINT, component BIGINT")
    assert {(r.id, r.component) for r in cc.merge_components(empty, frame(spark, [(9, 5)])).collect()} == {(5, 5), (9, 5)}


def test_rounds_leave_one_table(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(cc, "ensure_checkpoint_dir", lambda s: f"file:{tmp_path}")
    cc.connected_components(frame(spark, graph(5))).count()
    (folder,) = tmp_path.iterdir()
    assert len(list(folder.iterdir())) == 1
