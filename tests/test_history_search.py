"""Stateful history, timed searches, rarest-gram lookups, component checks."""

import datetime as dt
import random

import numpy as np
from pyspark.sql import functions as F

from vitrine.operators import catalog as cat
from vitrine.operators import search as srch
from vitrine.operators.project import pca_checks, project_embeddings
from vitrine.sources import testdata as td
from vitrine.streaming import history, query_log as ql

LOG = "ts TIMESTAMP, query STRING, latency DOUBLE, similarity DOUBLE"


def log_rows(seed, days, n=200):
    rng = random.Random(seed)
    t0 = dt.datetime(2024, 1, 1)
    return [(t0 + dt.timedelta(days=rng.uniform(*days)), rng.choice(["shoe", "red dress", "red dress", "sock"]),
             rng.choice([None, rng.uniform(1, 90)]), rng.choice([None, rng.random()])) for _ in range(n)]


def want(rows):
    out = {}
    for q in {r[1] for r in rows}:
        own = [r for r in rows if r[1] == q]
        lat, sim = ([r[k] for r in own if r[k] is not None] for k in (2, 3))
        out[q] = (len(own), round(sum(lat) / len(lat), 2), round(max(lat), 2), round(sum(sim) / len(sim), 4))
    return out


def test_history_goes_on_from_its_checkpoint(spark, tmp_path):
    boots = [(r[0], "boot", *r[2:]) for r in log_rows(3, (60, 62))]
    parts = [log_rows(1, (0, 3)), log_rows(2, (2, 5)), boots, log_rows(4, (61, 63))]  # while boots are looked for, other sessions close
    source, sink, ck = (str(tmp_path / x) for x in ("log", "sink", "ck"))
    for n, rows in enumerate(parts):
        spark.createDataFrame(rows, LOG).coalesce(1).write.mode("append").parquet(source)
        states = history.running_history(spark.readStream.schema(LOG).parquet(source), idle_ms=10 * 86_400_000, watermark="4 days")
        history.run(spark, states, sink, ck)  # a new run each time, from the checkpoint
        sums = history.by_query(spark, sink)
        got = {r.query: (r.total_queries, r.avg_latency_ms, r.max_latency_ms, r.avg_similarity) for r in history.summary(sums, "query").collect()}
        full = want([r for p in parts[: n + 1] for r in p])
        assert set(got) == set(full)
        for q in full:
            assert got[q][0] == full[q][0] and got[q][2] == full[q][2]
            assert abs(got[q][1] - full[q][1]) < 0.0101 and abs(got[q][3] - full[q][3]) < 0.000101
    closed = spark.read.parquet(sink).where("closed")
    assert closed.count() > 0 and closed.agg(F.max("last")).first()[0] < dt.datetime(2024, 1, 7)
    total = history.summary(sums).first()
    assert total.total_queries == 800


def test_rarest_gram_decides_and_answers_stay(spark):
    rng = random.Random(4)
    texts = ["common zzz " + "".join(rng.choice("abcz ") for _ in range(rng.randint(0, 12))) for _ in range(300)] + ["", "zz", "needle zzz", None]
    needles = ["zzz", "needle", "zz", "", "absent", "common zzz a", "z", "dle zz"]
    t = spark.createDataFrame([(i, x) for i, x in enumerate(texts)], "tid BIGINT, text STRING")
    n = spark.createDataFrame([(x,) for x in needles], "needle STRING")
    got = sorted((r.needle, r.tid) for r in cat.containing(n, "needle", t, "text").collect())
    assert got == sorted((x, i) for x in needles for i, y in enumerate(texts) if y is not None and x in y)
    # "dle zz" is looked up by a substring that one text holds, not by "zz" or " zz", which all hold
    plan = cat.containing(n.where("needle = 'dle zz'"), "needle", t, "text")
    assert plan.count() == 1


def test_empty_text_matches_the_first_product(spark):
    c = spark.createDataFrame([(5, "Red Shoe"), (3, "Blue"), (9, None)], "id BIGINT, productDisplayName STRING")
    q = spark.createDataFrame([(" ",), ("red",), ("none",)], "query STRING")
    assert {r.query: r.id for r in cat.name_match(c, q).collect()} == {" ": 3, "red": 5}
    assert cat.name_match(c.limit(0), q).count() == 0


def test_timed_search(spark, sf):
    c = td.catalog(spark, sf)
    q = td.name_queries(spark, sf).withColumn("qid", F.xxhash64("query"))
    results, metrics = srch.timed_search(q, srch.text_index(c), c, 5)
    plain = srch.text_search(q, srch.text_index(c), c, 5)
    key = ["qid", "rank", "product_id"]
    assert sorted(map(tuple, results.select(*key).collect())) == sorted(map(tuple, plain.select(*key).collect()))
    rows = metrics.collect()
    assert len(rows) == q.count() and all(r.encode_ms > 0 and r.search_ms > 0 and r.batch_ms >= r.total_ms * len(rows) * 0.99 for r in rows)
    assert {"label", "latency_ms", "avg_similarity_pct"} == set(srch.metrics_series(metrics).columns)
    assert srch.history_summary(metrics, sim_col="avg_similarity").first().avg_latency_ms > 0


def test_component_checks(spark):
    rng = np.random.default_rng(2)
    x = rng.standard_normal((300, 6)) * np.array([5, 3, 2, 1, 0.5, 0.1]) @ np.linalg.qr(rng.standard_normal((6, 6)))[0]
    df = spark.createDataFrame([(i, [float(v) for v in r]) for i, r in enumerate(x)], "id BIGINT, embedding ARRAY<DOUBLE>")
    row = pca_checks(df, 4).first()
    assert (row.dims, row.orthonormal, row.residual_small, row.shares_hold) == (6, True, True, True)
    assert abs(row.total_variance - x.var(axis=0, ddof=1).sum()) < 1e-9


def test_projection_sample_is_of_all_rows(spark, sf):
    sample = project_embeddings(td.catalog(spark, sf), 50).collect()
    whole = {r.id: (r.x, r.y) for r in project_embeddings(td.catalog(spark, sf)).collect()}
    assert len(sample) == 50 and all(abs(r.x - whole[r.id][0]) < 1e-9 for r in sample)
