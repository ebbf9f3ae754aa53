"""Mergeable profile, content-addressed embedding, large rule tables."""

import os

import numpy as np
import pytest
from pyspark.sql import functions as F

from vitrine.functions.encoder import byte_histogram_model
from vitrine.operators import profile, rules
from vitrine.sources import catalog_io as io
from vitrine.sources import testdata as td


def test_profiles_of_batches_merge(spark, sf, tmp_path):
    c = td.catalog(spark, sf, with_embedding=False).withColumn("usage", F.when(F.col("id") % 7 > 0, F.col("usage")))
    for n in range(3):
        profile.profile_sketches(c.where(F.col("id") % 3 == n)).write.parquet(f"{tmp_path}/batch={n}")
    merged = {r.column: r for r in profile.merged_profile(spark.read.parquet(str(tmp_path))).collect()}
    assert set(merged) == set(profile.PROFILE_COLUMNS)
    for name, r in merged.items():
        exact = {x.value: x.n for x in profile.frequency(c, name).collect()}
        assert r.rows == c.count() and r.present == sum(exact.values())
        assert abs(r.distinct - len(exact)) <= max(1, 0.02 * len(exact))
        assert all(exact[x["item"]] == x["count"] for x in r.top)
        assert sorted((x["count"] for x in r.top), reverse=True) == sorted(exact.values(), reverse=True)[: len(r.top)]


def test_distinct_counts_stay_within_the_stated_error(spark):
    df = spark.range(60_000).select(F.col("id").cast("string").alias("usage"))
    parts = [profile.profile_sketches(df.where(F.col("usage").cast("bigint") % 4 == n)) for n in range(4)]
    both = parts[0].unionByName(parts[1]).unionByName(parts[2]).unionByName(parts[3]).unionByName(parts[0])
    assert abs(profile.merged_profile(both).first()["distinct"] - 60_000) < 0.03 * 60_000


def counting_model(folder):
    make = byte_histogram_model(8)

    def build():
        predict = make()

        def counted(batch):
            with open(os.path.join(folder, f"{os.getpid()}"), "a") as f:
                f.write("x" * len(batch))
            return predict(batch)
        return counted
    return build


def test_each_distinct_image_is_embedded_once(spark, tmp_path):
    images, calls = tmp_path / "images", tmp_path / "calls"
    images.mkdir(), calls.mkdir()
    for i in range(40):
        (images / f"{i}.jpg").write_bytes(b"image %d" % (i % 5))
        (images / f"{i}.png").write_bytes(b"never shown %d" % i)  # a worse extension of the same id
    got = {r.id: (tuple(r.embedding), r.image_path) for r in io.embed_images(spark, str(images), counting_model(str(calls)), 8).collect()}
    assert set(got) == set(range(40)) and all(p.endswith(f"/{i}.jpg") for i, (_, p) in got.items())
    assert all(got[i][0] == got[i % 5][0] for i in range(40)) and len({v for v, _ in got.values()}) == 5
    assert sum(len(f.read_text()) for f in calls.iterdir()) == 5
    assert abs(np.linalg.norm(got[0][0]) - 1) < 1e-6


@pytest.mark.parametrize("bound", [10_000, 3])
def test_rules_beyond_the_broadcast_bound(spark, monkeypatch, bound):
    monkeypatch.setattr(rules, "BROADCAST_RULES", bound)
    types = spark.createDataFrame([(t,) for t in ["shirts", "tshirts", "cap", "capris", "casual shoes", "unknown thing", "s"]], "type_lower STRING")
    got = {r.type_lower: (r.rule_key, r.branch) for r in rules.resolve_types(types, rules.rule_table(spark)).collect()}
    monkeypatch.setattr(rules, "BROADCAST_RULES", 10_000)
    assert got == {r.type_lower: (r.rule_key, r.branch) for r in rules.resolve_types(types, rules.rule_table(spark)).collect()}
    assert got["shirts"] == ("shirts", "exact") and got["tshirts"][1] == "partial" and got["unknown thing"][1] == "default"
