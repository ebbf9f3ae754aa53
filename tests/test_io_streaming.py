"""Sources, sinks and streaming on files written to a scratch folder."""

import os
import tempfile

import numpy as np
from pyspark.sql import functions as F

from vitrine.functions.encoder import byte_histogram_model
from vitrine.sources import catalog_io as io
from vitrine.sources import testdata as td
from vitrine.streaming import query_log as ql

CSV = '''id,name,u
1,a,x
2,b
3,c,x,EXTRA
6,c,x,E1,E2
4,"q,""z
w""",y
5, NA ,x
'''


def test_csv_ingest_skips_long_rows_keeps_short(spark):
    d = tempfile.mkdtemp(prefix="vitrine-csv-")
    with open(os.path.join(d, "styles.csv"), "w") as f:
        f.write(CSV)
    df = io.read_catalog_csv(spark, d)
    rows = {int(r.id): r for r in df.collect()}
    assert sorted(rows) == [1, 2, 4, 5]
    assert rows[2].u is None and rows[4].name == 'q,"z\nw"' and rows[5].name == " NA "


def test_csv_order_follows_file_names(spark):
    d = tempfile.mkdtemp(prefix="vitrine-csv-")
    for name, rows in (("a.csv", [(1, "first"), (2, "two")]), ("b.csv", [(1, "second")] + [(i, "x" * 50) for i in range(10, 400)])):
        with open(os.path.join(d, name), "w") as f:
            f.write("id,name\n" + "".join(f"{i},{n}\n" for i, n in rows))
    df = io.read_catalog_csv(spark, d)
    first = df.groupBy("id").agg(F.min_by("name", "src_pos").alias("name")).where("id = '1'").first()
    assert first["name"] == "first" and df.select("src_pos").distinct().count() == df.count()


def test_refresh_sees_changed_products(spark):
    c = spark.createDataFrame([(1, "a"), (2, "b"), (3, "c")], "id BIGINT, productDisplayName STRING")
    cache = spark.createDataFrame([(1, "a"), (2, "old")], "id BIGINT, t STRING").select("id", io.content_hash("t").alias("content_hash"))
    assert {r.id for r in io.vectors_to_refresh(c, cache).collect()} == {2, 3}


def test_image_inventory_and_embedding(spark):
    d = tempfile.mkdtemp(prefix="vitrine-img-")
    payload = {"10.jpg": b"abc", "10.png": b"zzzz", "11.JPG": b"x", "12.webp": b"hello", "x13.jpg": b"q"}
    for n, b in payload.items():
        with open(os.path.join(d, n), "wb") as f:
            f.write(b)
    inv = io.image_inventory(spark, d)
    from vitrine.operators.clean import resolve_images
    got = {r.id: (r.image_path, r.image_bytes) for r in resolve_images(inv).collect()}
    assert got == {i: (f"file:{d}/{n}", s) for i, n, s in ((10, "10.jpg", 3), (12, "12.webp", 5))}
    import pytest
    products = spark.createDataFrame([(10,), (12,)], "id BIGINT")
    assert io.assert_images(products, resolve_images(inv)).first()[0] == 2
    with pytest.raises(Exception, match="the first is 99"):
        io.assert_images(products.union(spark.createDataFrame([(99,)], "id BIGINT")), resolve_images(inv)).collect()
    emb = {r.id: r.embedding for r in io.embed_images(spark, d, byte_histogram_model(8), 8).collect()}
    assert set(emb) == {10, 12}
    assert abs(np.linalg.norm(emb[10]) - 1.0) < 1e-6


def test_vector_roundtrip_and_refresh(spark, sf):
    d = tempfile.mkdtemp(prefix="vitrine-vec-")
    v = td.vectors(spark, sf)
    io.save_vectors(v, d + "/v")
    back = io.load_vectors(spark, d + "/v")
    assert back.count() == v.count() and set(back.columns) == {"id", "embedding", "model"}
    todo = {r.id for r in io.vectors_to_refresh(td.catalog(spark, sf), back).collect()}
    cat_ids = {r.id for r in td.catalog(spark, sf).select("id").collect()}
    assert todo == cat_ids - {r.id for r in v.select("id").collect()}


def test_streaming_history_summary(spark, sf):
    log = ql.read_log(spark, f"{sf}/events*.parquet")
    out = tempfile.mkdtemp(prefix="vitrine-stream-")
    ql.run_upserts(ql.windowed_summary(log, "1 day", "1 hour"), out + "/sink", ql.checkpoint_location(spark, "hist"))
    got = ql.latest(spark, out + "/sink", ["window", "query"])
    ev = td.table(spark, sf, "events")
    # every window, the ones still open included, has the count of the batch form
    batch = ev.groupBy(F.window("ts", "1 day").alias("window"), F.col("event_type").alias("query")).count()
    j = got.join(batch, ["window", "query"])
    assert got.count() == batch.count() == j.count() and j.where(F.col("count") != F.col("total_queries")).count() == 0
    newest = got.agg(F.max("window.start")).first()[0]
    assert newest == batch.agg(F.max("window.start")).first()[0]


def test_checkpoint_folder_is_required_off_local_masters(spark, monkeypatch):
    import pytest
    from vitrine import session

    class Context:
        master = "spark://host:7077"
        getCheckpointDir = staticmethod(lambda: None)
        getConf = staticmethod(lambda: type("C", (), {"get": staticmethod(lambda *a: None)})())
    fake = type("S", (), {"sparkContext": Context, "conf": type("C", (), {"get": staticmethod(lambda *a: None)})()})()
    with pytest.raises(RuntimeError):
        session.ensure_checkpoint_dir(fake)


def test_streaming_duplicate_check(spark, sf):
    d = tempfile.mkdtemp(prefix="vitrine-dupstream-")
    planted = td.planted_vectors(spark, sf).where(F.col("copy_no") == 1).select(
        F.col("id"), F.col("embedding").cast("array<float>").alias("embedding"))
    planted.write.parquet(d + "/incoming")
    stream = spark.readStream.schema(planted.schema).parquet(d + "/incoming")
    ql.duplicate_check(stream, td.vectors(spark, sf), d + "/dups", ql.checkpoint_location(spark, "dup"), 0.92)
    got = spark.read.parquet(d + "/dups")
    assert got.count() == planted.count()
    assert got.where(F.floor(F.col("existing_id")) * 4 + 1 != F.col("new_id")).count() == 0


def test_missing_csv_and_schema_checks(spark):
    import pytest
    from vitrine.functions.encoder import embed_text
    from vitrine.operators.clean import missing_required
    with pytest.raises(io.CatalogNotFound):
        io.read_catalog_csv(spark, "/nonexistent/vitrine/styles.csv")
    df = spark.createDataFrame([(1, "a")], "id BIGINT, articleType STRING")
    assert "productDisplayName" in missing_required(df) and "id" not in missing_required(df)
    with pytest.raises(ValueError):
        embed_text(spark, "   ")
    v = embed_text(spark, "Blue casual shirt")
    assert abs(sum(x * x for x in v) - 1.0) < 1e-12


def test_unreadable_images_become_zero_or_raise(spark):
    import pytest
    d = tempfile.mkdtemp(prefix="vitrine-bad-")
    for n, b in {"1.jpg": b"GOODabc", "2.jpg": b"BROKEN", "3.png": b"GOODxyz"}.items():
        with open(os.path.join(d, n), "wb") as f:
            f.write(b)

    def decode(b):
        b = bytes(b)
        if not b.startswith(b"GOOD"):
            raise ValueError("not an image")
        return b[4:]
    got = {r.id: r.embedding for r in io.embed_images(spark, d, byte_histogram_model(8), 8, decode=decode).collect()}
    assert set(got) == {1, 2, 3} and not any(got[2]) and abs(np.linalg.norm(got[1]) - 1) < 1e-6
    with pytest.raises(Exception):
        io.embed_images(spark, d, byte_histogram_model(8), 8, decode=decode, on_error="raise").collect()
