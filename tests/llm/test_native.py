"""Fingerprints, sharding and URL rules against brute force, with awkward rows."""

import zlib

import pytest
import xxhash
from pyspark.sql import functions as F

from vitrine.llm import fingerprint as fp
from vitrine.llm import sharding, urls

from .fixtures import AWKWARD, documents, prose, rows_of, sha


def edited(rows):
    rows = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] or ""))
    for k, (i, t) in enumerate(rows):
        t, following = t or "", rows[(k + 1) % len(rows)][1] or ""
        q = len(t) // 4
        yield i, len(t), sha(t[: len(t) - q] + following[:q]), t


@pytest.mark.parametrize("rows", [AWKWARD, prose(60), AWKWARD[:1], []])
def test_fingerprints(spark, rows):
    got = rows_of(fp.fingerprints(documents(spark, rows)))
    want = list(edited(rows))
    key = lambda r: (str(r[0]), r[1], r[2])
    assert sorted(((r["doc_id"], r["n_chars"], r["edited_sha256"]) for r in got), key=key) == sorted((w[:3] for w in want), key=key)
    assert all(0 <= r[c] <= 1 for r in got for c in ("near_edited", "near_next"))
    assert len({r["fingerprint"] for r in got}) == len({t for *_, t in want})


def test_fingerprint_is_a_multiset_hash(spark):
    df = spark.createDataFrame([("x y\nz\nw w w", "w w w\nx y\nz", "z", "x y\nw w w")], "a string, b string, z string, rest string")
    for c in df.columns:
        df = fp.with_vector(df, c, f"v_{c}")
    r = df.select((fp.digest(F.col("v_a")) == fp.digest(F.col("v_b"))).alias("order"),
                  (fp.subtract(F.col("v_a"), F.col("v_z")) == F.col("v_rest")).alias("deleted"),
                  (fp.add(F.col("v_rest"), F.col("v_z")) == F.col("v_a")).alias("inserted"),
                  fp.likeness(F.col("v_a"), F.col("v_b")).alias("same"), (F.col("v_a") == F.col("v_rest")).alias("other")).first()
    assert r["order"] and r["deleted"] and r["inserted"] and r["same"] == 1 and not r["other"]


def test_fingerprint_likeness_separates(spark):
    got = rows_of(fp.fingerprints(documents(spark, [(i, " ".join(f"w{i}x{j}" for j in range(400))) for i in range(20)])))
    assert min(r["near_edited"] for r in got) > 0.55 and max(r["near_next"] for r in got) < 0.45


def test_fingerprint_likeness_survives_an_inserted_word(spark):
    for n in (400, 4000):
        line = [f"word{i}" for i in range(n)]
        texts = (" ".join(line), " ".join(["new", *line]), " ".join(line[1:]), " ".join([*line[:50], "new", *line[50:]]))
        df = spark.createDataFrame([texts], "a string, b string, c string, d string")
        for c in df.columns:
            df = fp.with_vector(df, c, f"v_{c}")
        assert min(df.select(*[fp.likeness(F.col("v_a"), F.col(f"v_{c}")) for c in "bcd"]).first()) > 0.85


def test_fingerprint_words_are_seeded_first_and_lanes_keep_their_carries(spark, monkeypatch):
    r = fp.with_vector(spark.createDataFrame([("p",)], "t string"), "t", "v").select("v", *[F.xxhash64(F.lit(s), F.lit("p")).bitwiseAND(fp._long(fp._WORD)) for s in fp.EXACT_SEEDS]).first()
    assert r[0][1:5] == list(r[1:])
    lanes = [fp._LANE] * 3
    full = spark.range(1).select(fp._pack([F.lit(x).cast("long") for x in lanes]).alias("w")).first()["w"]
    assert full == fp._LANES
    head = [0] * (1 + len(fp.EXACT_SEEDS))
    size = fp._SHIFTS * len(fp.SKETCH_SEEDS)
    a, b = [4 * fp._LANE + 4, *head[1:], *[full] * size], [4 * fp._LANE + 6, *head[1:], *[0] * size]  # lanes one apart, one wrapped
    assert spark.createDataFrame([(a, b)], "a array<bigint>, b array<bigint>").select(fp.likeness(F.col("a"), F.col("b"))).first()[0] > 0.999


def test_native_plans_have_no_python(spark):
    docs = documents(spark, AWKWARD)
    pages = spark.createDataFrame([(1, "http://a.com/x")], "page_id long, url string")
    rules = spark.createDataFrame([("com", "/", "allow")], "host string, path string, verdict string")
    for df in (fp.fingerprints(docs), sharding.sharded(docs), urls.judged(pages, rules)):
        plan = df._jdf.queryExecution().toString()
        assert "Python" not in plan and "Pandas" not in plan and "Arrow" not in plan and "Cartesian" not in plan


def best_capacity(rows, shards):
    groups = {}
    for _, t in rows:
        b = (t or "").encode()
        h = xxhash.xxh64(b, seed=42).intdigest()
        h -= (h >> 63) << 64
        groups[h] = groups.get(h, 0) + len(b) + 1
    sizes = [v for _, v in sorted(groups.items())]

    def fits(c):
        used, filled = 1, 0
        for s in sizes:
            if s > c:
                return False
            if filled + s > c:
                used, filled = used + 1, 0
            filled += s
        return used <= shards
    return next(c for c in range(max(sizes, default=0), sum(sizes) + 1) if fits(c)) if sizes else 0


@pytest.mark.parametrize("rows", [AWKWARD, prose(150) + [(i, "hot copy " * 4) for i in range(100)], AWKWARD[:2], []])
def test_sharding(spark, rows):
    got = rows_of(sharding.sharded(documents(spark, rows)))
    assert sorted((str(r["doc_id"]), r["size"], r["text_crc32"]) for r in got) == sorted(
        (str(i), len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for i, t in rows)
    sizes, slots, places = {}, {}, {}
    for r in got:
        sizes[r["shard"]] = sizes.get(r["shard"], 0) + r["size"]
        slots.setdefault(r["shard"], []).append(r["slot"])
        places.setdefault((r["size"], r["text_crc32"]), set()).add(r["shard"])
        assert r["law"] == "bytes" and r["grown_shard"] is None and 0 <= r["shard"] < 16
    assert max(sizes.values(), default=0) == best_capacity(rows, 16)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert all(len(p) == 1 for p in places.values())


def test_minimax_cuts_refine_to_the_exact_capacity(spark, monkeypatch):
    monkeypatch.setattr(sharding, "FIRST_BITS", 2)
    monkeypatch.setattr(sharding, "MORE_BITS", 2)
    rows = prose(200, seed=9)
    assert sharding.minimax_cuts(sharding.document_sizes(documents(spark, rows)), 7)[0] == best_capacity(rows, 7)


RULES = [("com", "/", "allow"), ("example.com", "/en/", "block"), ("www.example.com", "/en/", "allow"), ("net", "/es/", "block"),
         ("net", "", "block"), ("a.net", "/es/x", "allow"), ("", "/root", "block"), ("net", "/es/", "allow")]
URLS = [None, "", "no scheme", "http://example.com", "http://EXAMPLE.com/en/x?y#z", "https://www.example.com/en/", "x://deep.www.example.com/en/q",
        "http://notexample.com/en/", "http://a.net/es/xyz", "http://b.a.net/es/x", "http://net/es/", "http://net", "http://x.net?q=/es/", "http:///root/1",
        "a://b://c.com/d", "http://example.com./en/", "http://..com/\U0010ffff", "http://com/" + "p/" * 400, "http://c.com/line\nbreak"]


def judge(url):
    host = path = ""
    if url and "://" in url:
        rest = url.split("://", 1)[1]
        cut = min([rest.find(c) for c in "/?#" if c in rest], default=len(rest))
        host = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in rest[:cut])
        path = rest[cut:]
        path = path[: min([path.find(c) for c in "?#" if c in path], default=len(path))]
    fits = [(len(h), len(p), v, h + p) for h, p, v in RULES if (host == h or host.endswith("." + h)) and path.startswith(p)]
    best = max(fits, key=lambda f: (f[0], f[1]), default=None)
    verdict = min(f[2] for f in fits if f[:2] == best[:2]) if best else "allow"
    return host, path, best[3] if best else None, verdict


@pytest.mark.parametrize("parts", [1, 7])
def test_url_rules(spark, parts):
    pages = spark.createDataFrame([(i, u, "x", "y") for i, u in enumerate(URLS * 2)], "page_id long, url string, host string, rule string").repartition(3)
    rules = spark.createDataFrame(RULES, "host string, path string, verdict string")
    got = {r["page_id"]: (r["host"], r["path"], r["rule"], r["verdict"]) for r in rows_of(urls.judged(pages, rules, parts=parts))}
    assert got == {i: judge(u) for i, u in enumerate(URLS * 2)}
    assert urls.judged(pages.limit(0), rules, parts=parts).count() == 0
    assert {r["verdict"] for r in rows_of(urls.judged(pages, rules.limit(0), parts=parts))} == {"allow"}
