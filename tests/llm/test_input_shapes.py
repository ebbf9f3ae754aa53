"""Inputs of awkward shape: repeated ids, many special tokens, very long urls, rewritten histories, many filter rounds."""

import random
import time

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from vitrine.llm import bpe, chat, langid, lm, urls

from .fixtures import documents, prose, rows_of, sha


def test_language_sample_is_bounded_by_rank(spark, monkeypatch):
    seen = []
    monkeypatch.setattr(langid, "fit", lambda vectors, languages, **k: seen.append(sorted(languages)))
    hot = spark.range(20_000).select(F.lit(7).cast("long").alias("doc_id"), F.lit("the same text").alias("text"), F.lit("aa").alias("lang"))
    one_id = spark.range(5_000).select(F.lit(None).cast("long").alias("doc_id"), F.concat(F.lit("text "), F.col("id").cast("string")).alias("text"), F.lit("bb").alias("lang"))
    few = spark.createDataFrame([(i, f"only {i}", "cc") for i in range(3)], "doc_id long, text string, lang string")
    mixed = hot.union(spark.createDataFrame([(i, f"word {i}", "aa") for i in range(30)], "doc_id long, text string, lang string"))
    langid.train(mixed.union(one_id).union(few), per_language=100)
    assert {x: seen[0].count(x) for x in set(seen[0])} == {"aa": 31, "bb": 100, "cc": 3}


def test_many_special_tokens():
    encoder = bpe.load(bpe.default_path())
    text = "<|endoftext|>" * 40_000 + "word <|endoftext|> end"
    start = time.perf_counter()
    ids = next(iter(encoder.encode(pa.array([text])))).tolist()
    assert time.perf_counter() - start < 5
    assert ids[:40_000] == [50256] * 40_000 and encoder.decode(pa.array(ids).to_numpy()) == text
    both = [x.tolist() for x in encoder.encode(pa.array(["<|endof", "text|>", "<|endoftext|", "><|endoftext|>x"]))]
    assert [50256 in x for x in both] == [False, False, False, True]


@pytest.mark.parametrize("parts", [1, 6])
def test_very_long_urls_and_hosts(spark, parts):
    rules = spark.createDataFrame([("com", "/", "allow"), ("example.com", "/en/", "block"), ("a.b", "", "block")], "host string, path string, verdict string")
    long = [(1, "http://example.com/en/" + "x" * 1_000_000, "example.com/en/"), (2, "http://" + "a." * 10_000 + "example.com/en/y", "example.com/en/"),
            (3, "http://" + "b" * 500_000 + ".com/z", "com/"), (4, "http://" + "é." * 20_000 + "a.b", "a.b"), (5, "http://example.com/e", "com/"),
            (6, "http://xa.b/", None), (7, "http://" + "." * 3000 + "com/", "com/"), (8, "http://notexample.com/en/" + "é" * 300_000, "com/")]
    pages = spark.createDataFrame([r[:2] for r in long], "page_id long, url string")
    got = {r["page_id"]: r["rule"] for r in rows_of(urls.judged(pages, rules, parts=parts))}
    assert got == {i: rule for i, _, rule in long}


def test_rewritten_histories_have_no_loss_whatever_the_chunks(spark):
    def forgets(turns):
        return chat.instruction_template(turns if len(turns) <= 100 else turns[:5] + turns[6:])
    rows = [(1, t, ("user", "assistant")[t % 2], f"t{t}") for t in range(130)] + [(2, t, ("user", "assistant")[t % 2], f"t{t}") for t in range(90)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    found = [sorted(tuple(r.values()) for r in rows_of(chat.digests(chat.formatted(df, forgets, chunk=c)))) for c in (16, 64, 200)]
    assert found[0] == found[1] == found[2]
    by = {r["conv_id"]: r for r in rows_of(chat.digests(chat.formatted(df, forgets)))}
    assert by[1]["loss_chars"] == 0 and by[1]["loss_sha256"] == sha("") and by[1]["n_turns"] == 129
    assert by[2]["loss_chars"] == sum(len(f"t{t}") for t in range(1, 90, 2)) and not by[2]["rewrites_history"]


def test_filter_rounds_keep_one_broadcast(spark, monkeypatch):
    rows = prose(60, seed=random.Random(2).randrange(100))
    whole = sorted((r["doc_id"], r["score"]) for r in rows_of(lm.scored(documents(spark, rows))))
    plans, alive, most = [], [], []
    kept = lm.shared

    def shared(df, name):
        if name == "lm-levels":
            plans.append(df._jdf.queryExecution().executedPlan().toString().count("MapInArrow"))
            most.append(len(alive))
        return kept(df, name)
    real = type(spark.sparkContext).broadcast

    def broadcast(context, value):
        assert isinstance(value[0], int) and all(isinstance(raw, (bytes, bytearray)) for part in value[1:] for _, raw in part)
        made = real(context, value)
        alive.append(made)
        destroy = made.destroy
        made.destroy = lambda *a, **k: (alive.remove(made), destroy(*a, **k))
        return made
    monkeypatch.setattr(lm, "shared", shared)
    monkeypatch.setattr(type(spark.sparkContext), "broadcast", broadcast)
    got = sorted((r["doc_id"], r["score"]) for r in rows_of(lm.scored(documents(spark, rows), 150)))
    assert len(plans) >= 20 and set(plans) == {1} and set(most) == {1} and not alive
    assert [i for i, _ in got] == [i for i, _ in whole] and all(abs(a - b) < 1e-9 for (_, a), (_, b) in zip(got, whole))
