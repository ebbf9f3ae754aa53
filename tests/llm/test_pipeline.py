"""The pipeline, stage by stage, against brute force over its own input; and the optional registration."""

import collections

import pytest

import __spark_entry__ as entry
import corpus_pipeline
from tools.check_oracle import digest, duck
from vitrine.llm import langid, quality
from vitrine.llm.common import table

from .fixtures import AWKWARD, components, documents, prose, quality_counts, rows_of


def test_stages(spark, sf):
    docs = table(spark, sf, "documents").withColumn("__extra", __import__("pyspark").sql.functions.lit("kept"))
    for name, stage in corpus_pipeline.STAGES:
        before = [(r["doc_id"], r["text"]) for r in docs.select("doc_id", "text").collect()]
        out = stage(spark, docs, sf)
        if name != "packing":
            assert out.columns == docs.columns
            out = out.cache()
            after = [r["doc_id"] for r in out.select("doc_id").collect()]
        if name == "language_id":
            assert len(after) >= 0.98 * len(before)
        if name == "quality_rules":
            counts = {i: quality_counts(t) for i, t in before}
            assert not [i for i in after if counts[i][0] < 50 or 100 * counts[i][4] > 50 * counts[i][0]]
            good = {r["doc_id"] for r in table(spark, sf, "labels").where("quality = 1").collect()}
            fine = {i for i, c in counts.items() if i in good and c[0] >= 50 and 100 * c[4] <= 50 * c[0]}
            assert len(fine & set(after)) >= 0.97 * len(fine)
        if name == "near_duplicates":
            assert sorted(after) == sorted({c for _, _, c in components(before)})
        if name == "packing":
            assert {r["doc_id"] for r in out.select("doc_id").collect()} == {i for i, _ in before}
        docs = out


def test_awkward_rows_pass_the_stages(spark, sf):
    docs = documents(spark, AWKWARD + prose(60))
    kept = corpus_pipeline.near_duplicate_stage(spark, docs, sf)
    assert kept.columns == docs.columns
    rows = AWKWARD + prose(60)
    labels = collections.Counter(d for d, _, c in set(components(rows)) if d == c)
    assert sorted(map(str, labels)) == sorted(str(r["doc_id"]) for r in rows_of(kept))
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs, sf).count() >= 0
        assert stage(spark, docs.limit(0), sf).count() == 0


def test_one_document_of_a_group_stays_without_unique_ids(spark, sf):
    def group(name, ids):
        return [(i, " ".join([f"{name}{w}" for w in range(200)] + [f"{name}end{k}"])) for k, i in enumerate(ids)]
    rows = group("a", [None, None]) + group("b", [None, 7]) + group("c", [8, 8, 3]) + group("d", [8, 9]) + group("e", [None]) * 2 + group("f", [3])
    kept = [(r["doc_id"], r["text"][0]) for r in rows_of(corpus_pipeline.near_duplicate_stage(spark, documents(spark, rows), sf))]
    assert sorted(kept, key=lambda r: r[1]) == [(None, "a"), (7, "b"), (3, "c"), (8, "d"), (None, "e"), (3, "f")]


def test_language_accuracy_on_held_out_documents(spark, sf):
    docs = table(spark, sf, "documents")
    held = langid.held_out(docs["doc_id"])
    got = langid.predicted(docs.where(held), langid.train(docs.where(~held))).where("lang is not null")
    right = got.where("lang = lang_pred").count()
    assert right >= 0.95 * got.count()


def test_quality_trees_on_labels(spark, sf):
    docs, labels = table(spark, sf, "documents", "doc_id", "text"), table(spark, sf, "labels")
    got = quality.judged(docs, quality.train(docs, labels)).join(labels, "doc_id").where("not base_failed")
    assert got.where("(quality = 1) = kept").count() >= 0.95 * got.count()


def test_registered_queries():
    names = entry.queries()
    assert "pipeline" in names and all(any(n.startswith(f"op{i}_") for n in names) for i in range(1, 11))


COLUMNS = {
    "op1": "doc_id n_chars edited_sha256 fingerprint edited_fingerprint near_edited near_next",
    "op2": "doc_id piece start length ids_crc32 sequence_id offset",
    "op3": "doc_id held_out n_tokens n_known train_tokens base_score score",
    "op4": "doc_id n_tokens ids_sha256 decoded_sha256",
    "op5": "doc_id size text_crc32 law shard slot grown_shard",
    "op6": "page_id host path rule verdict",
    "op7": "conv_id n_turns turns_sha256 loss_chars loss_sha256 formatted_chars",
    "op8": "doc_id n_words word_chars n_symbols n_dup_lines n_repeat_words base_failed kept",
    "op9": "doc_id n_shingles component_id",
    "op10": "doc_id held_out lang_pred score",
}


@pytest.mark.parametrize("op", sorted(COLUMNS))
def test_registered_query_covers_its_table(spark, sf, op):
    name, query = next((n, q) for n, q in entry.queries().items() if n.startswith(f"{op}_"))
    out = query(spark, sf)
    assert set(COLUMNS[op].split()) <= set(out.columns)
    source, key = ("pages", "page_id") if op == "op6" else ("conversations", "conv_id") if op == "op7" else ("documents", "doc_id")
    ids = {r[0] for r in out.select(key).collect()}
    assert ids == {r[0] for r in table(spark, sf, source, key).collect()} | ({-1} if op == "op7" else set())
    if name in entry.oracle_sql():
        assert digest(query(spark, sf).toPandas()) == digest(duck(sf).execute(entry.oracle_sql()[name]).df())


def test_pipeline_runs(spark, sf):
    out = corpus_pipeline.run(spark, sf)
    assert out.count() > 0 and {"doc_id", "sequence_id"} <= set(out.columns)
