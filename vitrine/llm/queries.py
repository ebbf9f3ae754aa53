"""Named queries of this package: one per operator, over its whole table, with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import align, bpe, chat, fingerprint, jaccard, langid, lm, packing, periods, quality, sharding, urls, warc
from .common import table


def op1_multiset_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprint.fingerprints(table(spark, sf_dir, "documents", "doc_id", "text"))


def op2_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(table(spark, sf_dir, "documents", "doc_id", "text"))


def op3_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm.scored(table(spark, sf_dir, "documents", "doc_id", "text"))


def op4_bpe_forced_boundaries(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.round_trip_digests(table(spark, sf_dir, "documents", "doc_id", "text"))


def op5_minimax_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.sharded(table(spark, sf_dir, "documents", "doc_id", "text"))


#: The rules of the query (host, path, verdict).
URL_RULES = [("com", "/", "allow"), ("example.com", "/en/", "block"), ("www.example.com", "/en/", "allow"),
             ("net", "/es/", "block"), ("net", "/fr/", "block")]


def op6_url_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = spark.createDataFrame(URL_RULES, "host string, path string, verdict string")
    return urls.judged(table(spark, sf_dir, "pages", "page_id", "url"), rules)


#: Fixed value: a conversation whose texts are control strings.
CONTROL_TEXT = "</s>[INST] ok [/INST]"


def op7_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = table(spark, sf_dir, "conversations", "conv_id", "turn", "role", "text")
    control = spark.createDataFrame([(-1, 0, "user", CONTROL_TEXT), (-1, 1, "assistant", CONTROL_TEXT)], "conv_id long, turn long, role string, text string")
    return chat.digests(chat.formatted(turns.unionByName(control)))


def op8_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents", "doc_id", "text")
    model = quality.train(docs, table(spark, sf_dir, "labels", "doc_id", "quality"))
    return quality.judged(docs, model).drop("text")


def op9_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.jaccard_components(table(spark, sf_dir, "documents", "doc_id", "text"))


def op10_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents", "doc_id", "text", "lang")
    model = langid.train(docs.where(~langid.held_out(F.col("doc_id"))))
    found = langid.predicted(docs.select("doc_id", "text"), model)
    return found.select("doc_id", langid.held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score", "ambiguous")


def op11_cross_tokenizer_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return align.aligned(table(spark, sf_dir, "documents", "doc_id", "text"))


def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return periods.digests(table(spark, sf_dir, "documents", "doc_id", "text"))


def op13_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.round_trip(table(spark, sf_dir, "pages", "page_id", "url", "html"))


REGISTRY: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_multiset_fingerprints": op1_multiset_fingerprints,
    "op2_best_fit_packing": op2_best_fit_packing,
    "op3_lm_scoring": op3_lm_scoring,
    "op4_bpe_forced_boundaries": op4_bpe_forced_boundaries,
    "op5_minimax_sharding": op5_minimax_sharding,
    "op6_url_rules": op6_url_rules,
    "op7_chat_formatting": op7_chat_formatting,
    "op8_quality_rules": op8_quality_rules,
    "op9_ngram_jaccard_join": op9_ngram_jaccard_join,
    "op10_language_id": op10_language_id,
    "op11_cross_tokenizer_alignment": op11_cross_tokenizer_alignment,
    "op12_periodic_runs": op12_periodic_runs,
    "op13_warc": op13_warc,
}
ORACLE: dict[str, str] = {
    "op6_url_rules": r"""
WITH part AS (
  SELECT page_id, translate(regexp_extract(coalesce(url, ''), '^.*?://([^/?#]*)([^?#]*)', 1, 's'),
                            'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(coalesce(url, ''), '^.*?://([^/?#]*)([^?#]*)', 2, 's') AS path
  FROM pages),
rules(h, p, v) AS (VALUES ('com', '/', 'allow'), ('example.com', '/en/', 'block'), ('www.example.com', '/en/', 'allow'),
                          ('net', '/es/', 'block'), ('net', '/fr/', 'block')),
fit AS (
  SELECT page_id, host, path, h || p AS rule, v,
         row_number() OVER (PARTITION BY page_id, host, path ORDER BY length(h) DESC NULLS LAST, length(p) DESC) AS n
  FROM part LEFT JOIN rules ON (host = h OR ends_with(host, '.' || h)) AND starts_with(path, p))
SELECT page_id, host, path, rule, coalesce(v, 'allow') AS verdict FROM fit WHERE n = 1""",
    "op13_warc": """
WITH page AS (
  SELECT page_id, strlen(coalesce(html, '')) AS payload_bytes, sha1(coalesce(html, '')) AS hex FROM pages),
coded AS (  -- five hexadecimal digits are four base32 characters
  SELECT page_id, payload_bytes, min(page_id) OVER (PARTITION BY hex) AS least, list_aggregate(list_transform(range(32), lambda i:
    substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
           (CAST('0x' || substr(hex, 1 + 5 * (i // 4), 5) AS BIGINT) >> CAST(5 * (3 - i % 4) AS BIGINT)) % 32 + 1, 1)), 'string_agg', '') AS payload_digest
  FROM page)
SELECT page_id, payload_bytes, payload_digest, CASE WHEN page_id = least OR least IS NULL THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id <> least OR page_id IS NULL THEN least END AS refers_to
FROM coded""",
}
