"""Corpus pipeline over ``documents``: language ID, quality rules, near-duplicate removal, best-fit packing.

Every stage takes ``(spark, docs, sf_dir)`` and works on all rows of its predecessor; all but the last return
the columns they were given.  Between stages the rows are written as Parquet and read again.

Defined results, beside those of the operators: rows with null or letterless text leave in the first stage;
of repeated rows (same id and text) one stays in the third; extra columns are carried along, whatever their
names; an empty table stays empty.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from vitrine.llm import jaccard, langid, packing, quality
from vitrine.llm.common import shared, table

_OWN = "__pipeline_"  # prefix of working columns


def language_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is told; undetermined and ambiguous texts go."""
    found = langid.predicted(docs, langid.train(docs), _OWN)
    return found.where((F.col(f"{_OWN}lang_pred") != langid.UNKNOWN) & ~F.col(f"{_OWN}ambiguous")).select(*docs.columns)


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the fixed rules and the trees."""
    model = quality.train(docs, table(spark, sf_dir, "labels", "doc_id", "quality"))
    return quality.judged(docs, model, prefix=_OWN).where(f"{_OWN}kept").select(*docs.columns)


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of every near-duplicate group: that with the smallest id (a null id only if no other has one).

    Rows are told apart by a hash of id and text, so null and repeated ids are no obstacle; rows equal in both count once.
    """
    key, component = f"{_OWN}key", f"{_OWN}component"
    rows = docs.withColumn(key, F.xxhash64("doc_id", "text"))
    found = jaccard.jaccard_components(rows.select(F.col(key).alias("doc_id"), "text"))
    found = found.groupBy(F.col("doc_id").alias(key)).agg(F.min("component_id").alias(component))
    ids = rows.groupBy(key).agg(F.min("doc_id").alias("doc_id"))
    first = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", key)).alias("first")
    stays = found.join(ids, key).groupBy(component).agg(first).select(F.col(f"first.{key}").alias(key))
    one = Window.partitionBy(key).orderBy(F.lit(1))
    return rows.join(stays, key).withColumn(f"{_OWN}row", F.row_number().over(one)).where(f"{_OWN}row = 1").select(*docs.columns)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces of the remaining documents, placed into sequences."""
    return packing.pack_documents(docs)


STAGES = [("language_id", language_stage), ("quality_rules", quality_stage), ("near_duplicates", near_duplicate_stage),
          ("packing", packing_stage)]

#: Trained models and components have no SQL form; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for i, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i < len(STAGES) - 1:
            docs = shared(docs, f"stage-{name}")
    return docs
