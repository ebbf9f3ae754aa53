"""Near-duplicate check of arriving listings, each against all that were accepted before it.

The stored vectors live in a versioned store of packed blocks: ``epoch=-1`` holds the index that the stream
started with, ``epoch=<n>`` what micro-batch n accepted, ``base=<n>`` (after a compaction) everything up to n in
whole blocks.  A micro-batch reads versions older than itself, so a batch that is run again sees what it saw.

Within a batch listings follow one another by id: a listing is a duplicate when it is similar enough to a stored
one or to an earlier accepted one of its batch, and the earlier one is accepted when it is a duplicate of none.
That is settled in rounds over the pairs of the batch (a round accepts what has no open predecessor), so the
outcome does not depend on how a stream, in order of id, is cut into batches.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from .. import config
from ..functions.vectors import sq_norm
from ..operators.blocks import TOPK_SCHEMA, _topk_kernel, pack_blocks, rank_topk, threshold_self_join
from ..session import stored

INITIAL = -1
COMPACT_AFTER = 64            # versions beside the base that trigger a compaction
BROADCAST_BYTES = 64 << 20    # a batch whose vectors are below is broadcast to the store's blocks


def _names(spark: SparkSession, folder: str) -> list[str]:
    """Finished versions (one short name a version, told by their ``_SUCCESS`` files)."""
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path(folder)
    fs = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not fs.exists(path):
        return []
    names = [s.getPath().getName() for s in fs.listStatus(path)]
    return [n for n in names if re.fullmatch(r"(epoch|base)=-?\d+", n) and fs.exists(jvm.org.apache.hadoop.fs.Path(f"{folder}/{n}/_SUCCESS"))]


def versions(spark: SparkSession, folder: str, before: int | None = None) -> list[str]:
    """The versions that together are the store as of micro-batch ``before``: the latest base and the epochs after it."""
    known = sorted((int(n.split("=")[1]), n.split("=")[0]) for n in _names(spark, folder))
    known = [(v, kind) for v, kind in known if before is None or v < before]
    base = max((v for v, kind in known if kind == "base"), default=None)
    out = [f"base={base}"] if base is not None else []
    return out + [f"epoch={v}" for v, kind in known if kind == "epoch" and (base is None or v > base)]


def read_store(spark: SparkSession, folder: str, before: int | None = None) -> DataFrame | None:
    """Packed blocks ``(r_ids, r_vecs)`` of the store, None while there are none."""
    found = versions(spark, folder, before)
    schema = "r_ids ARRAY<BIGINT>, r_vecs ARRAY<DOUBLE>"
    return spark.read.schema(schema).parquet(*[f"{folder}/{v}" for v in found]) if found else None


def append(rows: DataFrame, folder: str, epoch: int, kind: str = "epoch", block_rows: int = config.MAX_BLOCK_ROWS) -> None:
    """Pack ``(id, embedding)`` into blocks and write them as one version (replaced when the batch is run again)."""
    vecs = rows.select("id", F.col("embedding").cast("array<double>").alias("embedding"))
    blocks = pack_blocks(vecs, None, "id", "embedding", [], block_rows, prefix="r_")
    blocks.select("r_ids", "r_vecs").write.mode("overwrite").parquet(f"{folder}/{kind}={epoch}")


def compact(spark: SparkSession, folder: str, upto: int, block_rows: int = config.MAX_BLOCK_ROWS) -> None:
    """Write all versions up to ``upto`` as one base of whole blocks; older versions stay for batches that are run again."""
    blocks = read_store(spark, folder, upto + 1)
    if blocks is None:
        return
    dim = F.expr("CAST(size(r_vecs) / size(r_ids) AS INT)")
    rows = blocks.where(F.size("r_ids") > 0).withColumn("dim", dim).select(
        F.posexplode("r_ids").alias("at", "id"), "r_vecs", "dim").select("id", F.slice("r_vecs", F.col("at") * F.col("dim") + 1, F.col("dim")).alias("embedding"))
    append(rows, folder, upto, "base", block_rows)


def nearest_stored(batch: DataFrame, store: DataFrame | None, broadcast_bytes: int = BROADCAST_BYTES,
                   block_rows: int = config.MAX_BLOCK_ROWS) -> DataFrame:
    """``(id, existing_id, similarity)``: the most similar stored row of every row of the batch, itself left out.

    The store is not shuffled while the batch is small: the batch's blocks go to where the store's blocks are read."""
    spark = batch.sparkSession
    if store is None:
        return spark.createDataFrame([], "id BIGINT, existing_id BIGINT, similarity DOUBLE")
    left = pack_blocks(batch, None, "id", "embedding", [], block_rows, prefix="l_").select("l_ids", "l_vecs")
    size = batch.agg(F.sum(F.size("embedding") * 8).alias("b")).first()["b"] or 0
    if size <= broadcast_bytes:
        one = left.agg(F.collect_list(F.struct("l_ids", "l_vecs")).alias("l")).withColumn("one", F.lit(0))
        # (a single row, its size checked above; the store's blocks meet it where they are)
        pairs = store.withColumn("one", F.size("r_ids") * 0).join(F.broadcast(one), "one").select(F.explode("l").alias("l"), "r_ids", "r_vecs")
        pairs = pairs.select("l.l_ids", "l.l_vecs", "r_ids", "r_vecs")
    else:
        n = int(left.agg(F.count(F.lit(1)).alias("n")).first()["n"])
        numbered = stored(pack_blocks(batch, None, "id", "embedding", [], block_rows, prefix="l_").select(F.col("_b").alias("b"), "l_ids", "l_vecs"), "stream-batch")
        most = int(numbered.agg(F.max("b")).first()[0]) if n else 0
        dealt = store.withColumn("b", F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(most).cast("bigint"))))
        pairs = dealt.join(numbered, "b").select("l_ids", "l_vecs", "r_ids", "r_vecs")
    found = pairs.mapInArrow(_topk_kernel(1, True, False, [], 1.0), TOPK_SCHEMA)
    return rank_topk(found, 1).select(F.col("l_id").alias("id"), F.col("r_id").alias("existing_id"), F.col("raw").alias("similarity"))


def settle(pairs: DataFrame, known: DataFrame) -> DataFrame:
    """Ids of the batch that are duplicates of an earlier accepted one: ``pairs (id_a < id_b)`` of similar rows, ``known`` the
    ids that are duplicates of stored rows already."""
    spark = pairs.sparkSession
    out = known.select("id")
    open_ = stored(pairs.select("id_a", "id_b").join(known.select(F.col("id").alias("id_a")), "id_a", "left_anti")
                   .join(known.select(F.col("id").alias("id_b")), "id_b", "left_anti"), "stream-open")
    while not open_.isEmpty():
        first = open_.select("id_a").distinct().join(open_.select(F.col("id_b").alias("id_a")), "id_a", "left_anti")
        gone = stored(open_.join(first, "id_a", "left_semi").select(F.col("id_b").alias("id")).distinct(), "stream-settled")
        out = out.unionByName(gone)
        open_ = stored(open_.join(gone.select(F.col("id").alias("id_b")), "id_b", "left_anti")
                       .join(gone.select(F.col("id").alias("id_a")), "id_a", "left_anti").select("id_a", "id_b"), "stream-open")
    return out


def check_batch(batch: DataFrame, folder: str, epoch: int, threshold: float) -> DataFrame:
    """Hits ``(new_id, existing_id, similarity)`` of one micro-batch; what it accepts is appended to the store.

    Of rows with one id the smallest vector counts; rows without a vector or with a zero vector are neither hits nor stored."""
    spark = batch.sparkSession
    rows = (batch.select(F.col("id").cast("bigint").alias("id"), F.col("embedding").cast("array<double>").alias("embedding"))
            .where(F.col("id").isNotNull() & F.col("embedding").isNotNull()).where(sq_norm("embedding") > 0)
            .groupBy("id").agg(F.min("embedding").alias("embedding")))
    rows = stored(rows, "stream-rows")
    before = stored(nearest_stored(rows, read_store(spark, folder, epoch)).where(F.col("similarity") >= threshold), "stream-hits")
    pairs = stored(threshold_self_join(rows, threshold), "stream-pairs")
    duplicate = stored(settle(pairs, before), "stream-duplicates")
    accepted = rows.join(duplicate, "id", "left_anti")
    inside = (pairs.join(accepted.select(F.col("id").alias("id_a")), "id_a", "left_semi")
              .select(F.col("id_b").alias("id"), F.col("id_a").alias("existing_id"), F.col("sim").alias("similarity")))
    best = F.min_by(F.struct("existing_id", "similarity"), F.struct(-F.col("similarity"), "existing_id")).alias("h")
    hits = before.unionByName(inside).groupBy("id").agg(best)
    append(accepted, folder, epoch)
    if len(versions(spark, folder, epoch + 1)) > COMPACT_AFTER:
        compact(spark, folder, epoch)
    return hits.select(F.col("id").alias("new_id"), "h.existing_id", "h.similarity")


def duplicate_check(new_listings: DataFrame, index: DataFrame, sink_path: str, checkpoint: str,
                    threshold: float = config.DUPLICATE_SIMILARITY_THRESHOLD, available_now: bool = True, store: str | None = None) -> StreamingQuery:
    """For each arriving listing ``(id, embedding)`` the most similar accepted one before it, kept when similarity >=
    threshold; written to ``sink_path/epoch=<batch id>`` (idempotent per micro-batch).

    ``store``: folder of the packed blocks, by default beside the checkpoint; an empty one starts with ``index``."""
    if threshold <= 0:
        raise ValueError("threshold must be > 0")
    spark = index.sparkSession
    folder = (store or f"{checkpoint}-store").rstrip("/")
    if not versions(spark, folder):
        append(index.where(F.col("embedding").isNotNull()).where(sq_norm("embedding") > 0), folder, INITIAL)

    def batch(df: DataFrame, epoch_id: int) -> None:
        check_batch(df, folder, epoch_id, threshold).write.mode("overwrite").parquet(f"{sink_path.rstrip('/')}/epoch={epoch_id}")
    w = new_listings.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="30 seconds")
    q = w.start()
    if available_now:
        q.awaitTermination()
    return q
