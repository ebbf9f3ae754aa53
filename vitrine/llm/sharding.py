"""Sharding by a minimax contiguous partition, with DataFrame functions only.

Documents with equal texts form one atomic group; groups are ordered by the 64-bit hash of their text (two
texts that share a hash share a group, which does no harm).  The smallest capacity for which a greedy pass
needs at most ``shards`` shards is found by binary search, and the order is cut there.

The search never sees all groups.  It works on a histogram of hash ranges (2**12 at first) and finds two
capacities: one that would do if ranges could be cut anywhere inside, one that does if they are cut only at
their ends.  While they differ, the few ranges that a cut may fall into are split 256 ways by one more
aggregation, until both are equal; a range that holds a single group is never split or cut.  The result is
exact, the driver holds some thousand ranges whatever the table's size, and a group of a third of all rows is
one number.

Slots are numbered by salted counts: rows of a shard are spread over hash buckets of the id, numbered inside
and offset by the buckets before.  Defined results.  A null text is an empty one (size 1).  Repeated rows get a
slot each.  A null ``doc_id`` is sharded like any row.  Ties in slots are broken by hash, among equal rows
freely.  Empty table: no rows.  A shard stays empty if there are fewer groups than shards.
"""

from __future__ import annotations

from itertools import accumulate
from typing import NamedTuple

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import shared, shuffle_partitions

SHARDS = 16
FIRST_BITS, MORE_BITS = 12, 8
SLOT_ROWS = 100_000     # rows numbered by one task, about


class Range(NamedTuple):
    """Hash range ``prefix`` of ``bits`` bits: bytes, and whether it holds one group only."""

    first: int      # smallest hash in it
    total: int
    single: bool
    bits: int
    prefix: int


def document_sizes(docs: DataFrame) -> DataFrame:
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), (F.octet_length(text) + 1).cast("long").alias("size"),
                       F.crc32(text.cast("binary")).alias("text_crc32"), F.xxhash64(text).alias("key"))


def _ranges(sizes: DataFrame, bits: int, within: list[int] | None = None, parent_bits: int = 0) -> list[Range]:
    """Sizes of the hash ranges of ``bits`` bits, inside some ranges of ``parent_bits`` bits or everywhere."""
    if within is not None:
        spark = sizes.sparkSession
        wanted = spark.createDataFrame([(p,) for p in within], "parent long")
        sizes = sizes.withColumn("parent", F.shiftright("key", 64 - parent_bits)).join(F.broadcast(wanted), "parent", "left_semi")
    rows = (sizes.groupBy(F.shiftright("key", 64 - bits).alias("prefix"))
            .agg(F.sum("size").alias("total"), F.min("key").alias("low"), F.max("key").alias("high")).orderBy("prefix").collect())
    return [Range(r["low"], r["total"], r["low"] == r["high"], bits, r["prefix"]) for r in rows]


def _greedy(ranges: list[Range], capacity: int, cut_inside: bool) -> list[tuple[int, int]] | None:
    """Greedy cuts ``(index of the range where a shard begins, bytes of it that went before)``."""
    cuts, filled = [], 0
    for i, r in enumerate(ranges):
        if cut_inside and not r.single:
            rest = r.total
            while filled + rest > capacity:
                rest -= capacity - filled
                cuts.append((i, r.total - rest))
                filled = 0
            filled += rest
            continue
        if r.total > capacity:
            return None
        if filled + r.total > capacity:
            cuts.append((i, 0))
            filled = 0
        filled += r.total
    return cuts


def _smallest(ranges: list[Range], shards: int, cut_inside: bool) -> int:
    total = sum(r.total for r in ranges)
    low, high = -(-total // shards), total
    while low < high:
        middle = (low + high) // 2
        cuts = _greedy(ranges, middle, cut_inside)
        if cuts is not None and len(cuts) < shards:
            high = middle
        else:
            low = middle + 1
    return low


def minimax_cuts(sizes: DataFrame, shards: int = SHARDS) -> tuple[int, list[int]]:
    """``(smallest capacity, first hashes of all shards but the first)``."""
    ranges = _ranges(sizes, FIRST_BITS)
    while ranges:
        least, enough = _smallest(ranges, shards, True), _smallest(ranges, shards, False)
        if least == enough:
            return enough, [ranges[i].first for i, _ in _greedy(ranges, enough, False)]
        ends = list(accumulate(r.total for r in ranges))
        early, late = ([ends[i] - ranges[i].total + before for i, before in _greedy(ranges, c, True)] for c in (least, enough))
        late += [ends[-1]] * (len(early) - len(late))
        widest = max(r.total for r in ranges if not r.single)
        split = {k for k, r in enumerate(ranges) if not r.single and (r.total > least or any(
            a - (j + 1) * widest <= ends[k] and ends[k] - r.total <= b for j, (a, b) in enumerate(zip(early, late))))}
        split = split or {k for k, r in enumerate(ranges) if not r.single}
        finer: list[Range] = []
        for bits in sorted({ranges[k].bits for k in split}):
            finer += _ranges(sizes, min(bits + MORE_BITS, 64), [ranges[k].prefix for k in split if ranges[k].bits == bits], bits)
        ranges = sorted([r for k, r in enumerate(ranges) if k not in split] + finer)
    return 0, []


def sharded(docs: DataFrame, shards: int = SHARDS) -> DataFrame:
    """``(doc_id, size, text_crc32, law, shard, slot, grown_shard)`` of every document."""
    spark = docs.sparkSession
    sizes = shared(document_sizes(docs), "document-sizes")
    _, cuts = minimax_cuts(sizes, shards)
    shard = F.lit(0)
    for c in cuts:
        shard = shard + (F.col("key") >= F.lit(c)).cast("int")
    salts = max(shuffle_partitions(spark), sizes.count() // SLOT_ROWS + 1)
    rows = sizes.withColumn("shard", shard).withColumn("__salt", F.pmod(F.xxhash64("doc_id", "key"), F.lit(salts)))
    before = Window.partitionBy("shard").orderBy("__salt").rowsBetween(Window.unboundedPreceding, -1)
    starts = rows.groupBy("shard", "__salt").count().select("shard", "__salt", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("__from"))
    inside = Window.partitionBy("shard", "__salt").orderBy("doc_id", "key")
    return (rows.withColumn("__n", F.row_number().over(inside) - 1).join(starts, ["shard", "__salt"])
            .select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", (F.col("__from") + F.col("__n")).cast("long").alias("slot"),
                    F.lit(None).cast("int").alias("grown_shard")))
