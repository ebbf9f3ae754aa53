"""N-gram Jaccard join: documents whose word-shingle sets are at least ``percent`` % alike, as components.

Method: prefix filtering under several global token orders.  Two sets of likeness >= t share a token among
the first ``n - ceil(t n) + 1`` tokens of each, under *every* global order; a pair is verified only if it
passes all of them.  Any function of the token is a valid order, so each order is "rarest first" (document
frequency) with its own hash for ties.  The stages, each of which loses no linked pair:

1. ``shingle_sets``: one scan. Every document keeps a token sample fixed by hash (rate 1/2), whose keys are
   counted in hash buckets.  At most ``n - ceil(t n)`` tokens of a document can be missing from a partner,
   so one with fewer shared sample tokens than that leaves has no partner and goes no further.  Keys that
   occur twice in a map-side chunk are sent once for the chunk: a shingle in a third of all documents costs
   one entry a chunk.
2. Equal sets are collapsed by a 128-bit set hash; one document stands for them.
3. ``_frequencies``: exact document frequencies (up to hash truncation) among the remaining sets give the
   orders; sets whose shared tokens no longer suffice go.
4. Sets that share a prefix token of the first order form cells (components over token -> smallest set).
   Big cells are cut into tiles; a task holds two tiles, intersects the prefix filters of all orders,
   verifies exactly and returns a spanning forest of the links it found, never all pairs.
5. Components over the forests; the label is the smallest ``doc_id`` of a component.

Defined results.  Null or wordless text: no shingles, linked with nothing, ``component_id = doc_id``.  Fewer
words than the shingle length: the whole sequence is the one shingle.  Repeated rows: each gets its row;
equal ids with different texts are separate documents that share a label only if linked.  A null ``doc_id``
takes part; it labels a component only if no other member has an id.  Ties need no rule (labels are minima).
Empty table: no rows.  Further columns of the input are ignored.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.components import connected_components
from . import words as W
from .common import binary_column, shared, shuffle_partitions, total_bytes, unpack

SHINGLE = 5
PERCENT = 80
ORDERS = (11, 22, 33)          # seeds of the tie hashes, one global order each
CHUNK_TOKENS = 2 << 20         # map-side chunk
BUCKET_TOKENS = 2 << 20        # tokens counted by one reduce group
TILE_TOKENS = 256 << 10        # tokens of one verification tile
FILTER_BITS = 26               # fixed-size id filter: 2**26 bits, 8 MB at most

_EMIT = "bucket long, chunk long, kind int, a binary, b binary, c binary"
_SETS = "doc_id long, n long, s1 long, s2 long, alive boolean"


def _need(n: np.ndarray, percent: int) -> np.ndarray:
    """Tokens of a set of size ``n`` that any partner has: ``ceil(percent % of n)``."""
    return -(-percent * n // 100)


def _sums(values: np.ndarray, counts: np.ndarray) -> np.ndarray:
    total = np.zeros(len(values) + 1, values.dtype)
    np.cumsum(values, out=total[1:])
    end = np.cumsum(counts)
    return total[end] - total[end - counts]


def _chunk_batch(chunk: int, ids: pa.Array, keys: np.ndarray, counts: np.ndarray, buckets: int) -> pa.RecordBatch:
    nd = len(counts)
    doc = np.repeat(np.arange(nd, dtype=np.uint32), counts)
    s1, s2 = _sums(W.mix(keys ^ W.U64(0x51ED270B)), counts), _sums(W.mix(keys ^ W.U64(0x2545F491)), counts)
    sample = keys < W.U64(1 << 63)
    ns = np.bincount(doc[sample], minlength=nd)
    order = np.argsort(keys[sample])
    k, d = keys[sample][order], doc[sample][order]
    at = np.flatnonzero(np.concatenate([[True], k[1:] != k[:-1]])) if len(k) else np.zeros(0, np.int64)
    times = np.diff(np.append(at, len(k)))
    again = np.repeat(times > 1, times)
    local = np.bincount(d[again], minlength=nd)
    place = ((k >> W.U64(32)) * W.U64(buckets)) >> W.U64(31)
    once_bucket, once_key, once_doc = place[~again], k[~again].astype(np.uint32), d[~again]
    many_bucket, many_key = place[at[times > 1]], k[at[times > 1]].astype(np.uint32)
    here = np.union1d(once_bucket, many_bucket)
    b1 = np.searchsorted(once_bucket, np.append(here, W.U64(2**64 - 1)))
    b2 = np.searchsorted(many_bucket, np.append(here, W.U64(2**64 - 1)))
    known = ids.is_valid().to_numpy(zero_copy_only=False)
    head = np.concatenate([ids.fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64), known.astype(np.int64)])
    m = len(here)
    tail = [pa.array([x.tobytes()], pa.binary()) for x in
            (head, np.concatenate([counts, ns, local]).astype(np.int64), np.concatenate([s1, s2]))]
    return pa.RecordBatch.from_arrays([
        pa.array(np.append(here.astype(np.int64), -1 - chunk % max(buckets, 1))), pa.array(np.full(m + 1, chunk, np.int64)),
        pa.array(np.append(np.zeros(m, np.int32), 1).astype(np.int32)),
        pa.concat_arrays([binary_column(once_doc, b1), tail[0]]), pa.concat_arrays([binary_column(once_key, b1), tail[1]]),
        pa.concat_arrays([binary_column(many_key, b2), tail[2]])], names=["bucket", "chunk", "kind", "a", "b", "c"])


def _emitter(buckets: int, shingle: int):
    def emit(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, seq = TaskContext.get().partitionId(), 0
        keys, counts, ids, size = [], [], [], 0
        for batch in batches:
            for lo, hi, data, off in W.slices(batch.column(1)):
                k, first = W.word_keys(data, off, True)
                k, c = W.distinct(*W.shingles(k, first, shingle), hi - lo)
                keys.append(k), counts.append(c), ids.append(batch.column(0).slice(lo, hi - lo))
                size += len(k)
                if size >= CHUNK_TOKENS:
                    yield _chunk_batch(part << 32 | seq, pa.concat_arrays(ids), np.concatenate(keys), np.concatenate(counts), buckets)
                    keys, counts, ids, size, seq = [], [], [], 0, seq + 1
        if ids:
            yield _chunk_batch(part << 32 | seq, pa.concat_arrays(ids), np.concatenate(keys), np.concatenate(counts), buckets)
    return emit


def _count_bucket(rows: pa.Table) -> pa.Table:
    """One bucket: for every chunk, the documents (repeated) whose keys also occur in another chunk."""
    if rows.num_rows and rows["bucket"][0].as_py() < 0:
        return rows.drop_columns(["bucket"])
    key, bounds = unpack(rows["b"], np.uint32)
    doc, _ = unpack(rows["a"], np.uint32)
    many, _ = unpack(rows["c"], np.uint32)
    every = np.sort(np.concatenate([key, many]))
    hot = np.union1d(every[1:][every[1:] == every[:-1]], many)
    hit = hot[np.minimum(np.searchsorted(hot, key), len(hot) - 1)] == key if len(hot) else np.zeros(len(key), bool)
    kept = np.concatenate([[0], np.cumsum(hit)])[bounds]
    none = pa.array([b""] * rows.num_rows, pa.binary())
    return pa.table([rows["chunk"], rows["kind"], binary_column(doc[hit], kept), none, none], names=["chunk", "kind", "a", "b", "c"])


def _finisher(percent: int):
    def finish(rows: pa.Table) -> pa.Table:
        kind = rows["kind"].to_numpy()
        at = int(np.flatnonzero(kind == 1)[0])
        head, numbers, sums = (np.frombuffer(rows[c][at].as_py(), t) for c, t in (("a", np.int64), ("b", np.int64), ("c", np.int64)))
        nd = len(head) // 2
        n, ns, local = numbers[:nd], numbers[nd: 2 * nd], numbers[2 * nd:]
        hits, _ = unpack(rows["a"].filter(pa.array(kind == 0)), np.uint32)
        common = local + np.bincount(hits, minlength=nd)
        alive = (n > 0) & (common >= ns - (n - _need(n, percent)))
        return pa.table([pa.array(head[:nd], mask=head[nd:] == 0), pa.array(n), pa.array(sums[:nd]), pa.array(sums[nd:]), pa.array(alive)],
                        names=["doc_id", "n", "s1", "s2", "alive"])
    return finish


def shingle_sets(docs: DataFrame, shingle: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """Per document: set size, 128-bit set hash, and whether it can have a partner at all."""
    spark = docs.sparkSession
    buckets = max(4 * shuffle_partitions(spark), total_bytes(docs) // 12 // BUCKET_TOKENS + 1)
    sent = docs.select("doc_id", "text").mapInArrow(_emitter(buckets, shingle), _EMIT)
    counted = sent.groupBy("bucket").applyInArrow(_count_bucket, "chunk long, kind int, a binary, b binary, c binary")
    return counted.groupBy("chunk").applyInArrow(_finisher(percent), _SETS)


def _id_filter(docs: DataFrame, ids: DataFrame) -> DataFrame:
    """Rows of ``docs`` whose id is in ``ids``.  A bit table of fixed size (at most 2**20 words, whatever the
    number of ids) is broadcast and drops most rows before the exact join shuffles any text."""
    slot = F.pmod(F.xxhash64("doc_id"), F.lit(1 << FILTER_BITS))
    words = (ids.select(slot.alias("s")).select(F.shiftright("s", 6).alias("__word"), F.expr("shiftleft(1L, cast(s % 64 as int))").alias("b"))
             .groupBy("__word").agg(F.bit_or("b").alias("__bits")))
    near = (docs.withColumn("__slot", slot).withColumn("__word", F.shiftright("__slot", 6)).join(F.broadcast(words), "__word")
            .where(F.expr("(__bits & shiftleft(1L, cast(__slot % 64 as int))) <> 0")).select("doc_id", "text"))
    wanted = ids.select(F.col("doc_id").alias("__id")).distinct()
    return near.join(wanted, near["doc_id"].eqNullSafe(wanted["__id"]), "left_semi")


def _packer(shingle: int):
    def pack(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, seq = TaskContext.get().partitionId(), 0
        for batch in batches:
            for lo, hi, data, off in W.slices(batch.column(1)):
                k, first = W.word_keys(data, off, True)
                k, c = W.distinct(*W.shingles(k, first, shingle), hi - lo)
                node = _sums(W.mix(k ^ W.U64(0x51ED270B)), c)
                yield pa.RecordBatch.from_arrays([pa.array([part << 32 | seq]), pa.array([node.tobytes()], pa.binary()),
                                                  pa.array([c.astype(np.int64).tobytes()], pa.binary()), pa.array([k.tobytes()], pa.binary())],
                                                 names=["pack", "nodes", "counts", "tokens"])
                seq += 1
    return pack


def _pack_keys(buckets: int):
    def emit(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for pack, tokens in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                k, times = np.unique(np.frombuffer(tokens, np.uint64), return_counts=True)
                place = ((k >> W.U64(32)) * W.U64(buckets)) >> W.U64(32)
                here, at = np.unique(place, return_index=True)
                bounds = np.append(at, len(k))
                yield pa.RecordBatch.from_arrays([
                    pa.array(here.astype(np.int64)), pa.array(np.full(len(here), pack, np.int64)),
                    binary_column(k.astype(np.uint32), bounds), binary_column(times.astype(np.uint32), bounds)],
                    names=["bucket", "pack", "keys", "times"])
    return emit


def _count_keys(rows: pa.Table) -> pa.Table:
    key, bounds = unpack(rows["keys"], np.uint32)
    times, _ = unpack(rows["times"], np.uint32)
    _, which = np.unique(key, return_inverse=True)
    df = np.bincount(which, weights=times)[which].astype(np.uint32)
    return pa.table([rows["pack"], rows["bucket"], binary_column(df, bounds)], names=["pack", "bucket", "df"])


def _orderer(percent: int, seeds: tuple[int, ...]):
    def order(packs: pa.Table, counts: pa.Table) -> pa.Table:
        out: dict[str, list] = {c: [] for c in ("node", "n", "tokens", "prefix", "others")}
        df, _ = unpack(counts.sort_by("bucket")["df"], np.uint32)
        for i in range(packs.num_rows):
            node, n, tokens = (np.frombuffer(packs[c][i].as_py(), t) for c, t in (("nodes", np.int64), ("counts", np.int64), ("tokens", np.uint64)))
            seen = df[np.searchsorted(np.unique(tokens), tokens)]
            text = np.repeat(np.arange(len(n)), n)
            keep = np.bincount(text[seen > 1], minlength=len(n)) >= np.maximum(_need(n, percent), 1)
            first = np.cumsum(n) - n
            prefixes = []
            for seed in seeds:
                o = np.lexsort((W.mix(tokens ^ W.U64(seed)), seen, text))
                rank = np.arange(len(o)) - first[text]
                pick = (rank <= (n - _need(n, percent))[text]) & (seen[o] > 1)
                pt, pk = text[pick], tokens[o][pick]
                prefixes.append((pk, np.searchsorted(pt, np.arange(len(n) + 1))))
            for j in np.flatnonzero(keep).tolist():
                out["node"].append(int(node[j])), out["n"].append(int(n[j]))
                out["tokens"].append(tokens[first[j]: first[j] + n[j]].tobytes())
                out["prefix"].append(prefixes[0][0][prefixes[0][1][j]: prefixes[0][1][j + 1]].view(np.int64))
                out["others"].append([k[b[j]: b[j + 1]].tobytes() for k, b in prefixes[1:]])
        types = (pa.int64(), pa.int64(), pa.binary(), pa.list_(pa.int64()), pa.list_(pa.binary()))
        return pa.table([pa.array(v, t) for v, t in zip(out.values(), types)], names=list(out))
    return order


def ordered_sets(packs: DataFrame, percent: int = PERCENT, seeds: tuple[int, ...] = ORDERS) -> DataFrame:
    """Per distinct set: tokens and its prefix under every order; sets with too few shared tokens are gone."""
    spark = packs.sparkSession
    buckets = max(2 * shuffle_partitions(spark), int(packs.select(F.sum(F.octet_length("tokens")).alias("b")).first()["b"] or 0) // 8 // BUCKET_TOKENS + 1)
    counts = (packs.select("pack", "tokens").mapInArrow(_pack_keys(buckets), "bucket long, pack long, keys binary, times binary")
              .groupBy("bucket").applyInArrow(_count_keys, "pack long, bucket long, df binary"))
    return packs.groupBy("pack").cogroup(counts.groupBy("pack")).applyInArrow(
        _orderer(percent, seeds), "node long, n long, tokens binary, prefix array<long>, others array<binary>")


def _index(sets: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, int]:
    """Inverted index of a list of sets: sorted tokens and their owners."""
    keys = np.concatenate(sets) if len(sets) else np.zeros(0, np.uint64)
    order = np.argsort(keys, kind="stable")
    return keys[order], np.repeat(np.arange(len(sets)), [len(x) for x in sets])[order], len(sets)


def _overlaps(x: np.ndarray, index: tuple[np.ndarray, np.ndarray, int]) -> np.ndarray:
    """Sizes of the intersections of one set with all sets of an index."""
    keys, owner, n = index
    lo, hi = np.searchsorted(keys, x, "left"), np.searchsorted(keys, x, "right")
    length = hi - lo
    at = np.repeat(lo - (np.cumsum(length) - length), length) + np.arange(length.sum())
    return np.bincount(owner[at], minlength=n)


def _verifier(percent: int):
    def verify(rows: pa.Table) -> pa.Table:
        """One pair of tiles of a cell: a spanning forest of its links.

        One set at a time meets the sets it is not yet linked with, so memory is bounded by the tiles' tokens
        however short the sets are.
        """
        node = rows["node"].to_numpy()
        _, one = np.unique(node, return_index=True)
        rows, node = rows.take(pa.array(one)), node[one]
        tile, i, j = rows["tile"].to_numpy(), rows["i"][0].as_py(), rows["j"][0].as_py()
        sets = [np.frombuffer(x, np.uint64) for x in rows["tokens"].to_pylist()]
        firsts = [np.array(x, np.int64).view(np.uint64) for x in rows["prefix"].to_pylist()]
        others = rows["others"].to_pylist()
        a, b = np.flatnonzero(tile == i), np.flatnonzero(tile == j)
        n = np.array([len(s) for s in sets])
        filters = [firsts] + [[np.frombuffer(x[o], np.uint64) for x in others] for o in range(len(others[0]) if others else 0)]
        indexes = [_index([f[y] for y in b]) for f in filters]
        every = _index([sets[y] for y in b])
        tree = np.arange(len(node))
        left, right = [], []
        for x in a.tolist():
            passed = (tree[b] != tree[x]) & (100 * np.minimum(n[x], n[b]) >= percent * np.maximum(n[x], n[b]))
            for f, index in zip(filters, indexes):
                if passed.any():
                    passed &= _overlaps(f[x], index) > 0
            if not passed.any():
                continue
            common = _overlaps(sets[x], every)
            hit = b[passed & (100 * common >= percent * (n[x] + n[b] - common))]
            trees, first = np.unique(tree[hit], return_index=True)
            if len(trees):
                left += [int(node[x])] * len(trees)
                right += node[hit[first]].tolist()
                to = np.arange(len(node))
                to[trees] = tree[x]
                tree = to[tree]
        return pa.table([pa.array(left, pa.int64()), pa.array(right, pa.int64())], names=["a", "b"])
    return verify


def _links(sets: DataFrame, percent: int) -> DataFrame:
    """A spanning forest of the links between ``sets`` (see ``ordered_sets``)."""
    prefix = sets.select("node", F.explode("prefix").alias("token"))
    pivots = prefix.groupBy("token").agg(F.min("node").alias("pivot"), F.max("node").alias("last")).where("pivot <> last").drop("last")
    edges = prefix.join(pivots, "token").where("node <> pivot").select("pivot", "node").distinct()
    cells = connected_components(edges, "pivot", "node")
    cells = shared(sets.join(cells.select(F.col("id").alias("node"), F.col("component").alias("cell")), "node"), "cells")
    tiles = cells.groupBy("cell").agg(F.ceil(F.sum("n") / TILE_TOKENS).alias("tiles"))
    placed = cells.join(tiles, "cell").withColumn("tile", F.pmod(F.xxhash64("node"), "tiles"))
    pairs = (placed.withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("tiles") - 1)))
             .withColumn("i", F.least("tile", "other")).withColumn("j", F.greatest("tile", "other")).drop("other", "tiles"))
    pairs = pairs.repartition("cell", "i", "j")  # else the join on the cell would keep a big cell's tiles in one task
    return pairs.groupBy("cell", "i", "j").applyInArrow(_verifier(percent), "a long, b long")


def jaccard_components(docs: DataFrame, shingle: int = SHINGLE, percent: int = PERCENT, seeds: tuple[int, ...] = ORDERS) -> DataFrame:
    """``(doc_id, n_shingles, component_id)`` for every row of ``docs(doc_id, text)``."""
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    sets = shared(shingle_sets(docs, shingle, percent), "shingle-sets")
    copies = sets.where("alive").groupBy("s1", "s2").agg(F.min("doc_id").alias("doc_id"))
    packs = shared(_id_filter(docs, copies.select("doc_id")).mapInArrow(
        _packer(shingle), "pack long, nodes binary, counts binary, tokens binary"), "shingle-packs")
    ordered = shared(ordered_sets(packs, percent, seeds), "shingle-orders")
    found = connected_components(shared(_links(ordered, percent), "shingle-links"), "a", "b").select(F.col("id").alias("s1"), "component")
    label = copies.join(found, "s1", "left").withColumn("component", F.coalesce("component", F.col("s1")))
    smallest = label.groupBy("component").agg(F.min("doc_id").alias("label"))
    label = label.join(smallest, "component").select("s1", "s2", "label")
    return (sets.join(label, ["s1", "s2"], "left")
            .select("doc_id", F.col("n").alias("n_shingles"),
                    F.when(F.col("n") > 0, F.coalesce("label", "doc_id")).otherwise(F.col("doc_id")).alias("component_id")))
