"""Language-model scoring with a log-frequency Bloom filter.

Training counts of words and word pairs are quantised to levels (level ``q`` holds counts from ``base**(q-1)`` up
to ``base**q``) and an n-gram of level ``q`` is stored as the members ``(n-gram, 1) .. (n-gram, q)`` of a Bloom
filter.  A count is read by probing levels until one is absent, so errors only ever raise a level, with a
probability that falls by the filter's error rate a level.

The filter is cut into segments by hash.  One reduce task counts one segment's n-grams and sets its bits, so no
task or driver ever holds the counts; only finished segments are gathered and broadcast, at most
``MAX_FILTER_BYTES`` at once.  A larger filter is broadcast in several rounds over the documents, each of which
reads the levels of the n-grams in its segments; the result is the same for any number of rounds.

The model interpolates: ``p(w|h) = (1 - l) c(hw) / c(h) + l (c(w) + 1) / (N + V + 1)``, all counts read from the
filter.  ``l`` depends on the level of ``c(h)`` and is set by deleted interpolation over all training tokens:
each votes for the pair or for the single word, whichever predicts it better when it is itself taken out.

``base_score`` needs exact counts of single words.  They come without a broadcast: every map-side chunk of
documents sends its distinct words to hash buckets, gets their total counts back, and sums its documents.

Defined results.  Null text: as empty, the end token alone.  A null ``doc_id`` counts as the id text "".
Repeated rows are scored alike, each trains if its id does.  Without training rows all counts are 0 and scores
are those of a uniform guess.  Empty table: no rows.  Further columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import words as W
from .common import binary_column, crc32_of_id, released, shared, shuffle_partitions, total_bytes, unpack

BASES = (1.2, 1.5)              # quantisation bases of words and of pairs
HASHES = 4                      # bits set for a member
MAX_FILTER_BYTES = 128 << 20    # broadcast at once
CHUNK_TOKENS = 3 << 19
BUCKET_TOKENS = 2 << 20
LEVELS = 256                    # a level fits a byte; 1.2**255 is beyond any count

_END, _START = (W.mix(np.array([x], np.uint64))[0] for x in (0xE17D, 0x57A7))
_LOW = W.U64(0xFFFFFFFF)


def held_out(doc_id) -> F.Column:
    return F.pmod(crc32_of_id(doc_id), F.lit(7)) == 2


def token_keys(data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Keys of the lower-cased words of every text, each text followed by the end token; tokens per text."""
    keys, first = W.word_keys(data, off, True)
    counts = np.diff(first) + 1
    out = np.insert(keys, first[1:], _END)
    return out, counts


def pair_keys(tokens: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """``(context, pair)`` key of every token; the first of a text follows the start mark."""
    context = np.empty_like(tokens)
    context[1:] = tokens[:-1]
    context[np.cumsum(counts) - counts] = _START
    return context, W.mix(context * W.U64(0x9E3779B97F4A7C15) + tokens)


def _bucket(keys: np.ndarray, buckets: int) -> np.ndarray:
    return ((keys >> W.U64(32)) * W.U64(buckets)) >> W.U64(32)


def level_of(counts: np.ndarray, base: float) -> np.ndarray:
    return 1 + np.floor(np.log(np.maximum(counts, 1)) / np.log(base) + 1e-9).astype(np.int64)


def counts_of_levels(base: float) -> np.ndarray:
    """Mean of the whole numbers of every level (level 0: 0)."""
    q = np.arange(LEVELS)
    low, high = np.ceil(base ** (q - 1.0) - 1e-6), np.ceil(base**q - 1e-6) - 1
    out = np.where(high >= low, (low + high) / 2, base ** (q - 0.5))
    out[0] = 0
    return out


def _positions(identity: np.ndarray, level: int, bits: np.ndarray | np.uint64) -> Iterator[np.ndarray]:
    """The bit positions of ``(n-gram, level)`` in segments of ``bits`` bits (fewer than 2**32)."""
    x = W.mix(identity + W.U64(level * 0xD1B54A32D192ED03 % 2**64))
    a, b = x & _LOW, (x >> W.U64(32)) | W.U64(1)
    for i in range(HASHES):
        yield (((a + W.U64(i) * b) & _LOW) * bits) >> W.U64(32)


def build_segment(identity: np.ndarray, levels: np.ndarray) -> bytes:
    """Bits of the members ``(n-gram, 1..level)`` of one segment."""
    bits = max(64, -(-int(levels.sum() * HASHES / np.log(2)) // 64) * 64)
    mark = np.zeros(bits, bool)
    for level in range(1, int(levels.max(initial=0)) + 1):
        own = identity[levels >= level]
        for at in _positions(own, level, W.U64(bits)):
            mark[at] = True
    return np.packbits(mark, bitorder="little").tobytes()


class Filter:
    """Some segments of the filter of one n-gram order, ready to be probed."""

    def __init__(self, buckets: int, segments: list[tuple[int, bytes]]):
        self.buckets = buckets
        self.start, self.bits = np.zeros(buckets, np.uint64), np.zeros(buckets, np.uint64)
        at = 0
        for bucket, raw in segments:
            self.start[bucket], self.bits[bucket] = at, 8 * len(raw)
            at += 8 * len(raw)
        self.data = np.frombuffer(b"".join(raw for _, raw in segments), np.uint8)

    def levels(self, keys: np.ndarray) -> np.ndarray:
        """Level of every key, read by probes; 0 where a key is absent or its segment is not here."""
        keys, back = np.unique(keys, return_inverse=True)
        bucket = _bucket(keys, self.buckets)
        out = np.zeros(len(keys), np.uint8)
        live = np.flatnonzero(self.bits[bucket])
        bucket = bucket[live]
        identity, bits, start = (bucket << W.U64(32)) | (keys[live] & _LOW), self.bits[bucket], self.start[bucket]
        for level in range(1, LEVELS):
            if not len(live):
                break
            member = np.ones(len(live), bool)
            for at in _positions(identity, level, bits):
                at += start
                member &= (self.data[at >> W.U64(3)] >> (at & W.U64(7)).astype(np.uint8)) & 1 == 1
            live, identity, bits, start = (x[member] for x in (live, identity, bits, start))
            out[live] = level
        return out[back]


def _chunks(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple[int, pa.RecordBatch, np.ndarray, np.ndarray]]:
    """``(chunk id, id columns, tokens, tokens per text)`` for runs of documents of bounded size (text is the last column)."""
    part, seq, size = TaskContext.get().partitionId(), 0, 0
    tokens, counts, ids = [], [], []
    for batch in batches:
        for lo, hi, data, off in W.slices(batch.column(batch.num_columns - 1)):
            t, c = token_keys(data, off)
            tokens.append(t), counts.append(c), ids.append(batch.slice(lo, hi - lo).select(list(range(batch.num_columns - 1))))
            size += len(t)
            if size >= CHUNK_TOKENS:
                yield part << 32 | seq, pa.Table.from_batches(ids), np.concatenate(tokens), np.concatenate(counts)
                tokens, counts, ids, size, seq = [], [], [], 0, seq + 1
    if ids:
        yield part << 32 | seq, pa.Table.from_batches(ids), np.concatenate(tokens), np.concatenate(counts)


_ROWS = "kind int, bucket long, chunk long, a binary, b binary, c binary"
_NAMES = ["kind", "bucket", "chunk", "a", "b", "c"]


def _blob(*rows: bytes) -> pa.Array:
    return pa.array(list(rows), pa.binary())


def _terms(words: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``(distinct words by text, how often each occurs, distinct words of each text)``."""
    words, end = words.copy(), np.cumsum(counts)
    for a, b in zip((end - counts).tolist(), end.tolist()):
        words[a:b].sort()
    new = np.ones(len(words), bool)
    np.not_equal(words[1:], words[:-1], out=new[1:])
    new[end - counts] = True  # every text has its end token
    at = np.flatnonzero(new)
    return words[at], np.diff(np.append(at, len(words))), np.diff(np.searchsorted(at, np.append(0, end)))


def _emit_words(buckets: int):
    def emit(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for chunk, ids, tokens, counts in _chunks(batches):
            held = ids["held"].to_numpy()
            keys, which = np.unique(tokens, return_inverse=True)
            doc = np.repeat(np.arange(len(counts)), counts)
            trained = np.bincount(which[~held[doc]], minlength=len(keys)).astype(np.uint32)
            term, times, per_doc = _terms(which.astype(np.uint32), counts)
            here, at = np.unique(_bucket(keys, buckets), return_index=True)
            bounds = np.append(at, len(keys))
            m = len(here)
            yield pa.RecordBatch.from_arrays([
                pa.array(np.append(np.zeros(m, np.int32), 1).astype(np.int32)), pa.array(np.append(here.astype(np.int64), -1 - chunk % buckets)),
                pa.array(np.full(m + 1, chunk)),
                pa.concat_arrays([binary_column(keys, bounds), _blob(np.stack([ids["id"].to_numpy(), ids["h"].to_numpy(), held.astype(np.int64),
                                                                              per_doc]).tobytes())]),
                pa.concat_arrays([binary_column(trained, bounds), _blob(term.tobytes())]),
                pa.concat_arrays([_blob(*[b""] * m), _blob(times.astype(np.uint32).tobytes())])], names=_NAMES)
    return emit


def _total_words(base: float):
    def total(rows: pa.Table) -> pa.Table:
        """One bucket: the total counts of every chunk's words; its vocabulary and filter segment as one more row."""
        if rows["kind"][0].as_py() == 1:
            return rows
        keys, bounds = unpack(rows["a"], np.uint64)
        trained, _ = unpack(rows["b"], np.uint32)
        words, which = np.unique(keys, return_inverse=True)
        total = np.bincount(which, trained, minlength=len(words)).astype(np.int64)
        bucket, m = rows["bucket"][0].as_py(), rows.num_rows
        known = total > 0
        identity = (W.U64(bucket) << W.U64(32)) | (words[known] & _LOW)
        segment = build_segment(identity, level_of(total[known], base))
        return pa.table([
            pa.array([0] * m + [2], pa.int32()), pa.array([bucket] * (m + 1)), pa.array([*rows["chunk"].to_pylist(), -1 - bucket]),
            pa.concat_arrays([binary_column(total[which].astype(np.uint32), bounds), _blob(segment)]),
            _blob(*[b""] * m, np.int64(known.sum()).tobytes()), _blob(*[b""] * (m + 1))], names=_NAMES)
    return total


def _sum_documents(rows: pa.Table) -> pa.Table:
    """One chunk: its documents' sums over the exact counts; a bucket's own row passes."""
    names = ["kind", "bucket", "id", "h", "n_tokens", "n_known", "log_sum", "segment", "vocabulary"]
    kind = rows["kind"].to_numpy()
    if (kind == 2).any():
        at = int(np.flatnonzero(kind == 2)[0])
        values = [2, rows["bucket"][at].as_py(), None, None, None, None, None, rows["a"][at].as_py(), int(np.frombuffer(rows["b"][at].as_py(), np.int64)[0])]
        types = (pa.int32(), *[pa.int64()] * 5, pa.float64(), pa.binary(), pa.int64())
        return pa.table([pa.array([v], t) for v, t in zip(values, types)], names=names)
    at = int(np.flatnonzero(kind == 1)[0])
    total, _ = unpack(rows.filter(pa.array(kind == 0)).sort_by("bucket")["a"], np.uint32)
    doc_id, h, _, terms = np.frombuffer(rows["a"][at].as_py(), np.int64).reshape(4, -1)
    word, times = (np.frombuffer(rows[c][at].as_py(), np.uint32) for c in ("b", "c"))
    doc, nd = np.repeat(np.arange(len(doc_id)), terms), len(doc_id)
    c = total[word].astype(np.float64)
    n, known = (np.bincount(doc, x, minlength=nd).astype(np.int64) for x in (times, times * (c > 0)))
    none = pa.nulls(nd, pa.int64())
    return pa.table([pa.array(np.ones(nd, np.int32)), none, pa.array(doc_id), pa.array(h), pa.array(n), pa.array(known),
                     pa.array(np.bincount(doc, times * np.log10(c + 1), minlength=nd)), pa.nulls(nd, pa.binary()), none], names=names)


def _emit_pairs(buckets: int):
    def emit(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for chunk, _, tokens, counts in _chunks(batches):
            keys, times = np.unique(pair_keys(tokens, counts)[1], return_counts=True)
            here, at = np.unique(_bucket(keys, buckets), return_index=True)
            bounds, m = np.append(at, len(keys)), len(here)
            yield pa.RecordBatch.from_arrays([
                pa.array(np.full(m, 3, np.int32)), pa.array(here.astype(np.int64)), pa.array(np.full(m, chunk)),
                binary_column(keys.astype(np.uint32), bounds), binary_column(times.astype(np.uint32), bounds), _blob(*[b""] * m)], names=_NAMES)
    return emit


def _pair_segment(base: float):
    def segment(rows: pa.Table) -> pa.Table:
        keys, _ = unpack(rows["a"], np.uint32)
        times, _ = unpack(rows["b"], np.uint32)
        pairs, which = np.unique(keys, return_inverse=True)
        bucket = rows["bucket"][0].as_py()
        raw = build_segment((W.U64(bucket) << W.U64(32)) | pairs.astype(np.uint64), level_of(np.bincount(which, times), base))
        return pa.table([pa.array([bucket]), _blob(raw)], names=["bucket", "segment"])
    return segment


def _rounds(words: DataFrame, pairs: DataFrame, limit: int) -> list[list[tuple[int, int]]]:
    """``(order, bucket)`` groups whose segments together take at most ``limit`` bytes."""
    sizes = [(order, r["bucket"], r["n"]) for order, df in ((1, words), (2, pairs)) for r in
             df.select("bucket", F.octet_length("segment").alias("n")).orderBy("bucket").collect()]
    groups, size = [[]], 0
    for order, bucket, n in sizes:
        if groups[-1] and size + n > limit:
            groups.append([])
            size = 0
        groups[-1].append((order, bucket))
        size += n
    return groups


def _read_levels(docs: DataFrame, filters) -> DataFrame:
    """``docs(id, h, held, words, pairs, text)`` with the levels of this round's n-grams added to ``words`` and ``pairs``."""
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        buckets, *segments = filters.value  # plain numbers and bytes
        one, two = (Filter(buckets, s) for s in segments)
        for batch in batches:
            for lo, hi, data, off in W.slices(batch.column(5)):
                rows = batch.slice(lo, hi - lo)
                tokens, counts = token_keys(data, off)
                bounds = np.append(0, np.cumsum(counts))
                found = []
                for column, levels in ((3, one.levels(tokens)), (4, two.levels(pair_keys(tokens, counts)[1]))):
                    if rows.column(column).null_count < len(rows):
                        levels = levels + np.frombuffer(b"".join(rows.column(column).to_pylist()), np.uint8)
                    found.append(binary_column(levels, bounds))
                yield pa.RecordBatch.from_arrays([*rows.columns[:3], *found, rows.column(5)], names=["id", "h", "held", "words", "pairs", "text"])
    return docs.mapInArrow(run, "id long, h long, held boolean, words binary, pairs binary, text string")


def _contexts(words: np.ndarray, counts: np.ndarray, start: int) -> np.ndarray:
    """Level of every token's context (the word before; the start mark has the level of the number of texts)."""
    out = np.empty_like(words)
    out[1:] = words[:-1]
    out[np.cumsum(counts) - counts] = start
    return out


def _with_levels(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple]:
    for batch in batches:
        for lo in range(0, batch.num_rows, 500):
            rows = batch.slice(lo, 500)
            raw = [rows.column(i).to_pylist() for i in (3, 4)]
            counts = np.array([len(x) for x in raw[0]], np.int64)
            yield rows, counts, *(np.frombuffer(b"".join(x), np.uint8).astype(np.int64) for x in raw)


def _votes(levelled: DataFrame, n: int, start: int) -> np.ndarray:
    """Per context level: training tokens that, taken out, are better predicted by the word alone, and all tokens."""
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        one, two = (counts_of_levels(b) for b in BASES)
        votes = np.zeros((2, LEVELS))
        for rows, counts, words, pairs in _with_levels(batches):
            context = _contexts(words, counts, start)
            train = np.repeat(~rows.column(2).to_numpy(zero_copy_only=False), counts)
            c, cw, cp = one[context], one[words], two[pairs]
            alone = (cw - 1) * np.maximum(c - 1, 1) >= np.minimum(cp - 1, c - 1) * max(n - 1, 1)
            votes += [np.bincount(context[train & alone], minlength=LEVELS), np.bincount(context[train], minlength=LEVELS)]
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(LEVELS)), *map(pa.array, votes)], names=["level", "alone", "every"])
    rows = levelled.mapInArrow(run, "level long, alone double, every double").groupBy("level").agg(F.sum("alone").alias("alone"), F.sum("every").alias("every"))
    out = np.zeros((2, LEVELS))
    for r in rows.collect():  # LEVELS rows
        out[:, r["level"]] = r["alone"], r["every"]
    return out


def scored(docs: DataFrame, max_filter_bytes: int = MAX_FILTER_BYTES) -> DataFrame:
    """Scores of every row of ``docs(doc_id, text)`` under a model of those that are not held out."""
    spark = docs.sparkSession
    low = -(1 << 63)
    docs = docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(low)).alias("id"), F.xxhash64(F.coalesce("text", F.lit(""))).alias("h"),
                       held_out(F.col("doc_id")).alias("held"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    tokens = total_bytes(docs) // 6
    buckets = max(2 * shuffle_partitions(spark), tokens // BUCKET_TOKENS + 1)

    counted = docs.mapInArrow(_emit_words(buckets), _ROWS).groupBy("kind", "bucket").applyInArrow(_total_words(BASES[0]), _ROWS)
    base = shared(counted.groupBy("chunk").applyInArrow(
        _sum_documents, "kind int, bucket long, id long, h long, n_tokens long, n_known long, log_sum double, segment binary, vocabulary long"), "lm-words")
    train = docs.where("not held")
    pairs = shared(train.mapInArrow(_emit_pairs(buckets), _ROWS).groupBy("bucket").applyInArrow(_pair_segment(BASES[1]), "bucket long, segment binary"), "lm-pairs")

    vocabulary = int(base.agg(F.sum("vocabulary")).first()[0] or 0)
    rows = base.where("kind = 1").select("id", "h", "n_tokens", "n_known", "log_sum")
    trained = rows.where(~held_out(F.when(F.col("id") != low, F.col("id")))).agg(F.sum("n_tokens"), F.count("*")).first()
    n, texts = int(trained[0] or 0), int(trained[1])
    start = int(level_of(np.array([texts]), BASES[0])[0]) if texts else 0
    words = base.where("kind = 2").select("bucket", "segment")

    # One round a group of segments: its broadcast is the only one alive, and goes when the round's table is written.
    levelled = docs.select("id", "h", "held", F.lit(None).cast("binary").alias("words"), F.lit(None).cast("binary").alias("pairs"), "text")
    groups = _rounds(words, pairs, max_filter_bytes)
    for i, group in enumerate(groups):
        parts = []
        for order, df in ((1, words), (2, pairs)):
            own = [b for o, b in group if o == order]
            got = df.where(F.col("bucket").between(own[0], own[-1])).toArrow() if own else pa.table({"bucket": [], "segment": []})
            parts.append(list(zip(got["bucket"].to_pylist(), got["segment"].to_pylist())))
        filters = spark.sparkContext.broadcast((buckets, *parts))
        found = _read_levels(levelled, filters)
        before, levelled = levelled, shared(found if i < len(groups) - 1 else found.drop("text"), "lm-levels")
        filters.destroy()
        if i:
            released(before)
    alone, every = _votes(levelled, n, start)
    weight = (alone + 1) / (every + 2)  # add-one: a level without votes is split evenly

    def score(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        one, two = (counts_of_levels(b) for b in BASES)
        for rows, counts, w, p in _with_levels(batches):
            context = _contexts(w, counts, start)
            c = one[context]
            pair = np.where(c > 0, np.minimum(two[p], c) / np.maximum(c, 1), 0)
            share = np.where(c > 0, weight[context], 1.0)
            log = np.log10((1 - share) * pair + share * (one[w] + 1) / (n + vocabulary + 1))
            total = np.append(0, np.cumsum(log))
            end = np.cumsum(counts)
            yield pa.RecordBatch.from_arrays([*rows.columns[:3], pa.array(total[end] - total[end - counts])], names=["id", "h", "held", "score"])
    scores = levelled.mapInArrow(score, "id long, h long, held boolean, score double")
    once = rows.dropDuplicates(["id", "h"])
    return (scores.join(once, ["id", "h"])
            .select(F.when(F.col("id") != low, F.col("id")).alias("doc_id"), F.col("held").alias("held_out"), "n_tokens", "n_known",
                    F.lit(n).cast("long").alias("train_tokens"),
                    (F.col("log_sum") - F.col("n_tokens") * F.log10(F.lit(float(n + vocabulary + 1)))).alias("base_score"), "score"))
