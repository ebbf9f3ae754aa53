"""Cross-tokenizer alignment: two tokenisations of one text, merged in lockstep.

The tokens of A and B cut the same bytes.  All documents of a chunk are merged at once: one NumPy state vector
holds an A pointer and a B pointer per lane, every step emits the link between the two tokens of each lane,
advances the pointer whose token ends first (both at a common end, which is a cut) and compacts the lanes that
are done.  A document is one lane; a longer one is cut into lanes at offsets where both tokens end, so the
number of steps stays near ``LANE_BYTES`` / (bytes a token) whatever the texts are.

Corpus-wide counts (in how many documents an id pair is linked) never meet a document by itself: a chunk of
about ``CHUNK_BYTES`` of text lists its distinct pairs once, the counts are summed by pair, marked where they
are the highest of their A id, and returned to the chunk.  No vocabulary or pair table is broadcast or collected.

Special tokens inside texts are plain text.  Defined results: a null or empty text has no tokens, so
zeros and an empty digest; so has one whose tokens' bytes differ from a space and the text, as with a literal
U+2581.  Repeated rows count as so many documents, null ids are kept.  Ties for the highest count are all best.  Columns but the id and the text are not used.  An
empty table gives no rows.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import words as W
from .bpe import Bpe
from .common import shared

CHUNK_BYTES = 2 << 20   # text of one chunk, at least one document
LANE_BYTES = 2048       # a lane ends at the first common end after so many bytes
CACHE_FRAGMENTS = 300_000  # fragments that the piece tokenizer's cache holds, per process
LEARN_BYTES = 1 << 15   # text that the piece tokenizer gets at once
_NEXT_ENDS = 32         # A ends that are tried for a lane's end

_BYTE_PIECE = re.compile(r"<0x([0-9A-F]{2})>")


class Tokenizers:
    """Tokenizer A (byte-level BPE file) and B (piece model), with the bytes of every token."""

    def __init__(self, path_a: str, path_b: str):
        import sentencepiece
        self.a = Bpe(path_a)
        self.a.special = {}  # their strings are plain text here
        self.bytes_a = self.a.token_bytes
        self.b = sentencepiece.SentencePieceProcessor(model_file=path_b)
        pieces = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        self.bytes_b = [bytes([int(m[1], 16)]) if (m := _BYTE_PIECE.fullmatch(p)) and self.b.is_byte(i)
                        else p.replace("▁", " ").encode() for i, p in enumerate(pieces)]
        # No piece holds a space behind another character: a text falls apart wherever a run of spaces begins.
        self.cuttable = not any("▁" in p.lstrip("▁") for p in pieces)
        self.cache: dict[bytes, bytes] = {}
        self.space = self.b.piece_to_id("▁")
        self.size_a = np.array([len(t) for t in self.bytes_a], np.int64)
        self.size_b = np.array([len(t) for t in self.bytes_b], np.int64)
        n = max(len(self.bytes_a), len(self.bytes_b))
        self.decimal = [b"%d%s" % (i, mark) for i in range(n) for mark in (b",", b"|", b";")]

    def _learn_b(self, new: list[bytes]) -> None:
        """Encode fragments, many behind one another in one text: its tokens end where the fragments do."""
        size = np.array([len(f) for f in new], np.int64)
        group = (np.cumsum(size) - size) // LEARN_BYTES if self.cuttable else np.arange(len(new))
        bounds = np.append(np.searchsorted(group, np.unique(group)), len(new)).tolist()
        texts = [b"".join(new[x:y]) for x, y in zip(bounds, bounds[1:])]
        for x, y, t, ids in zip(bounds, bounds[1:], texts, self.b.encode([t[1:].decode() for t in texts], num_threads=1)):
            ids = np.array(ids, np.uint32)
            end = np.cumsum(self.size_b[ids])
            cut = np.cumsum(size[x:y])
            at = np.searchsorted(end, cut) + 1
            if len(end) and end[-1] == len(t) and (end[at - 1] == cut).all():
                for f, a, b in zip(new[x:y], [0, *at.tolist()], at.tolist()):
                    self.cache[f] = ids[a:b].tobytes()
            else:  # a literal U+2581, or nothing behind the space (B gives an empty text no token)
                for f in new[x:y]:
                    self.cache[f] = np.array(self.b.encode(f[1:].decode()) if len(f) > 1 else [self.space], np.uint32).tobytes()

    def encode_b(self, column: pa.Array) -> Iterator[np.ndarray]:
        """Ids of B for every text of a column whose texts begin with the space that B would add."""
        for _, _, data, off in W.slices(column):
            begin = np.zeros(len(data), bool)
            if self.cuttable:
                begin = data == 0x20
                begin[1:] &= data[:-1] != 0x20
            begin[off[:-1]] = True
            cuts = np.append(np.flatnonzero(begin), len(data))
            raw, place = data.tobytes(), cuts.tolist()
            fragments = [raw[x:y] for x, y in zip(place, place[1:])]
            if len(self.cache) > CACHE_FRAGMENTS:
                self.cache.clear()
            found = list(map(self.cache.get, fragments))
            if None in found:
                self._learn_b(list({f for f, known in zip(fragments, found) if known is None}))
                found = list(map(self.cache.__getitem__, fragments))
            first = np.searchsorted(cuts, off).tolist()
            for x, y in zip(first, first[1:]):
                yield np.frombuffer(b"".join(found[x:y]), np.uint32)

    def encode(self, texts: list[str | None]) -> tuple[list[np.ndarray], list[np.ndarray]]:
        """Ids of A and B per text; both empty where the text is, or where the tokens' bytes are not those of a space and the text."""
        none = np.zeros(0, np.uint32)
        out_a, out_b = [none] * len(texts), [none] * len(texts)
        some = [i for i, t in enumerate(texts) if t]
        raw = [" " + texts[i] for i in some]
        column = pa.array(raw, pa.string())
        for i, t, a, b in zip(some, raw, self.a.encode(column), self.encode_b(column)):
            data = t.encode()
            if (b"".join([self.bytes_a[x] for x in a.tolist()]) == data
                    and b"".join([self.bytes_b[x] for x in b.tolist()]) == data):
                out_a[i], out_b[i] = a, b
        return out_a, out_b


def lanes(end_a: np.ndarray, end_b: np.ndarray, first_a: np.ndarray, first_b: np.ndarray,
          lane_bytes: int = LANE_BYTES) -> tuple[np.ndarray, np.ndarray]:
    """First A and B tokens of the lanes: the documents' first tokens, and in longer documents the token behind
    the first common end after every ``lane_bytes`` bytes (among the next ``_NEXT_ENDS`` ends of A)."""
    start = np.concatenate([[0], end_a])[first_a]
    i, j = [first_a[:-1][np.diff(first_a) > 0]], [first_b[:-1][np.diff(first_a) > 0]]
    parts = np.diff(start) // lane_bytes
    step = np.arange(parts.sum()) - np.repeat(np.cumsum(parts) - parts, parts) + 1
    want = np.repeat(start[:-1], parts) + step * lane_bytes
    limit = np.repeat(start[1:], parts)
    at = np.searchsorted(end_a, want)
    todo = np.arange(len(want))
    for _ in range(_NEXT_ENDS):
        todo = todo[at[todo] < len(end_a)]
        todo = todo[end_a[at[todo]] < limit[todo]]
        if not len(todo):
            break
        place = np.searchsorted(end_b, end_a[at[todo]])
        same = end_b[place] == end_a[at[todo]]
        i.append(at[todo[same]] + 1), j.append(place[same] + 1)
        todo = todo[~same]
        at[todo] += 1
    i, j = np.concatenate(i), np.concatenate(j)
    i, once = np.unique(i, return_index=True)
    return i, j[once]


def lockstep(end_a: np.ndarray, end_b: np.ndarray, i: np.ndarray, j: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Merge all lanes together: ``(A token, B token, cut)`` of every link.

    ``i``, ``j``: first tokens of the lanes, ascending, together covering all tokens; a lane ends where the next begins."""
    stop = np.append(i[1:], len(end_a))
    links_a, links_b, cuts = [], [], []
    while len(i):
        a, b = end_a[i], end_b[j]
        links_a.append(i), links_b.append(j), cuts.append(a == b)
        i, j = i + (a <= b), j + (b <= a)
        live = i < stop
        if not live.all():
            i, j, stop = i[live], j[live], stop[live]
    if not links_a:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, bool)
    return np.concatenate(links_a), np.concatenate(links_b), np.concatenate(cuts)


class Alignment:
    """Documents of one chunk, aligned: tokens, links and groups, numbered over the whole chunk."""

    def __init__(self, tokens: Tokenizers, texts: list[str | None], lane_bytes: int = LANE_BYTES):
        ids_a, ids_b = tokens.encode(texts)
        self.first_a = np.concatenate([[0], np.cumsum([len(x) for x in ids_a])]).astype(np.int64)
        self.first_b = np.concatenate([[0], np.cumsum([len(x) for x in ids_b])]).astype(np.int64)
        none = [np.zeros(0, np.uint32)]
        self.a, self.b = (np.concatenate(x + none).astype(np.int64) for x in (ids_a, ids_b))
        self.end_a, self.end_b = np.cumsum(tokens.size_a[self.a]), np.cumsum(tokens.size_b[self.b])
        self.link_a, self.link_b, cut = lockstep(self.end_a, self.end_b, *lanes(self.end_a, self.end_b, self.first_a, self.first_b, lane_bytes))
        self.last_a, self.last_b = np.zeros(len(self.a), bool), np.zeros(len(self.b), bool)  # last of its group
        self.last_a[self.link_a[cut]] = True
        self.last_b[self.link_b[cut]] = True
        self.group_a, self.group_b = (np.cumsum(x) - x for x in (self.last_a, self.last_b))
        self.text = np.repeat(np.arange(len(texts)), np.diff(self.first_a))  # of every A token
        self.tokens = tokens

    def per_text(self, flags: np.ndarray, first: np.ndarray) -> np.ndarray:
        return np.diff(np.concatenate([[0], np.cumsum(flags)])[first])

    def digests(self) -> list[str]:
        """sha256 of every text's groups as ``a1,a2|b1;a3|b2,b3``; an empty string for a text without tokens."""
        groups = int(self.last_a.sum())
        before_b = np.concatenate([[0], np.cumsum(np.bincount(self.group_b, minlength=groups))])  # B tokens of earlier groups
        until_a = np.cumsum(np.bincount(self.group_a, minlength=groups))                        # A tokens up to a group
        code = np.empty(len(self.a) + len(self.b), np.int64)
        code[np.arange(len(self.a)) + before_b[self.group_a]] = self.a * 3 + self.last_a
        code[np.arange(len(self.b)) + until_a[self.group_b]] = self.b * 3 + 2 * self.last_b
        bounds = (self.first_a + self.first_b).tolist()
        table = self.tokens.decimal
        return [hashlib.sha256(b"".join([table[c] for c in code[lo:hi].tolist()])[:-1]).hexdigest() if hi > lo else ""
                for lo, hi in zip(bounds, bounds[1:])]

    def pairs(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """``(text, pair, links)``: how often every text links an id pair, ascending; a pair is ``a * size of B + b``."""
        span = len(self.tokens.size_a) * len(self.tokens.size_b)
        key = self.text[self.link_a] * span + self.a[self.link_a] * len(self.tokens.size_b) + self.b[self.link_b]
        key, links = np.unique(key, return_counts=True)
        return *np.divmod(key, span), links


def load(path_a: str, path_b: str) -> Tokenizers:
    kept = W.process_cache("align")
    if (path_a, path_b) not in kept:
        kept[path_a, path_b] = Tokenizers(path_a, path_b)
    return kept[path_a, path_b]


def default_paths() -> tuple[str, str]:
    import public_tokenizers
    return public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")


def _chunks(batches: Iterable[pa.RecordBatch], chunk_bytes: int) -> Iterator[pa.RecordBatch]:
    """Rows of ``(..., text)`` in chunks of about ``chunk_bytes`` of text, at least one row."""
    held, size = [], 0
    for b in batches:
        data, off = W.utf8(b.column(b.num_columns - 1))
        lo = 0
        while lo < b.num_rows:
            hi = int(np.searchsorted(off, off[lo] + max(chunk_bytes - size, 0), "right")) - 1
            if hi <= lo:
                if held:  # full
                    yield _joined(held)
                    held, size = [], 0
                    continue
                hi = lo + 1
            held.append(b.slice(lo, hi - lo))
            size += int(off[hi] - off[lo])
            lo = hi
    if held:
        yield _joined(held)


def _joined(held: list[pa.RecordBatch]) -> pa.RecordBatch:
    return pa.Table.from_batches(held).combine_chunks().to_batches()[0]


def alignments(docs: DataFrame, paths: tuple[str, str] | None = None, lane_bytes: int = LANE_BYTES) -> DataFrame:
    """The operator's plain output: per document both token lists, the group of every token (numbered from 0) and
    all links as positions in the two lists."""
    path_a, path_b = paths or default_paths()

    def run(batches):
        tokens = load(path_a, path_b)
        for b in _chunks(batches, CHUNK_BYTES):
            x = Alignment(tokens, b.column(1).to_pylist(), lane_bytes)
            order = np.lexsort((x.link_b, x.link_a))
            link_a, link_b = x.link_a[order], x.link_b[order]
            base_a, base_b = x.first_a[:-1], x.first_b[:-1]
            first_link = np.searchsorted(link_a, x.first_a)
            group = np.append(x.group_a, int(x.last_a.sum()))[x.first_a[:-1]]  # of the text's first token

            def lists(values, first, less):
                return pa.ListArray.from_arrays(pa.array(first, pa.int32()), pa.array(values - np.repeat(less, np.diff(first)), pa.int32()))
            zero = np.zeros(b.num_rows, np.int64)
            yield pa.RecordBatch.from_arrays(
                [b.column(0), lists(x.a, x.first_a, zero), lists(x.b, x.first_b, zero), lists(x.group_a, x.first_a, group),
                 lists(x.group_b, x.first_b, group), lists(link_a, first_link, base_a), lists(link_b, first_link, base_b)],
                names=["doc_id", "a_ids", "b_ids", "a_group", "b_group", "link_a", "link_b"])
    schema = "doc_id bigint, a_ids array<int>, b_ids array<int>, a_group array<int>, b_group array<int>, link_a array<int>, link_b array<int>"
    return _base(docs).mapInArrow(run, schema)


def _base(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))


_FIXED = {"doc_id": pa.int64(), "n_a": pa.int64(), "n_b": pa.int64(), "n_groups": pa.int64(), "n_links": pa.int64(), "groups_sha256": pa.string()}


def _packed(*arrays: np.ndarray) -> bytes:
    return pa.compress(b"".join(x.astype(np.int32).tobytes() for x in arrays), codec="zstd", asbytes=True)


def _chunk_kernel(path_a: str, path_b: str, chunk_bytes: int, lane_bytes: int):
    """Chunk rows: the documents' own figures, the chunk's distinct pairs with the number of documents that hold
    each, and (packed) which of them every document links and how often."""
    def run(batches):
        from pyspark import TaskContext
        task = TaskContext.get().partitionId() if TaskContext.get() else 0
        tokens = load(path_a, path_b)
        for n, b in enumerate(_chunks(batches, chunk_bytes)):
            x = Alignment(tokens, b.column(1).to_pylist(), lane_bytes)
            links = np.bincount(x.text[x.link_a], minlength=b.num_rows)
            text, pair, often = x.pairs()
            pairs, which, holders = np.unique(pair, return_inverse=True, return_counts=True)
            per_text = np.bincount(text, minlength=b.num_rows)
            step = np.diff(which, prepend=0)  # ascending in a text: small numbers
            fixed = [b.column(0), np.diff(x.first_a), np.diff(x.first_b), x.per_text(x.last_a, x.first_a), links, x.digests()]
            yield pa.RecordBatch.from_arrays(
                [pa.array([(task << 33) + n], pa.int64()),
                 *[pa.array([list(c) if not isinstance(c, pa.Array) else c.to_pylist()], pa.list_(t)) for c, t in zip(fixed, _FIXED.values())],
                 pa.ListArray.from_arrays(pa.array([0, len(pairs)], pa.int32()), pa.array(pairs, pa.int64())),
                 pa.ListArray.from_arrays(pa.array([0, len(pairs)], pa.int32()), pa.array(holders, pa.int64())),
                 pa.array([len(step)], pa.int64()), pa.array([_packed(per_text, step, often)], pa.binary())],
                names=["chunk", *_FIXED, "pair", "holders", "n_used", "used"])
    return run


_CHUNK_SCHEMA = ("chunk bigint, doc_id array<bigint>, n_a array<bigint>, n_b array<bigint>, n_groups array<bigint>, "
                 "n_links array<bigint>, groups_sha256 array<string>, pair array<bigint>, holders array<bigint>, n_used bigint, used binary")


def _return_kernel(batches):
    """Counts that came back to a chunk, applied to its documents."""
    for b in batches:
        for r in range(b.num_rows):
            col = {name: b.column(k)[r] for k, name in enumerate(b.schema.names)}
            fixed = [col[c].values for c in _FIXED]
            n, used = len(fixed[0]), col["n_used"].as_py()
            raw = np.frombuffer(pa.decompress(col["used"].as_py(), decompressed_size=4 * (n + 2 * used), codec="zstd", asbytes=True), np.int32)
            which, often = np.cumsum(raw[n: n + used], dtype=np.int64), raw[n + used:].astype(np.int64)
            bounds = np.concatenate([[0], np.cumsum(raw[:n], dtype=np.int64)])
            told = col["told"].values.to_numpy(zero_copy_only=False) if used else np.zeros(0, np.int64)

            def total(values):
                return np.diff(np.concatenate([[0], np.cumsum(values)])[bounds])
            out = [total(often * (told[which] & 1)), total(often * (told[which] >> 1))] if used else [np.zeros(n, np.int64)] * 2
            yield pa.RecordBatch.from_arrays([*fixed[:-1], pa.array(out[0]), pa.array(out[1]), fixed[-1]],
                                             names=[*list(_FIXED)[:-1], "n_best", "count_sum", "groups_sha256"])


def pair_counts(chunks: DataFrame, size_b: int) -> DataFrame:
    """``(pair, told)``: twice the number of documents that link the pair, plus 1 where no pair of its A id has more."""
    counts = (chunks.select(F.explode(F.arrays_zip("pair", "holders")).alias("x")).select("x.pair", "x.holders")
              .groupBy("pair").agg(F.sum("holders").alias("n")).withColumn("a", F.expr(f"pair div {size_b}")))
    best = counts.groupBy("a").agg(F.max("n").alias("most"))
    return counts.join(best, "a").select("pair", (F.col("n") * 2 + (F.col("n") == F.col("most")).cast("long")).alias("told"))


def aligned(docs: DataFrame, paths: tuple[str, str] | None = None, chunk_bytes: int = CHUNK_BYTES, lane_bytes: int = LANE_BYTES) -> DataFrame:
    """Per document: numbers of tokens, groups and links, links whose pair is the best of its A id over all
    documents, the sum of the pairs' counts, and the digest of its groups."""
    path_a, path_b = paths or default_paths()
    chunks = shared(_base(docs).mapInArrow(_chunk_kernel(path_a, path_b, chunk_bytes, lane_bytes), _CHUNK_SCHEMA), "alignment")
    size_b = len(load(path_a, path_b).size_b)
    asked = chunks.select("chunk", F.posexplode("pair").alias("at", "pair"))
    # Each chunk asks once for a pair, so a pair has as many rows as there are chunks, not documents.
    told = (asked.join(pair_counts(chunks, size_b), "pair").groupBy("chunk")
            .agg(F.sort_array(F.collect_list(F.struct("at", "told"))).alias("t")).select("chunk", F.col("t.told").alias("told")))
    back = chunks.drop("pair", "holders").join(told, "chunk", "left")
    return back.mapInArrow(_return_kernel, "doc_id bigint, n_a bigint, n_b bigint, n_groups bigint, n_links bigint, "
                                           "n_best bigint, count_sum bigint, groups_sha256 string")
