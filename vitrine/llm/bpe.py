"""Byte-level BPE encoding and decoding by forced boundaries.

A byte pair that occurs inside no vocabulary token marks a certain cut: no merge can cross it.  Texts are cut
at such pairs (one table lookup per byte), every distinct fragment is encoded once, and the fragments' ids are
concatenated.  A cut is taken only where the pre-tokenisation pattern sees the same on both sides, so it is
refused

* inside a UTF-8 character,
* after white space (the pattern looks ahead from a white-space run), and
* before an apostrophe unless an ASCII letter or digit precedes (contractions).

Fragments are pre-tokenised with the pattern and merged together, in rounds: each round applies the lowest-
ranked merge of every piece.  The fragment cache is per process and bounded; clearing it changes no result.

Added special tokens are matched in the raw text first, as the tokenizer file asks.  Null texts count as empty;
empty texts have no ids.  Decoding replaces invalid UTF-8 like a lossy UTF-8 decode.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from . import words as W
from .common import with_computed

CACHE_FRAGMENTS = 500_000

# The pre-tokenisation pattern of byte-level BPE, with the Unicode White_Space characters spelt out.
_WHITE = r"\t-\r \x85\xa0  -     　"
_PIECES = rf"'s|'t|'re|'ve|'m|'ll|'d| ?\p{{L}}+| ?\p{{N}}+| ?[^{_WHITE}\p{{L}}\p{{N}}]+|[{_WHITE}]+(?![^{_WHITE}])|[{_WHITE}]+"

_NONE = np.iinfo(np.int32).max


def _byte_alphabet() -> dict[str, int]:
    """Printable stand-ins of the 256 bytes in byte-level vocabularies."""
    own = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(own)]
    return {chr(b): b for b in own} | {chr(256 + i): b for i, b in enumerate(rest)}


class _Cache(dict):
    """Ids of fragments; notes the fragments that were asked for and are not there."""

    def __init__(self):
        super().__init__()
        self.lacking: set[bytes] = set()

    def __missing__(self, fragment: bytes) -> None:
        self.lacking.add(fragment)


class Bpe:
    """Vocabulary, merges and boundary table of one tokenizer file."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        alphabet = _byte_alphabet()
        vocab = {bytes(alphabet[c] for c in t): i for t, i in spec["model"]["vocab"].items() if all(c in alphabet for c in t)}
        self.special = {t["content"].encode(): t["id"] for t in spec.get("added_tokens", [])}
        size = max([*vocab.values(), *self.special.values()]) + 1
        self.token_bytes: list[bytes] = [b""] * size
        for t, i in [*vocab.items(), *self.special.items()]:
            self.token_bytes[i] = t
        self.decimal = [str(i).encode() for i in range(size)]
        self.byte_id = np.array([vocab.get(bytes([b]), 0) for b in range(256)], np.int64)
        seen = np.zeros(65536, bool)
        for t in vocab:
            a = np.frombuffer(t, np.uint8).astype(np.int64)
            seen[a[:-1] * 256 + a[1:]] = True
        a, b = np.divmod(np.arange(65536), 256)
        word = ((a >= 48) & (a <= 57)) | ((a >= 65) & (a <= 90)) | ((a >= 97) & (a <= 122))
        self.cut = ~seen & (b & 0xC0 != 0x80) & ~W._SPACE[a] & ((b != 0x27) | word)
        self._merges(vocab, [m.split(" ") if isinstance(m, str) else m for m in spec["model"]["merges"]], alphabet)
        self.pattern = regex.compile(_PIECES)
        self.cache = _Cache()

    def _merges(self, vocab: dict[bytes, int], merges: list, alphabet: dict[str, int]) -> None:
        to = lambda t: bytes(alphabet[c] for c in t)
        left = np.array([vocab[to(a)] for a, _ in merges], np.uint64)
        right = np.array([vocab[to(b)] for _, b in merges], np.uint64)
        made = np.array([vocab[to(a) + to(b)] for a, b in merges], np.int64)
        key = (left << W.U64(32)) | right
        self.bits = max(len(key) * 4, 2).bit_length()
        self.slot_key = np.full(1 << self.bits, W.U64(2**64 - 1))
        self.slot_rank = np.full(1 << self.bits, _NONE, np.int32)
        self.slot_made = np.zeros(1 << self.bits, np.int64)
        todo = np.arange(len(key))
        slot = self._slot(key)
        while len(todo):  # linear probing, one row of claims a round
            free = self.slot_key[slot[todo]] == W.U64(2**64 - 1)
            claim, at = np.unique(slot[todo][free], return_index=True)
            who = todo[free][at]
            self.slot_key[claim], self.slot_rank[claim], self.slot_made[claim] = key[who], who, made[who]
            todo = np.setdiff1d(todo, who, assume_unique=True)
            slot[todo] = (slot[todo] + 1) & ((1 << self.bits) - 1)
            back = self.slot_key[slot[todo]] == key[todo]
            todo = todo[~back]

    def _slot(self, key: np.ndarray) -> np.ndarray:
        return (W.mix(key) >> W.U64(64 - self.bits)).astype(np.int64)

    def _rank(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rank of every pair (``_NONE``: no merge) and its slot."""
        key = (left.astype(np.uint64) << W.U64(32)) | right.astype(np.uint64)
        slot = self._slot(key)
        open_ = np.flatnonzero(self.slot_key[slot] != key)
        miss = []
        while len(open_):
            empty = self.slot_key[slot[open_]] == W.U64(2**64 - 1)
            miss.append(open_[empty])
            open_ = open_[~empty]
            slot[open_] = (slot[open_] + 1) & ((1 << self.bits) - 1)
            open_ = open_[self.slot_key[slot[open_]] != key[open_]]
        rank = self.slot_rank[slot]
        for m in miss:
            rank[m] = _NONE
        return rank, slot

    def _encode_pieces(self, pieces: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """``(ids, bounds)`` of pre-tokenised pieces, all merged together."""
        ids = self.byte_id[np.frombuffer(b"".join(pieces), np.uint8)]
        owner = np.repeat(np.arange(len(pieces)), [len(p) for p in pieces])
        done_ids, done_owner = [], []
        while len(ids):
            rank = np.full(len(ids), _NONE, np.int32)
            slot = np.zeros(len(ids), np.int64)
            same = np.flatnonzero(owner[1:] == owner[:-1])
            rank[same], slot[same] = self._rank(ids[same], ids[same + 1])
            first = np.flatnonzero(np.concatenate([[True], owner[1:] != owner[:-1]]))
            length = np.diff(np.append(first, len(ids)))
            low = np.minimum.reduceat(rank, first)
            at = np.flatnonzero((rank == np.repeat(low, length)) & (rank != _NONE))
            if len(at) > 1:  # a run of overlapping equal pairs: every other one, from its left end
                fresh = np.concatenate([[True], (np.diff(at) > 1) | (owner[at[1:]] != owner[at[:-1]])])
                start = np.flatnonzero(fresh)
                place = np.arange(len(at)) - np.repeat(start, np.diff(np.append(start, len(at))))
                at = at[place % 2 == 0]
            ids[at] = self.slot_made[slot[at]]
            live = np.repeat(low != _NONE, length)
            done_ids.append(ids[~live]), done_owner.append(owner[~live])
            live[at + 1] = False
            ids, owner = ids[live], owner[live]
        ids, owner = np.concatenate([*done_ids, ids]), np.concatenate([*done_owner, owner])
        order = np.argsort(owner, kind="stable")
        return ids[order].astype(np.uint32), np.searchsorted(owner[order], np.arange(len(pieces) + 1))

    def _learn(self, fragments: list[bytes]) -> None:
        """Encode fragments that the cache lacks."""
        pieces, owner = [], []
        for i, f in enumerate(fragments):
            if f.isalpha() or f[:1] == b" " and f[1:].isalpha():  # ASCII letters only: one piece
                pieces.append(f), owner.append(i)
                continue
            found = self.pattern.findall(f.decode("utf-8"))
            pieces.extend(p.encode("utf-8") for p in found)
            owner.extend([i] * len(found))
        ids, bounds = self._encode_pieces(pieces)
        cut = bounds[np.searchsorted(np.array(owner, np.int64), np.arange(len(fragments) + 1))].tolist()
        raw = ids.tobytes()
        for f, a, b in zip(fragments, cut, cut[1:]):
            self.cache[f] = raw[4 * a: 4 * b]

    def _cuts(self, data: np.ndarray, off: np.ndarray) -> np.ndarray:
        """Sorted byte positions at which the texts are cut, text boundaries included."""
        mark = np.zeros(len(data) + 1, bool)
        np.take(self.cut, data[:-1].astype(np.uint16) << np.uint16(8) | data[1:], out=mark[1:-1])
        at = np.flatnonzero(mark)
        high = at[data[at - 1] >= 0x80]
        if len(high):  # no cut after white space of several bytes
            a, p, q = data[high - 1], data[np.maximum(high - 2, 0)], data[np.maximum(high - 3, 0)]
            white = (p == 0xC2) & ((a == 0x85) | (a == 0xA0))
            white |= (q == 0xE2) & (p == 0x80) & ((a <= 0x8A) | (a == 0xA8) | (a == 0xA9) | (a == 0xAF))
            white |= (q == 0xE2) & (p == 0x81) & (a == 0x9F)
            white |= ((q == 0xE3) & (p == 0x80) | (q == 0xE1) & (p == 0x9A)) & (a == 0x80)
            mark[high[white]] = False
        mark[off] = True
        return np.flatnonzero(mark)

    def encode(self, column: pa.Array) -> Iterator[np.ndarray]:
        """Ids of every text of a string column, in order."""
        for lo, hi, data, off in W.slices(column):
            raw = data.tobytes()
            cuts = self._cuts(data, off) if len(data) > 1 else np.unique(off)
            fixed: dict[int, int] = {}
            spans = []
            for mark, number in self.special.items():
                at = raw.find(mark)
                while at >= 0:
                    end = at + len(mark)
                    spans.append((at, end, number))
                    at = raw.find(mark, end)
            if spans:
                start, end, number = np.array(spans, np.int64).T
                inside = np.searchsorted(off, start, "right") == np.searchsorted(off, end, "left")  # of one text
                start, end, number = start[inside], end[inside], number[inside]
                fixed = dict(zip(start.tolist(), number.tolist()))
                covered = np.zeros(len(data) + 2, np.int64)  # positions within a special token
                np.add.at(covered, start + 1, 1)
                np.add.at(covered, end, -1)
                cuts = np.union1d(cuts[np.cumsum(covered)[cuts] == 0], np.concatenate([start, end]))
            place = cuts.tolist()
            fragments = [raw[a:b] for a, b in zip(place, place[1:])]
            if len(self.cache) > CACHE_FRAGMENTS:
                self.cache.clear()
            found = list(map(self.cache.__getitem__, fragments))
            if self.cache.lacking:
                lacking, self.cache.lacking = self.cache.lacking, set()
                self._learn(list(lacking))
                found = list(map(self.cache.__getitem__, fragments))
            if fixed:
                for i, a in enumerate(place[:-1]):
                    if a in fixed:
                        found[i] = np.uint32(fixed[a]).tobytes()
            first = np.searchsorted(cuts, off).tolist()
            for a, b in zip(first, first[1:]):
                yield np.frombuffer(b"".join(found[a:b]), np.uint32)

    def decode(self, ids: np.ndarray) -> str:
        table = self.token_bytes
        return b"".join([table[i] for i in ids.tolist()]).decode("utf-8", errors="replace")


def load(path: str) -> Bpe:
    """The tokenizer file, parsed once per process (kept outside the pickled kernels)."""
    kept = W.process_cache("bpe")
    if path not in kept:
        kept[path] = Bpe(path)
    return kept[path]


def default_path() -> str:
    import public_tokenizers
    return public_tokenizers.path("byte_bpe_50k.json")


def encoded(docs: DataFrame, path: str | None = None, text: str = "text") -> DataFrame:
    """``docs`` with ``ids array<int>`` appended (the operator's plain output)."""
    path = path or default_path()

    def run(batches):
        bpe = load(path)
        for b in batches:
            ids = pa.array([x.astype(np.int32) for x in bpe.encode(b.column("__text"))], pa.list_(pa.int32()))
            yield pa.RecordBatch.from_arrays([*b.columns[:-1], ids], names=[*b.schema.names[:-1], "ids"])
    keep = [c for c in docs.columns if c.lower() != "ids"]
    base = docs.select(*keep, docs[text].cast("string").alias("__text"))
    return base.mapInArrow(run, docs.select(*keep).schema.add("ids", "array<int>"))


def round_trip_digests(docs: DataFrame, path: str | None = None) -> DataFrame:
    """Encode, then decode every text: ``n_tokens``, ``ids_sha256``, ``decoded_sha256`` beside the id."""
    path = path or default_path()

    def compute(texts: pa.Array) -> list:
        bpe = load(path)
        out: tuple[list, list, list] = ([], [], [])
        for ids in bpe.encode(texts):
            out[0].append(len(ids))
            decimal = bpe.decimal
            out[1].append(hashlib.sha256(b",".join([decimal[i] for i in ids.tolist()])).hexdigest())
            out[2].append(hashlib.sha256(bpe.decode(ids).encode("utf-8")).hexdigest())
        return list(out)
    return with_computed(docs.select("doc_id", "text"), "text", "n_tokens bigint, ids_sha256 string, decoded_sha256 string", compute).drop("text")
