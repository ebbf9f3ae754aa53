"""Words of many texts at once, as 64-bit keys (NumPy, no per-word Python).

A word is a maximal run of bytes outside ``\\x20 \\x09-\\x0D``.  Its key is a
polynomial over random 64-bit byte values, taken from one running sum over
the whole buffer, then mixed; two different words share a key with
probability about 2**-64.  Null texts count as empty.
"""

from __future__ import annotations

import sys
import types
from collections.abc import Iterator

import numpy as np
import pyarrow as pa

U64 = np.uint64
#: Texts are handled in slices of about this many bytes (one longer text is a slice of its own).
SLICE_BYTES = 1 << 20

_SPACE = np.zeros(256, bool)
_SPACE[[0x20, 9, 10, 11, 12, 13]] = True
_RAW = np.random.default_rng(20_240_607).integers(1, 2**63, 256, dtype=np.uint64) * U64(2) + U64(1)
_LOWER = _RAW.copy()
_LOWER[65:91] = _RAW[97:123]
_BASE = 0x9E3779B97F4A7C15 | 1


def process_cache(name: str) -> dict:
    """A dictionary that lives as long as the process.  Kernels are pickled by value and unpickled for every
    task, so what a module holds itself would be built again each time."""
    store = sys.modules.setdefault("_vitrine_process_cache", types.ModuleType("_vitrine_process_cache"))
    return store.__dict__.setdefault(name, {})


def _power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    powers = process_cache("word powers")
    if "n" not in powers or len(powers["n"]) < n:
        size = max(n, SLICE_BYTES + (SLICE_BYTES >> 2))
        for name, base in (("n", _BASE), ("inv", pow(_BASE, -1, 1 << 64))):
            table = np.full(size, base, np.uint64)
            table[0] = 1
            powers[name] = np.multiply.accumulate(table)
    return powers["n"], powers["inv"]


def mix(x: np.ndarray) -> np.ndarray:
    """Bijective 64-bit finaliser: spreads every input bit over the word."""
    x = x ^ (x >> U64(30))
    x = x * U64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> U64(27))
    x = x * U64(0x94D049BB133111EB)
    return x ^ (x >> U64(31))


def combine(keys: np.ndarray, n: int) -> np.ndarray:
    """Keys of all runs of ``n`` consecutive keys (``len(keys) - n + 1`` of them)."""
    m = max(len(keys) - n + 1, 0)
    h = np.zeros(m, np.uint64)
    for j in range(n):
        h = h * U64(0x9E3779B97F4A7C15) + keys[j: j + m] if j else keys[:m].copy()
    return mix(h + U64(n))


def utf8(column: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """``(bytes, offsets)`` of a string column without copying its text; null is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null("")
    column = column.cast(pa.large_string()) if column.type != pa.large_string() else column
    _, offsets, data = column.buffers()
    o = np.frombuffer(offsets, np.int64)[column.offset: column.offset + len(column) + 1] if len(column) else np.zeros(1, np.int64)
    return (np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)), o


def slices(column: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """``(first row, end row, bytes, offsets from 0)`` for slices of a text column."""
    data, off = utf8(column)
    lo, n = 0, len(off) - 1
    while lo < n:
        hi = max(lo + 1, int(np.searchsorted(off, off[lo] + SLICE_BYTES, "right")) - 1)
        yield lo, hi, data[off[lo]: off[hi]], off[lo: hi + 1] - off[lo]
        lo = hi


def spans(data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``(starts, ends, first)``: byte spans of the words and, per text, the index of its first word."""
    inside = ~_SPACE[data]
    before = np.empty_like(inside)
    before[1:], before[:1] = inside[:-1], False
    edge = off[:-1][off[:-1] < len(data)]
    before[edge] = False
    after = np.empty_like(inside)
    after[:-1], after[-1:] = inside[1:], False
    edge = off[1:] - 1
    after[edge[edge >= 0]] = False
    starts = np.flatnonzero(inside & ~before)
    ends = np.flatnonzero(inside & ~after) + 1
    return starts, ends, np.searchsorted(starts, off)


def span_keys(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, lower: bool) -> np.ndarray:
    """One key per byte span (any spans of ``data``)."""
    power, inverse = _power_tables(len(data) + 1)
    total = np.zeros(len(data) + 1, np.uint64)
    np.cumsum((_LOWER if lower else _RAW)[data] * power[: len(data)], out=total[1:])
    return mix((total[ends] - total[starts]) * inverse[starts])


def word_keys(data: np.ndarray, off: np.ndarray, lower: bool) -> tuple[np.ndarray, np.ndarray]:
    """``(keys, first)``: one key per word, and per text the index of its first word (one more entry than texts)."""
    starts, ends, first = spans(data, off)
    return span_keys(data, starts, ends, lower), first


def shingles(keys: np.ndarray, first: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """``(keys, text index)`` of every run of ``n`` words inside one text; a text with fewer words (but one)
    gives its whole sequence as one run."""
    counts = np.diff(first)
    whole = combine(keys, n)
    at = np.arange(len(whole))
    text = np.repeat(np.arange(len(counts)), counts)[: len(whole)]
    inside = at + n <= first[1:][text] if len(whole) else np.zeros(0, bool)
    short = np.flatnonzero((counts > 0) & (counts < n))
    extra = np.empty(len(short), np.uint64)
    for k in range(1, n):
        pick = counts[short] == k
        at = first[:-1][short[pick]]
        h = keys[at].copy()
        for j in range(1, k):
            h = h * U64(0x9E3779B97F4A7C15) + keys[at + j]
        extra[pick] = mix(h + U64(k))
    return np.concatenate([whole[inside], extra]), np.concatenate([text[inside], short])


def distinct(keys: np.ndarray, text: np.ndarray, n_texts: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys of every text, ascending within it, and how many each text has."""
    if len(text) and (text[1:] < text[:-1]).any():
        order = np.argsort(text, kind="stable")
        keys, text = keys[order], text[order]
    bounds = np.searchsorted(text, np.arange(n_texts + 1))
    keys = keys.copy()
    for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist()):
        if b - a > 1:
            keys[a:b].sort()
    new = np.ones(len(keys), bool)
    np.not_equal(keys[1:], keys[:-1], out=new[1:])
    new[1:] |= text[1:] != text[:-1]
    return keys[new], np.bincount(text[new], minlength=n_texts)
