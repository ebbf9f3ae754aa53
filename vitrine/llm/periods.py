"""Periodic run detection in word sequences, by tiles per period octave.

A run is a stretch of words with smallest period q and at least ``max(6, 4 q)`` words that no neighbouring word
extends.  Octave k holds the periods from ``P = 2**k`` to ``2 P - 1``.  A document longer than ``tile_words`` is
exploded into overlapping tiles: one set for all small octaves, then one set for each larger octave, eight P
long with five P of overlap, so that any three periods of a run lie in one tile.  Tiles are rows of their own,
dealt over the cluster and solved independently; their interval fragments are shuffled by document and period
and stitched where they touch.  A document that fits one tile is one, and its fragments are complete at once.

Solving a tile: boundaries stand every P words.  At a boundary b and a shift p the forward Z-value counts equal
words from (b, b + p) on, the backward one those before; ``[b - backward, b + forward)`` is a fragment of the run
of period p around b.  Every run meets a boundary with both values at least P, and there at most one period of
the octave can be the smallest (two of them would have a common smaller period), so a tile yields at most one
fragment per boundary and octave.  Pairs are filtered word by word over all boundaries at once, Z-values of the
survivors come from prefix hashes by binary search, and every fragment is then compared word for word.

Defined results: null, empty and white-space texts have no words and no runs; a null id counts as empty text in
the checksum; repeated rows are handled one by one; columns but id and text are not used; an empty table gives
no rows.  Memory is bounded by the tile and, where a document's digest is taken in order, by the document.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import words as W
from .common import shared, shuffle_partitions

TILE_WORDS = 4096       # words of a tile of the small octaves, without its overlap
MIN_WORDS, MIN_PERIODS = 6, 4
_PAIRS = 1 << 20        # (boundary, shift) pairs looked at together


# ------------------------------------------------------------------ tiles
def tile_plan(n: int, tile_words: int = TILE_WORDS) -> list[tuple[int, int, int, int]]:
    """``(start, end, first octave, last octave)`` of the tiles of a document of ``n`` words."""
    top = (n // MIN_PERIODS).bit_length() - 1  # last octave with a period of at most n / 4
    if n <= tile_words:
        return [(0, n, 0, top)] if top >= 0 else []
    small = max((tile_words // 16).bit_length() - 1, 0)
    plan = []
    for low, high in [(0, min(small, top)), *((k, k) for k in range(small + 1, top + 1))]:
        core = tile_words if low == 0 else 8 << high
        for start in range(0, n, core):
            end = min(n, start + core + (5 << high))
            plan.append((start, end, low, high))
            if end == n:
                break
    return plan


# ------------------------------------------------------------------ one tile
class _Hash:
    """Prefix hashes of a word sequence modulo two primes (exact in 64-bit integers)."""

    PRIMES = (2_147_483_647, 2_147_483_629)  # fixed values: the two largest primes below 2**31

    def __init__(self, words: np.ndarray, seed: int):
        rng = np.random.default_rng(seed)
        self.parts = []
        for prime in self.PRIMES:
            power = self._powers(int(rng.integers(1 << 20, prime)), prime, len(words) + 1)
            value = ((words >> W.U64(1)) % W.U64(prime)).astype(np.int64)
            total = np.zeros(len(words) + 1, np.int64)
            np.cumsum(value * power[:-1] % prime, out=total[1:])
            self.parts.append((prime, power, total % prime))

    @staticmethod
    def _powers(base: int, prime: int, n: int) -> np.ndarray:
        power = np.ones(n, np.int64)
        have = 1
        while have < n:
            take = min(have, n - have)
            power[have: have + take] = power[:take] * pow(base, have, prime) % prime
            have += take
        return power

    def same(self, x: np.ndarray, y: np.ndarray, length) -> np.ndarray:
        """Whether ``length`` words from x equal those from y (x < y)."""
        out = np.ones(len(x), bool)
        for prime, power, total in self.parts:
            left = (total[x + length] - total[x]) % prime * power[y - x] % prime
            out &= left == (total[y + length] - total[y]) % prime
        return out

    def reach(self, x: np.ndarray, y: np.ndarray, limit: np.ndarray, back: bool) -> np.ndarray:
        """Z-value: how many words from (or, ``back``, before) x and y on are equal, at most ``limit``."""
        low, high = np.zeros(len(x), np.int64), limit.copy()
        while (low < high).any():
            mid = (low + high + 1) // 2
            ok = self.same(x - mid, y - mid, mid) if back else self.same(x, y, mid)
            low, high = np.where(ok, mid, low), np.where(ok, high, mid - 1)
        return low


def _octave(h: _Hash, short: np.ndarray, tile: np.ndarray, start: np.ndarray, end: np.ndarray, p0: int):
    """``(tile, period, low, high)`` of the fragments of one octave, one tile a row of ``tile, start, end``."""
    count = np.maximum((end - start) // p0 - 2, 0)
    who = np.repeat(np.arange(len(tile)), count)
    b = start[who] + p0 * (np.arange(len(who)) - np.repeat(np.cumsum(count) - count, count) + 1)
    out = []
    for at in range(0, len(b), max(_PAIRS // p0, 1)):
        rows = slice(at, at + max(_PAIRS // p0, 1))
        window = np.lib.stride_tricks.sliding_window_view(short, p0)[b[rows] + p0]
        r, c = np.nonzero(window == short[b[rows]][:, None])
        r += at
        x, y = b[r], b[r] + p0 + c
        ok = y + p0 <= end[who[r]]
        for step in (-1, p0 - 1, -p0, p0 // 2):
            r, x, y = r[ok], x[ok], y[ok]
            ok = short[x + step] == short[y + step]
        r, x, y = r[ok], x[ok], y[ok]
        ok = h.same(x - p0, y - p0, 2 * p0)
        r, x, y = r[ok], x[ok], y[ok]
        one = np.bincount(r - at, minlength=1)[r - at] == 1 if len(r) else np.zeros(0, bool)  # two: neither is the smallest period
        r, x, y = r[one], x[one], y[one]
        low = x - h.reach(x, y, x - start[who[r]], True)
        high = x + h.reach(x, y, end[who[r]] - y, False)
        out.append(np.stack([tile[who[r]], y - x, low, high]))
    found = np.concatenate(out, axis=1) if out else np.zeros((4, 0), np.int64)
    found = found[:, np.lexsort(found[::-1])]
    return found[:, np.append(True, (found[:, 1:] != found[:, :-1]).any(axis=0))[: found.shape[1]]]  # each fragment once


def _prime_parts(p: int) -> list[int]:
    """``p / r`` for every prime r that divides p."""
    parts, rest, r = [], p, 2
    while r * r <= rest:
        if rest % r == 0:
            parts.append(p // r)
            while rest % r == 0:
                rest //= r
        r += 1
    return parts + ([p // rest] if rest > 1 else [])


def solve(words: np.ndarray, first: np.ndarray, low: np.ndarray, high: np.ndarray, seed: int = 1) -> np.ndarray:
    """Fragments of all tiles that lie one after another in ``words`` (tile t: ``first[t]`` to ``first[t + 1]``).

    Rows ``tile, period, low, high``: the words of ``[low, high)`` (positions in the tile) equal those a period later,
    as far as the tile reaches.  Periods are smallest periods.
    """
    if not len(words) or not len(low):
        return np.zeros((4, 0), np.int64)
    n = np.diff(first)
    top = int(high.max())
    short = (words >> W.U64(32)).astype(np.uint32)
    h = _Hash(words, seed)
    found = []
    for k in range(top + 1):
        use = np.flatnonzero((low <= k) & (k <= high) & (n >= 4 << k))
        if len(use):
            found.append(_octave(h, short, use, first[use], first[use + 1], 1 << k))
    all_ = np.concatenate(found, axis=1) if found else np.zeros((4, 0), np.int64)
    keep = np.ones(all_.shape[1], bool)
    for p in np.unique(all_[1]).tolist():
        at = np.flatnonzero(all_[1] == p)
        for d in _prime_parts(p):
            keep[at] &= ~h.same(all_[2, at], all_[2, at] + d, p)
    all_ = all_[:, keep]
    if not _verified(words, all_):  # a hash collision: another base
        return solve(words, first, low, high, seed + 1)
    all_[2:] -= first[all_[0]]
    return all_


def _verified(words: np.ndarray, found: np.ndarray) -> bool:
    _, p, low, high = found
    length = high - low
    for a in range(0, len(p), 4096):  # bounded batches of intervals
        n = length[a: a + 4096]
        at = np.repeat(low[a: a + 4096] - np.cumsum(n) + n, n) + np.arange(n.sum())
        if (words[at] != words[at + np.repeat(p[a: a + 4096], n)]).any():
            return False
    return True


def complete(period: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """Which whole intervals are runs."""
    return (high - low >= (MIN_PERIODS - 1) * period) & (high - low + period >= MIN_WORDS)


# ------------------------------------------------------------------ digests of one document
def planted_order(doc_id: int | None, n: int) -> np.ndarray | None:
    """Word numbers of a document whose checksum asks for a planted period, else None."""
    h = zlib.crc32(b"" if doc_id is None else str(doc_id).encode())
    if h % 10 or not n:
        return None
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    order = np.arange(n)
    order[a:] = a + (order[a:] - a) % p
    return order


_RESULT = ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]
_RESULT_DDL = ("doc_id bigint, n_runs bigint, start bigint, length bigint, period bigint, exponent_milli bigint, "
               "runs_sha256 string, collapsed_sha256 string, run_start array<bigint>, run_length array<bigint>, run_period array<bigint>")
_SCAN_DDL = _RESULT_DDL + ", kind int, row bigint, n bigint, words binary"
_TILE_DDL = "row bigint, n bigint, tile_start bigint, octave_low int, octave_high int, words binary"
_DONE, _LONG = 0, 1


_NO_RUNS = hashlib.sha256(b"").hexdigest()


def _result(doc_id, words: list[bytes], start: np.ndarray, length: np.ndarray, period: np.ndarray) -> dict:
    if not len(start):
        return {"doc_id": doc_id, "n_runs": 0, "runs_sha256": _NO_RUNS, "collapsed_sha256": hashlib.sha256(b" ".join(words)).hexdigest(),
                "run_start": [], "run_length": [], "run_period": []}
    order = np.lexsort((period, start))
    start, length, period = start[order], length[order], period[order]
    cover = np.zeros(len(words) + 1, np.int64)
    np.add.at(cover, start + period, 1)
    np.add.at(cover, start + length, -1)
    kept = b" ".join([w for w, c in zip(words, np.cumsum(cover).tolist()) if not c])
    lines = "".join(f"{a},{b},{c}\n" for a, b, c in zip(start.tolist(), length.tolist(), period.tolist()))
    top = np.lexsort((period, start, -length))[0]
    s, n, p = int(start[top]), int(length[top]), int(period[top])
    return {"doc_id": doc_id, "n_runs": len(start), "start": s, "length": n, "period": p, "exponent_milli": 1000 * n // p,
            "runs_sha256": hashlib.sha256(lines.encode()).hexdigest(), "collapsed_sha256": hashlib.sha256(kept).hexdigest(),
            "run_start": start.tolist(), "run_length": length.tolist(), "run_period": period.tolist()}


def _as_batch(rows: list[dict], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([r.get(f.name) for r in rows], f.type) for f in schema], schema=schema)


def _schema(ddl: str) -> pa.Schema:
    kinds = {"bigint": pa.int64(), "int": pa.int32(), "string": pa.string(), "binary": pa.binary(), "array<bigint>": pa.list_(pa.int64())}
    return pa.schema([(name, kinds[kind]) for name, kind in (part.split(" ") for part in ddl.split(", "))])


def _scan_kernel(tile_words: int, planted: bool):
    """Rows ``(row, doc_id, text)``: documents of one tile are finished, longer ones give their words."""
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = _schema(_SCAN_DDL)
        for b in batches:
            for lo, hi, data, off in W.slices(b.column(2)):
                keys, first = W.word_keys(data, off, False)
                rows, ids = b.column(0)[lo:hi].to_pylist(), b.column(1)[lo:hi].to_pylist()
                raw, edge, bounds = data.tobytes(), off.tolist(), first.tolist()
                place = np.arange(len(keys))
                orders = {}
                for i, doc_id in enumerate(ids if planted else []):
                    order = planted_order(doc_id, bounds[i + 1] - bounds[i])
                    if order is not None:
                        orders[i] = order
                        place[bounds[i]: bounds[i + 1]] = bounds[i] + order
                keys = keys[place]
                n = np.diff(first)
                single = np.flatnonzero(n <= tile_words)
                inside = np.repeat(n <= tile_words, n)
                top = np.array([(x // MIN_PERIODS).bit_length() - 1 for x in n[single].tolist()], np.int64)
                found = solve(keys[inside], np.concatenate([[0], np.cumsum(n[single])]), np.zeros(len(single), np.int64), top)
                found = found[:, complete(*found[1:])]
                found = found[:, np.argsort(found[0], kind="stable")]
                cut = np.searchsorted(found[0], np.arange(len(single) + 1))
                out, t = [], 0
                for i, doc_id in enumerate(ids):
                    words = raw[edge[i]: edge[i + 1]].split()
                    if i in orders:
                        words = [words[j] for j in orders[i].tolist()]
                    if n[i] <= tile_words:
                        _, p, low, high = found[:, cut[t]: cut[t + 1]]
                        out.append(_result(doc_id, words, low, high + p - low, p) | {"kind": _DONE})
                        t += 1
                        continue
                    text = b" ".join(words)
                    out.append({"kind": _LONG, "row": rows[i], "doc_id": doc_id, "n": len(text),
                                "words": pa.compress(text, codec="zstd", asbytes=True)})
                yield _as_batch(out, schema)
    return run


def _number_type(n: int) -> type:
    return np.uint16 if n <= 1 << 16 else np.uint32


def _explode_kernel(tile_words: int):
    """Long documents ``(row, n, words)`` to their tiles, words numbered within a tile (equal words, equal numbers)."""
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = _schema(_TILE_DDL)
        for b in batches:
            for r in range(b.num_rows):
                row, size, packed = (b.column(k)[r].as_py() for k in range(3))
                text = pa.decompress(packed, decompressed_size=size, codec="zstd", asbytes=True)
                keys, _ = W.word_keys(np.frombuffer(text, np.uint8), np.array([0, size]), False)
                out = []
                for start, end, low, high in tile_plan(len(keys), tile_words):
                    number = np.unique(keys[start:end], return_inverse=True)[1].astype(_number_type(end - start))
                    out.append({"row": row, "n": end - start, "tile_start": start, "octave_low": low, "octave_high": high,
                                "words": pa.compress(number.tobytes(), codec="zstd", asbytes=True)})
                yield _as_batch(out, schema)
    return run


def _tile_kernel(batches):
    """Tiles to fragments ``(row, period, low, high)``, in positions of the document."""
    for b in batches:
        col = {name: b.column(k) for k, name in enumerate(b.schema.names)}
        for at in range(0, b.num_rows, 64):
            part = {k: c[at: at + 64] for k, c in col.items()}
            n = part["n"].to_numpy()
            number = [np.frombuffer(pa.decompress(w, decompressed_size=m * np.dtype(_number_type(m)).itemsize, codec="zstd", asbytes=True), _number_type(m))
                      for w, m in zip(part["words"].to_pylist(), n.tolist())]
            keys = W.mix(np.concatenate(number).astype(np.uint64) + W.U64(1))
            first = np.concatenate([[0], np.cumsum(n)])
            tile, p, low, high = solve(keys, first, part["octave_low"].to_numpy().astype(np.int64), part["octave_high"].to_numpy().astype(np.int64))
            base = part["tile_start"].to_numpy()[tile]
            yield pa.RecordBatch.from_arrays([pa.array(part["row"].to_numpy()[tile]), pa.array(p), pa.array(low + base), pa.array(high + base)],
                                             names=["row", "period", "low", "high"])


def _long_kernel(batches):
    """Long documents with their stitched runs."""
    schema = _schema(_RESULT_DDL)
    for b in batches:
        for r in range(b.num_rows):
            col = {name: b.column(k)[r] for k, name in enumerate(b.schema.names)}
            text = pa.decompress(col["words"].as_py(), decompressed_size=col["n"].as_py(), codec="zstd", asbytes=True)
            runs = col["runs"].as_py() or []
            start, length, period = (np.array([x[k] for x in runs], np.int64) for k in ("start", "length", "period"))
            yield _as_batch([_result(col["doc_id"].as_py(), text.split(b" "), start, length, period)], schema)


def stitched(fragments: DataFrame) -> DataFrame:
    """Runs ``(row, start, length, period)``: fragments of one document and period that touch are one interval."""
    before = Window.partitionBy("row", "period").orderBy("low", "high").rowsBetween(Window.unboundedPreceding, -1)
    upto = Window.partitionBy("row", "period").orderBy("low", "high").rowsBetween(Window.unboundedPreceding, 0)
    fresh = F.coalesce((F.col("low") > F.max("high").over(before)).cast("int"), F.lit(1))
    island = fragments.withColumn("fresh", fresh).withColumn("island", F.sum("fresh").over(upto))
    whole = island.groupBy("row", "period", "island").agg(F.min("low").alias("low"), F.max("high").alias("high"))
    run = ((F.col("high") - F.col("low") >= (MIN_PERIODS - 1) * F.col("period"))
           & (F.col("high") - F.col("low") + F.col("period") >= MIN_WORDS))
    return whole.where(run).select("row", F.col("low").alias("start"), (F.col("high") - F.col("low") + F.col("period")).alias("length"), "period")


def detected(docs: DataFrame, tile_words: int = TILE_WORDS, planted: bool = False) -> DataFrame:
    """One row per document: its runs (``run_start``, ``run_length``, ``run_period``, by start, then period), the
    longest one, and digests of the runs and of the text without the repeats (words joined by one space).

    ``planted`` gives some documents a period, by the checksum of their id, before anything is looked for.
    """
    spark = docs.sparkSession
    base = docs.select(F.monotonically_increasing_id().alias("row"), F.col("doc_id").cast("bigint").alias("doc_id"),
                       F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    scan = shared(base.mapInArrow(_scan_kernel(tile_words, planted), _SCAN_DDL), "periods")
    result = [f.name for f in _schema(_RESULT_DDL)]
    tiles = scan.where(F.col("kind") == _LONG).select("row", "n", "words").mapInArrow(_explode_kernel(tile_words), _TILE_DDL)
    tiles = tiles.repartition(shuffle_partitions(spark), "row", "tile_start", "octave_low")
    runs = (stitched(tiles.mapInArrow(_tile_kernel, "row bigint, period bigint, low bigint, high bigint"))
            .groupBy("row").agg(F.sort_array(F.collect_list(F.struct("start", "length", "period"))).alias("runs")))
    long = scan.where(F.col("kind") == _LONG).select("row", "doc_id", "words", "n")
    long = long.join(runs, "row", "left").select("doc_id", "words", "runs", "n")
    return scan.where(F.col("kind") == _DONE).select(*result).unionByName(long.mapInArrow(_long_kernel, _RESULT_DDL))


def runs(docs: DataFrame, tile_words: int = TILE_WORDS) -> DataFrame:
    """All runs of the texts as they are: ``(doc_id, start, length, period)``, start and length in words."""
    found = detected(docs, tile_words)
    return found.select("doc_id", F.explode(F.arrays_zip("run_start", "run_length", "run_period")).alias("r")).select(
        "doc_id", F.col("r.run_start").alias("start"), F.col("r.run_length").alias("length"), F.col("r.run_period").alias("period"))


def digests(docs: DataFrame, tile_words: int = TILE_WORDS) -> DataFrame:
    """``detected`` on planted documents, without the lists."""
    return detected(docs, tile_words, True).select(*_RESULT)
