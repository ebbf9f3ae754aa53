"""Best-fit packing of token sequences through a configuration linear program.

The lengths' histogram has at most ``capacity`` entries, however many documents there are; only it reaches the
driver.  There a covering LP over configurations (multisets of lengths of at most ``capacity`` tokens) is
approximated by multiplicative weights: the lengths' weights lose a factor for every time that a round covers them,
and an unbounded-knapsack dynamic program over the weights finds the best configurations of a round.  The weights of
the best round, scaled, are a dual solution: a lower bound on any plan (``bounded_plan`` returns it).  At these prices
configurations are then taken in fractional steps; the steps' floors are kept, what is left is rounded in whole copies
by the same rounds, and the residual by best fit.  Equal sequences are handled together everywhere, so time and memory
depend on the number of distinct lengths and the rounds, not on that of pieces.

The pieces are then numbered within their length (salted counts, so no length meets in one task) and piece
``r`` of a length takes the ``r``-th slot of that length in the plan: its sequence and offset are arithmetic
on the plan row, found by a range lookup.

Defined results.  A null or empty text is its end token alone.  Repeated rows are packed each.  Of a document
longer than ``capacity`` all pieces but the first are full.  Ties go by ``doc_id`` and ``piece``; rows equal in
both are interchangeable.  Empty table: no rows.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import bpe
from .common import shared, shuffle_partitions

CAPACITY = 1024
END_ID = 2
WEIGHT_ROUNDS = 400 # multiplicative-weight rounds for the prices, at most
LEAST_ROUNDS = 40   # ... and at least, however close the bound is
LEARNING = 0.1      # factor exp(-LEARNING) on the price of a length that a round covers once, falling with the rounds
WIDTH = 4.0         # a configuration covers none of its lengths more than so often in a round
NEAR = 0.01         # a round takes configurations whose price is that close to the best one's
CLOSE = 0.0005      # the rounds end when the bound is that close to a known plan
ROUNDS = 60         # knapsack programs of one cover
ETA = 0.5           # weight of the uncovered share in a price while covering
TILTS = (0.5, 0.0)  # covering favours large pieces by size ** tilt beside their price, each tried
STEP = 0.1          # share of a forced length's pieces that a fractional round covers
TOLERANCE = 0.001   # share of the best price that a configuration may lack at first
LITTLE = 0.01       # share of the remaining tokens under which a round covers too little and the tolerance doubles
WIDEST = (0.001, 0.5)  # tolerances at which the rounding in whole copies leaves the rest to best fit, each tried
_TINY = 1e-9

Plan = list[tuple[tuple[int, ...], int]]


def token_pieces(docs: DataFrame, path: str | None = None, capacity: int = CAPACITY, end_id: int = END_ID) -> DataFrame:
    """Pieces of every document's ids plus the end id: ``(doc_id, piece, start, length, ids_crc32)``."""
    path = path or bpe.default_path()
    end = np.array([end_id], np.uint32)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = bpe.load(path)
        for b in batches:
            rows: list[tuple] = []
            for doc, ids in zip(b.column(0).to_pylist(), encoder.encode(b.column(1))):
                ids = np.concatenate([ids, end], dtype="<u4")
                cuts = [0, *range(len(ids) % capacity or capacity, len(ids) + 1, capacity)]
                rows += [(doc, k, a, e - a, zlib.crc32(ids[a:e]))
                         for k, (a, e) in enumerate(zip(cuts, cuts[1:]))]
            types = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64())
            columns = list(zip(*rows)) or [()] * 5
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)],
                                             names=["doc_id", "piece", "start", "length", "ids_crc32"])
    base = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return base.mapInArrow(run, "doc_id long, piece int, start long, length long, ids_crc32 long")


def _knapsack(prices: np.ndarray, sizes: np.ndarray, capacity: int) -> np.ndarray:
    """Unbounded knapsack: for every capacity, the item that ends its best filling (-1: none)."""
    best, item = np.zeros(capacity + 1), np.full(capacity + 1, -1)
    for w in range(1, capacity + 1):
        best[w], item[w] = best[w - 1], -1
        fit = int(np.searchsorted(sizes, w, "right"))
        if fit:
            value = best[w - sizes[:fit]] + prices[:fit]
            i = int(np.argmax(value))
            if value[i] > best[w]:
                best[w], item[w] = value[i], i
    return item


def _fill(space: int, item: np.ndarray, sizes: np.ndarray, left: np.ndarray, taken: dict[int, int]) -> None:
    """Walk the program's choices for ``space`` tokens, as far as the lengths last."""
    while space > 0:
        i = int(item[space])
        if i < 0 or taken.get(i, 0) + 1 > left[i]:
            space -= 1
            continue
        taken[i] = taken.get(i, 0) + 1
        space -= int(sizes[i])


def _price(taken: dict[int, int], prices: np.ndarray) -> float:
    return sum(prices[i] * a for i, a in taken.items())


def dual_prices(demand: np.ndarray, sizes: np.ndarray, capacity: int, known: float, rounds: int = WEIGHT_ROUNDS) -> tuple[np.ndarray, float]:
    """``(prices, bound)`` of the covering LP: no configuration costs more than 1, the whole demand costs ``bound``, so no
    plan has fewer sequences.

    Multiplicative weights.  A length's weight starts as its size (the volume bound) and loses a factor
    ``exp(-rate * c)`` in a round that covers it c times; the factors accumulate, the rate falls.  A round is one
    knapsack program over the weights: it prices the best configuration, which makes the weights a dual solution, and
    it covers every length once by its best configuration, where that costs nearly as much as the best of all.  The
    width (how far one configuration may cover any of its lengths) is bounded.  ``known``: sequences of some plan.
    """
    d, unlimited = demand.astype(float), np.full(len(sizes), np.inf)
    log = np.log(sizes / capacity)
    best, bound = sizes / capacity, float(d @ sizes) / capacity
    for t in range(rounds):
        if t >= LEAST_ROUNDS and (bound >= known * (1 - CLOSE) or bound > known - 1 + _TINY):  # (the latter: the plan is the best)
            break
        weight = np.exp(log - log.max())
        item = _knapsack(weight, sizes, capacity)
        first: dict[int, int] = {}
        _fill(capacity, item, sizes, unlimited, first)
        top = _price(first, weight)
        if float(d @ weight) / top > bound:
            best, bound = weight / top, float(d @ weight) / top
        covered = np.zeros(len(sizes))
        for k in range(len(sizes) - 1, -1, -1):
            if covered[k] >= 1:
                continue
            taken = {k: 1}
            _fill(int(capacity - sizes[k]), item, sizes, unlimited, taken)
            if _price(taken, weight) < (1 - NEAR) * top:
                continue
            copies = min((1 - covered[k]) * d[k] / taken[k], *(WIDTH * d[i] / a for i, a in taken.items()))
            for i, a in taken.items():
                covered[i] += a * copies / d[i]
        log -= LEARNING / (1 + t / 20) * (covered - np.average(covered, weights=d * weight))
    return best, bound


def _cover(left: np.ndarray, sizes: np.ndarray, capacity: int, base: np.ndarray, rounds: int, eta: float, step: float | None, widest: float) -> dict[tuple, float]:
    """Weights of configurations (tuples of ``(length's index, pieces)``); ``left`` loses what they hold.

    Prices are the dual ones (``base``) times ``exp(eta * share not yet covered)``.  In each round, the best configuration of every forced length is taken if its price is
    within a tolerance of the best of all; ``step`` bounds what a length gets in a round, as a share of its pieces.
    Without a ``step``, whole copies, as many as the scarcest length allows, of those nearly full.  The tolerance doubles, up to ``widest``, when a
    round covers little, so no configuration is shut out for its filling.
    """
    weights: dict[tuple, float] = {}
    demand, tolerance = left.astype(float), TOLERANCE
    for _ in range(rounds):
        live = np.flatnonzero(left > _TINY)
        if not len(live):
            break
        own, rest = sizes[live], left[live]
        prices = base[live] * np.exp(eta * (rest / demand[live] - left.sum() / demand.sum()))
        item = _knapsack(prices, own, capacity)
        most = rest if step is None else np.full(len(live), np.inf)
        worth, best = (own, float(capacity)) if step is None else (prices, 0.0)
        if step is not None:
            first: dict[int, int] = {}
            _fill(capacity, item, own, most, first)
            best = sum(prices[i] * a for i, a in first.items())
        before = float(rest @ own)
        for k in range(len(live) - 1, -1, -1):  # largest forced length first
            if most[k] < 1 or rest[k] <= _TINY:
                continue
            taken = {k: 1}
            _fill(int(capacity - own[k]), item, own, most, taken)
            if sum(worth[i] * a for i, a in taken.items()) < (1 - tolerance) * best:
                continue
            copies = min(rest[i] / a for i, a in taken.items())
            copies = int(copies) if step is None else min(copies, demand[live[k]] * step / taken[k])
            for i, a in taken.items():
                rest[i] -= a * copies
                if rest[i] <= _TINY:
                    most[i] = 0
            c = tuple(sorted((int(live[i]), a) for i, a in taken.items()))
            weights[c] = weights.get(c, 0) + copies
        left[live] = rest
        if before - float(rest @ own) < LITTLE * before:
            tolerance *= 2
            if tolerance > widest:
                break
    return weights


def _best_fit(left: np.ndarray, sizes: np.ndarray, capacity: int) -> dict[tuple, int]:
    """Best-fit decreasing on a histogram: equal sequences are moved together, so the work depends on the number of
    lengths and not on that of pieces."""
    free: list[dict[tuple, int]] = [{} for _ in range(capacity + 1)]  # room -> contents -> sequences

    def put(room: int, contents: tuple, i: int, pieces: int, copies: int) -> None:
        level = free[room - pieces * int(sizes[i])]
        contents = (*contents, (i, pieces))
        level[contents] = level.get(contents, 0) + copies
    for i in np.argsort(-sizes).tolist():
        s, n = int(sizes[i]), int(left[i])
        room = s
        while n:
            while room < capacity and not free[room]:
                room += 1
            each = room // s  # best fit goes on with the sequence it has just filled
            if room == capacity:
                contents, count = (), -(-n // each)
            else:
                contents, count = free[room].popitem()
            used = min(count, n // each)
            if used:
                put(room, contents, i, each, used)
                n -= used * each
            if n and used < count:
                put(room, contents, i, n, 1)
                used, n = used + 1, 0
            if room < capacity and used < count:
                free[room][contents] = count - used
    return {tuple(sorted(c)): n for level in free[:capacity] for c, n in level.items()}


def plan(histogram: dict[int, int], capacity: int = CAPACITY, rounds: int = ROUNDS, eta: float = ETA, step: float = STEP) -> Plan:
    """Configurations ``(lengths, copies)`` that hold exactly the histogram's pieces (``bounded_plan`` without the bound)."""
    return bounded_plan(histogram, capacity, rounds, eta, step)[0]


def bounded_plan(histogram: dict[int, int], capacity: int = CAPACITY, rounds: int = ROUNDS, eta: float = ETA, step: float = STEP) -> tuple[Plan, float]:
    """``(plan, bound)``: no plan has fewer sequences than the dual ``bound``.

    The floors of the fractional weights, then whole copies, and best fit for the residual alone.  A histogram of few
    pieces a length loses much by the floors, so the same without them is tried as well; plain best fit counts only
    where it needs fewer sequences than all of these.
    """
    out = [((capacity,), int(histogram[capacity]))] if histogram.get(capacity) else []
    sizes = np.array(sorted(s for s, n in histogram.items() if n and s < capacity), np.int64)
    full = float(histogram.get(capacity, 0))
    if not len(sizes):
        return out, full
    demand = np.array([histogram[int(s)] for s in sizes], np.int64)
    plain = _best_fit(demand, sizes, capacity)
    prices, bound = dual_prices(demand, sizes, capacity, sum(plain.values()))
    found = []
    for tilt in TILTS:
        # (a length that costs nothing is to be covered, too; large pieces first, as small ones find a place later)
        base = np.maximum(prices, 1e-6 * sizes / capacity) * (sizes / capacity) ** tilt
        floors, rest = {}, demand.copy()
        for c, x in _cover(demand.astype(float), sizes, capacity, base, rounds, eta, step, 1.0).items():
            copies = min(int(x + _TINY), *(int(rest[i]) // a for i, a in c))
            if copies:
                floors[c] = copies
                for i, a in c:
                    rest[i] -= a * copies
        for begun, remaining in ((floors, rest), ({}, demand)):
            for widest in WIDEST:
                left, total = remaining.copy(), dict(begun)
                whole = _cover(left, sizes, capacity, base, rounds, eta, None, widest)
                for part in (whole, _best_fit(left, sizes, capacity)):
                    for c, n in part.items():
                        total[c] = total.get(c, 0) + n
                found.append(total)
    best = min([*found, plain], key=lambda p: sum(p.values()))
    return out + [(tuple(sorted((int(sizes[i]) for i, a in c for _ in range(a)), reverse=True)), n) for c, n in best.items()], bound + full


def plan_slots(configurations: Plan) -> list[tuple[int, int, int, int, int, int]]:
    """Plan as rows ``(length, first rank, slots a copy, first sequence, offset, copies)``: the pieces of a length
    from ``first rank`` on fill that length's slots in the copies of one configuration."""
    rank: dict[int, int] = {}
    rows, sequence = [], 0
    for lengths, copies in configurations:
        offset = 0
        for size in sorted(set(lengths), reverse=True):
            slots = lengths.count(size)
            rows.append((size, rank.get(size, 0), slots, sequence, offset, copies))
            rank[size] = rank.get(size, 0) + slots * copies
            offset += slots * size
        sequence += copies
    return rows


def packed(pieces: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """``pieces`` (a stored table) with ``sequence_id`` and ``offset``."""
    spark = pieces.sparkSession
    histogram = {int(r["length"]): int(r["count"]) for r in pieces.groupBy("length").count().collect()}  # at most ``capacity`` rows
    rows = plan_slots(plan(histogram, capacity))
    salts = max(shuffle_partitions(spark), sum(histogram.values()) // 100_000 + 1)
    salted = pieces.withColumn("__salt", F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32"), F.lit(salts)))
    counts = salted.groupBy("length", "__salt").count()
    before = Window.partitionBy("length").orderBy("__salt").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select("length", "__salt", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("__from"))
    within = Window.partitionBy("length", "__salt").orderBy("doc_id", "piece", "start", "ids_crc32")
    ranked = (salted.withColumn("__n", F.row_number().over(within) - 1).join(starts, ["length", "__salt"])
              .withColumn("__rank", F.col("__from") + F.col("__n")))
    table: dict[int, np.ndarray] = {}
    for r in rows:
        table.setdefault(r[0], []).append(r[1:])
    table = {k: np.array(v, np.int64) for k, v in table.items()}
    names = ["doc_id", "piece", "start", "length", "ids_crc32"]

    def place(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            length, rank = (b.column(i).to_numpy() for i in (3, 5))
            sequence, offset = np.zeros(len(rank), np.int64), np.zeros(len(rank), np.int64)
            for size in np.unique(length).tolist():
                at = np.flatnonzero(length == size)
                own = table[size]
                row = own[np.searchsorted(own[:, 0], rank[at], "right") - 1]
                copy, slot = np.divmod(rank[at] - row[:, 0], row[:, 1])
                sequence[at], offset[at] = row[:, 2] + copy, row[:, 3] + slot * size
            yield pa.RecordBatch.from_arrays([*b.columns[:5], pa.array(sequence), pa.array(offset)], names=[*names, "sequence_id", "offset"])
    return ranked.select(*names, "__rank").mapInArrow(
        place, "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long")


def pack_documents(docs: DataFrame, path: str | None = None, capacity: int = CAPACITY, end_id: int = END_ID) -> DataFrame:
    """Tokenise, cut and pack every document."""
    return packed(shared(token_pieces(docs, path, capacity, end_id), "token-pieces"), capacity)
