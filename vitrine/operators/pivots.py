"""Exact similarity joins that skip block pairs by pivots.

Rows are blocked by their nearest pivot (in large tables the two nearest) and by their angle to it, so a block holds
rows that lie close together where the data does.  A block's summary is the range of its rows' angles to every pivot and the
range of their norms.  Angles obey the triangle inequality, so two rows of blocks X and Y are at least
``max over pivots (gap between the two ranges)`` apart, and their inner product is at most the norms times the
cosine of that.  A block pair whose bound stays below what is asked for is never scored:

* ``pruned_pairs``: the bound is below the threshold;
* ``pruned_topk``: two passes.  Every left block first meets the few right blocks with the highest bounds; the
  lowest k-th score of its rows is then what another block has to reach.

Bounds are taken over summaries alone, tile by tile (a tile: ``TILE_BLOCKS`` summaries), so the quadratic part works
on rows of some hundred bytes, one for ``block_rows`` vectors.  Results equal those of :mod:`.blocks`; how much is
skipped depends on the data: rows without any clusters (independent directions in many dimensions) are all nearly
orthogonal, no bound can tell them apart, and all block pairs are scored.  A ``report`` tells how many were.

Skew: a cell that holds many rows gets as many blocks, thin cells share one, and equal rows are dealt by a hash of
their id.  Blocks move by bands of about ``JOIN_BLOCK_ROWS`` rows: a block goes once to a band in which it has
partners, so what is shuffled is bounded by (rows x bands) where nothing can be skipped.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .. import config
from ..functions.sampling import hash_sample
from ..session import stored
from .blocks import PAIR_SCHEMA, TOPK_SCHEMA, _mat, _np, _topk_mask, pair_rows, parallel_blocks, rank_topk, topk_rows

MAX_PIVOTS = 64           # pivots sent to the tasks
SAMPLE_ROWS = 4096        # distinct rows (those with the smallest hashes) among which pivots are chosen on the driver
TILE_BLOCKS = 1024        # summaries that meet in one kernel call
_RINGS = 32               # quantiles of the angle within a cell
_FIRST = 4                # right blocks that a left block meets in the first pass
_SLACK = 1e-6             # angles and scores are compared with this much to spare

_SUMMARY = "block BIGINT, n BIGINT, low ARRAY<DOUBLE>, high ARRAY<DOUBLE>, norm_low DOUBLE, norm_high DOUBLE"


def choose_pivots(vecs: DataFrame, n_rows: int, block_rows: int, vec_col: str = "embedding") -> np.ndarray:
    """Unit vectors far from each other, from a bounded sample; as many as there are blocks, up to ``MAX_PIVOTS``."""
    want = min(MAX_PIVOTS, max(2, math.ceil(n_rows / block_rows)))
    rows = hash_sample(vecs, [vec_col], F.col(vec_col), SAMPLE_ROWS, n_rows)
    if not rows:
        return np.zeros((0, 0))
    x = np.array(rows, np.float64)
    norm = np.linalg.norm(x, axis=1)
    x = x[norm > 0] / norm[norm > 0][:, None]
    if not len(x):
        return np.zeros((0, 0))
    at, near = [0], x @ x[0]
    while len(at) < min(want, len(x)):
        far = int(near.argmin())
        if near[far] > 1 - 1e-9:
            break
        at.append(far)
        near = np.maximum(near, x @ x[far])
    return x[at]


def _angles(x: np.ndarray, pivots: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """``(angle to every pivot, norm)`` per row; a zero row counts as orthogonal to all."""
    norm = np.linalg.norm(x, axis=1)
    cosine = (x @ pivots.T) / np.where(norm > 0, norm, 1.0)[:, None]
    return np.arccos(np.clip(cosine, -1.0, 1.0)), norm


def _cell_kernel(pivots: np.ndarray, near: int):
    def run(batches):
        for b in batches:
            if b.num_rows:
                x = b.column(1).flatten().to_numpy(zero_copy_only=False).reshape(b.num_rows, -1).astype(np.float64)
                angle, _ = _angles(x, pivots)
                order = np.argsort(angle, axis=1, kind="stable")[:, :near]
                cell = order[:, 0] * len(pivots) + order[:, -1]
                yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(cell), pa.array(angle[np.arange(len(x)), order[:, 0]])],
                                                 names=["id", "v", "cell", "angle"])
    return run


def _summary_kernel(pivots: np.ndarray):
    def run(batches):
        for b in batches:
            for i in range(b.num_rows):
                ids = _np(b.column(1)[i]).astype(np.int64)
                angle, norm = _angles(_mat(ids, _np(b.column(2)[i])), pivots)
                yield pa.RecordBatch.from_arrays(
                    [b.column(0).slice(i, 1), pa.array([len(ids)]), pa.array([angle.min(axis=0).tolist()]), pa.array([angle.max(axis=0).tolist()]),
                     pa.array([norm.min()]), pa.array([norm.max()])], names=["block", "n", "low", "high", "norm_low", "norm_high"])
    return run


def pivot_blocks(vecs: DataFrame, pivots: np.ndarray, id_col: str, vec_col: str, block_rows: int) -> tuple[DataFrame, DataFrame]:
    """``(blocks, summaries)``, both stored: ``block, ids, vecs`` and the ranges of every block.

    Cells and their rings, in order, fill blocks of about ``block_rows`` rows of one nearest pivot, so there are at
    most (rows / ``block_rows`` * 2 + pivots) blocks, however thin the cells are."""
    rows = vecs.select(F.col(id_col).cast("bigint").alias("id"), F.col(vec_col).alias("v"))
    vector = rows.schema["v"].dataType.simpleString()
    near = 2 if len(pivots) >= MAX_PIVOTS else 1  # fewer blocks than pivots: the nearest alone tells them apart
    rows = rows.mapInArrow(_cell_kernel(pivots, near), f"id BIGINT, v {vector}, cell BIGINT, angle DOUBLE")
    shares = [i / _RINGS for i in range(1, _RINGS)]
    cuts = rows.groupBy("cell").agg(F.percentile_approx("angle", shares, 1000).alias("cuts"))
    ring = F.size(F.filter("cuts", lambda c: c <= F.col("angle")))
    # (at most MAX_PIVOTS ** 2 cells, each of _RINGS rings: both tables are bounded)
    rows = rows.join(F.broadcast(cuts), "cell").select("id", "v", "cell", ring.alias("ring"))
    sizes = rows.groupBy("cell", "ring").agg(F.count(F.lit(1)).alias("n")).withColumn("pivot", F.floor(F.col("cell") / len(pivots)))
    own = Window.partitionBy("pivot")
    before = F.coalesce(F.sum("n").over(own.orderBy("cell", "ring").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    total = F.sum("n").over(own)
    sizes = sizes.withColumn("fill", F.floor(before * F.ceil(total / block_rows) / total))
    # (equal angles share a ring however many they are: what is too large is dealt by a hash of the id)
    n = F.sum("n").over(Window.partitionBy("pivot", "fill"))
    sizes = sizes.select("cell", "ring", "pivot", "fill", F.when(n > 1.5 * block_rows, F.ceil(n / block_rows)).otherwise(1).alias("parts"))
    rows = rows.join(F.broadcast(sizes), ["cell", "ring"]).withColumn("part", F.pmod(F.xxhash64("id"), F.col("parts")))
    packed = rows.groupBy("pivot", "fill", "part").agg(F.sort_array(F.collect_list(F.struct("id", "v"))).alias("r"))
    number = F.col("pivot") * (1 << 48) + F.col("fill") * (1 << 24) + F.col("part")
    blocks = stored(packed.select(number.alias("block"), F.col("r.id").alias("ids"), F.flatten("r.v").alias("vecs")), "pivot-blocks")
    return blocks, stored(blocks.mapInArrow(_summary_kernel(pivots), _SUMMARY), "pivot-summaries")


def upper_bounds(left: dict[str, np.ndarray], right: dict[str, np.ndarray]) -> np.ndarray:
    """Highest inner product that rows of every left and right block can have."""
    gap = np.zeros((len(left["low"]), len(right["low"])))
    for p in range(left["low"].shape[1]):
        np.maximum(gap, right["low"][None, :, p] - left["high"][:, None, p], out=gap)
        np.maximum(gap, left["low"][:, None, p] - right["high"][None, :, p], out=gap)
    cosine = np.cos(np.maximum(gap - _SLACK, 0.0))
    return np.where(cosine >= 0, np.outer(left["norm_high"], right["norm_high"]) * cosine,
                    np.outer(left["norm_low"], right["norm_low"]) * cosine)


def _tile(cell) -> dict[str, np.ndarray]:
    rows = cell.as_py()
    out = {k: np.array([r[k] for r in rows], np.float64) for k in ("low", "high", "norm_low", "norm_high", "need")}
    return out | {"block": np.array([r["block"] for r in rows], np.int64)}


def _bound_kernel(self_join: bool, first: int):
    """Block pairs whose bound reaches what the left block needs; with ``first``, only each left block's best of the tile."""
    def run(batches):
        for b in batches:
            for i in range(b.num_rows):
                left, right = _tile(b.column(0)[i]), _tile(b.column(1)[i])
                bound = upper_bounds(left, right)
                use = bound >= left["need"][:, None] - _SLACK
                if self_join and b.column(2)[i].as_py():
                    use &= left["block"][:, None] <= right["block"][None, :]
                if first:
                    x, y = _topk_mask(np.where(use, bound, -np.inf), first)
                else:
                    x, y = np.nonzero(use)
                yield pa.RecordBatch.from_arrays([pa.array(left["block"][x]), pa.array(right["block"][y]), pa.array(bound[x, y])], names=["x", "y", "bound"])
    return run


def _tiles(summaries: DataFrame, n_blocks: int) -> tuple[DataFrame, int]:
    parts = max(1, math.ceil(n_blocks / TILE_BLOCKS))
    tiles = summaries.groupBy(F.pmod(F.xxhash64("block"), F.lit(parts)).alias("tile")).agg(F.sort_array(F.collect_list(
        F.struct("block", "low", "high", "norm_low", "norm_high", "need"))).alias("s"))
    return tiles, parts


def bounded_pairs(left: DataFrame, right: DataFrame | None, n_left: int, n_right: int, first: int = 0) -> DataFrame:
    """``(x, y, bound)`` of the block pairs to score; ``left`` has a column ``need``.  ``right=None``: the upper triangle."""
    lt, parts_l = _tiles(left, n_left)
    rt, parts = (lt, parts_l) if right is None else _tiles(right.withColumn("need", F.lit(0.0)), n_right)
    begin = F.col("tile") if right is None else F.lit(0).cast("bigint")
    lt = lt.select(F.col("tile").alias("l_tile"), F.col("s").alias("l"), F.explode(F.sequence(begin, F.lit(parts - 1).cast("bigint"))).alias("r_tile"))
    pairs = lt.join(rt.select(F.col("tile").alias("r_tile"), F.col("s").alias("r")), "r_tile")
    return pairs.select("l", "r", (F.col("l_tile") == F.col("r_tile")).alias("same")).mapInArrow(_bound_kernel(right is None, first), "x BIGINT, y BIGINT, bound DOUBLE")


def _met(pairs: DataFrame, left: DataFrame, right: DataFrame, bands: tuple[int, int], kernel, schema: str) -> DataFrame:
    """The kernel's rows over the block pairs ``(x, y)``.

    Blocks are dealt into ``bands``; the pairs of a left and a right band are a cell.  A block goes to each cell in which
    it has a partner, once, so it is copied at most as often as the other side has bands.  A cell's right blocks come
    before its left ones, each left one with the numbers of its partners."""
    band = lambda c, n: F.pmod(F.xxhash64(c), F.lit(n)).alias(f"{c}_band")
    asked = pairs.select("x", "y", band("x", bands[0]), band("y", bands[1]))
    cell = ["x_band", "y_band"]
    lefts = asked.groupBy(*cell, F.col("x").alias("block")).agg(F.sort_array(F.collect_list("y")).alias("partners")).withColumn("is_left", F.lit(True))
    rights = asked.select(*cell, F.col("y").alias("block")).distinct().withColumn("partners", F.lit(None).cast("array<bigint>")).withColumn("is_left", F.lit(False))
    moved = lefts.join(left, "block").unionByName(rights.join(right, "block"))
    moved = moved.repartition(*cell).sortWithinPartitions(*cell, "is_left", "block")
    return moved.select(*cell, "is_left", "block", "partners", "ids", "vecs").mapInArrow(_cells(kernel), schema)


def _cells(kernel):
    """``kernel(block, ids, rows, partners)`` for every left block of a cell; ``partners``: (block, ids, rows) each."""
    def run(batches):
        at, held = None, {}
        for b in batches:
            for i in range(b.num_rows):
                cell = b.column(0)[i].as_py(), b.column(1)[i].as_py()
                if cell != at:
                    at, held = cell, {}
                block, ids = b.column(3)[i].as_py(), _np(b.column(5)[i]).astype(np.int64)
                if not b.column(2)[i].as_py():
                    flat = _np(b.column(6)[i])
                    held[block] = ids, flat.reshape(len(ids), -1).copy()
                    continue
                x = _mat(ids, _np(b.column(6)[i]))
                yield from kernel(block, ids, x, [(y, *held[y]) for y in b.column(4)[i].as_py()])
    return run


def _pairs_of_cell(threshold: float):
    def run(block, ids, x, partners):
        for other, r_ids, r in partners:
            for found in pair_rows(x, r.astype(np.float64, copy=False), ids, r_ids, threshold, block == other):
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in found], names=["id_a", "id_b", "sim"])
    return run


def _bands(spark, n_blocks: int, block_rows: int, triangle: bool = False) -> int:
    return max(parallel_blocks(spark, None, triangle), math.ceil(n_blocks * block_rows / config.JOIN_BLOCK_ROWS))


def _report(report: dict | None, total: int, pairs: DataFrame) -> None:
    if report is not None:
        scored = pairs.count()
        report.update(block_pairs=total, scored=scored, share=scored / total if total else 0.0)


def pruned_pairs(vecs: DataFrame, threshold: float, id_col: str = "id", vec_col: str = "embedding",
                 block_rows: int = config.MAX_BLOCK_ROWS, report: dict | None = None) -> DataFrame:
    """All pairs ``id_a < id_b`` with inner product >= threshold (> 0), like ``threshold_self_join``.

    ``report`` receives the number of block pairs, of those scored, and their share.
    """
    if threshold <= 0:
        raise ValueError("threshold must be > 0")
    spark = vecs.sparkSession
    pivots = choose_pivots(vecs, vecs.count(), block_rows, vec_col)
    if not len(pivots):
        return spark.createDataFrame([], PAIR_SCHEMA)
    blocks, summaries = pivot_blocks(vecs, pivots, id_col, vec_col, block_rows)
    n = summaries.count()
    pairs = stored(bounded_pairs(summaries.withColumn("need", F.lit(float(threshold))), None, n, n), "pivot-pairs")
    _report(report, n * (n + 1) // 2, pairs)
    bands = _bands(spark, n, block_rows, True)
    return _met(pairs, blocks, blocks, (bands, bands), _pairs_of_cell(threshold), PAIR_SCHEMA)


def _topk_of_cell(k: int, exclude_self: bool):
    def run(block, ids, x, partners):
        r_ids = np.concatenate([p[1] for p in partners])
        order = np.argsort(r_ids, kind="stable")  # ties go to the smaller id
        r_ids, r = r_ids[order], np.concatenate([p[2] for p in partners])[order].astype(np.float64, copy=False)

        def scored(raw, a, b):
            score = raw.copy()
            if exclude_self:
                score[ids[a: a + raw.shape[0], None] == r_ids[None, b: b + raw.shape[1]]] = -np.inf
            return score
        for i, j, raw, score in topk_rows(x, r, k, scored):
            yield pa.RecordBatch.from_arrays([pa.array(ids[i]), pa.array(r_ids[j]), pa.array(raw), pa.array(score), pa.array(np.full(len(i), block, np.int64))],
                                             names=["l_id", "r_id", "raw", "score", "block"])
    return run


def pruned_topk(left: DataFrame, right: DataFrame, k: int, id_col: str = "id", vec_col: str = "embedding", exclude_self: bool = False,
                block_rows: int = config.MAX_BLOCK_ROWS, report: dict | None = None) -> DataFrame:
    """Exact top-k of ``right`` for every ``left`` row, ``(l_id, r_id, raw, score, rank)`` like ``topk_join``."""
    spark = left.sparkSession
    pivots = choose_pivots(right, right.count(), block_rows, vec_col)
    if not len(pivots):  # no direction at all: every score is zero, any plan does
        from .blocks import topk_join
        return topk_join(left, right, k, id_col=id_col, vec_col=vec_col, exclude_self=exclude_self, block_rows=block_rows)
    r_blocks, r_sums = pivot_blocks(right, pivots, id_col, vec_col, block_rows)
    l_blocks, l_sums = (r_blocks, r_sums) if left is right else pivot_blocks(left, pivots, id_col, vec_col, block_rows)
    n_l, n_r = l_sums.count(), r_sums.count()
    any_ = l_sums.withColumn("need", F.lit(float("-inf")))
    best = Window.partitionBy("x").orderBy(F.col("bound").desc(), "y")
    near = stored(bounded_pairs(any_, r_sums, n_l, n_r, _FIRST).withColumn("n", F.row_number().over(best)).where(F.col("n") <= _FIRST).select("x", "y"), "pivot-near")
    schema, kernel = TOPK_SCHEMA + ", block BIGINT", _topk_of_cell(k, exclude_self)
    bands = _bands(spark, n_l, block_rows), _bands(spark, n_r, block_rows)
    found = stored(_met(near, l_blocks, r_blocks, bands, kernel, schema), "pivot-found")
    # What a row has as its k-th best; a block needs the least of them, nothing while a row has fewer than k.
    kth = rank_topk(found, k).where(F.col("rank") == k).groupBy("block").agg(F.min("score").alias("least"), F.count(F.lit(1)).alias("full"))
    needs = l_sums.join(kth, "block", "left").withColumn("need", F.when(F.col("full") == F.col("n"), F.col("least")).otherwise(F.lit(float("-inf"))))
    rest = stored(bounded_pairs(needs.select(*l_sums.columns, "need"), r_sums, n_l, n_r).select("x", "y").join(near, ["x", "y"], "left_anti"), "pivot-rest")
    _report(report, n_l * n_r, rest.unionByName(near))
    more = _met(rest, l_blocks, r_blocks, bands, kernel, schema)
    return rank_topk(found.unionByName(more).drop("block"), k)
