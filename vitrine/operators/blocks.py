"""Blocked similarity kernels.

Spark 4.1 has no vector distance built-ins, and a row-level cross join of
two vector tables is the wrong plan at scale.  Instead both sides are cut
into blocks of bounded size (ids hashed into ``ceil(n / block_rows)``
blocks *per group*, so a hot group simply gets more blocks), each block
is packed into one row (ids + flattened vectors), the block pairs that
must meet are produced by equi-joins against a small pair map, and a
NumPy kernel (``mapInArrow``) scores one block pair per row.  Only
results leave the kernel: the per-block top-k (``topk_join``) or the
pairs above a threshold (``threshold_self_join``).

Work is exact.  A block travels once to each of its partner blocks, so what
is shuffled is (rows x blocks of the other side).  Blocks are therefore as
large as the parallelism allows, up to ``JOIN_BLOCK_ROWS``: until then their
number is fixed and the shuffle grows in proportion to the rows.  The kernel
scores a block pair in tiles of ``TILE_LEFT x TILE_RIGHT`` and keeps only what
survives a tile, so its memory does not depend on the size of a block.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import config

_G = "_g"       # group key column name on each side
_B = "_b"       # block number
_NB = "_nb"     # number of blocks in the group


def _block_count(n: Column, block_rows: int, min_blocks: int, min_rows: int) -> Column:
    by_size = F.ceil(n / F.lit(block_rows))
    by_par = F.least(F.lit(min_blocks), F.greatest(F.ceil(n / F.lit(min_rows)), F.lit(1)))
    return F.greatest(by_size, by_par, F.lit(1)).cast("bigint")


def pack_blocks(df: DataFrame, group: Column | None, id_col: str, vec_col: str, codes: list[str],
                block_rows: int = config.MAX_BLOCK_ROWS, min_blocks: int = 1,
                min_rows: int = 64, prefix: str = "") -> DataFrame:
    """Pack rows into blocks: ``(_g, _b, _nb, ids, vecs, <codes>)``.

    ``vecs`` is the concatenation of the block's vectors in id order;
    ``codes`` are BIGINT columns carried along (e.g. hashed categories).
    The group key may be skewed: a group of n rows gets
    ``ceil(n / block_rows)`` blocks, so no block exceeds ~block_rows.
    Without a group, the block count is a scalar subquery (no join).
    """
    d = df.select((group if group is not None else F.lit(0)).alias(_G), F.col(id_col).cast("bigint").alias("_id"),
                  F.col(vec_col).alias("_v"), *[F.col(c).cast("bigint").alias(c) for c in codes])
    if group is None:
        n = df.agg(F.count(F.lit(1))).scalar()
        d = d.withColumn(_NB, _block_count(n, block_rows, min_blocks, min_rows))
    else:
        counts = d.groupBy(_G).agg(_block_count(F.count(F.lit(1)), block_rows, min_blocks, min_rows).alias(_NB))
        d = d.join(counts, _G)
    d = d.withColumn(_B, F.pmod(F.xxhash64("_id"), F.col(_NB)))
    packed = d.groupBy(_G, _B, _NB).agg(
        F.sort_array(F.collect_list(F.struct("_id", "_v", *codes))).alias("_rows"))
    out = [F.col(_G), F.col(_B), F.col(_NB),
           F.col("_rows._id").alias(prefix + "ids"),
           F.flatten(F.col("_rows._v")).alias(prefix + "vecs")]
    out += [F.col(f"_rows.{c}").alias(prefix + c) for c in codes]
    return packed.select(*out)


def _np(scalar) -> np.ndarray:
    return scalar.values.to_numpy(zero_copy_only=False)


def _mat(ids: np.ndarray, flat: np.ndarray) -> np.ndarray:
    n = len(ids)
    if n == 0:
        return np.zeros((0, 0), dtype=np.float64)
    return flat.reshape(n, len(flat) // n).astype(np.float64, copy=False)


def _topk_mask(score: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Row-wise top-k of ``score`` ordered by (score desc, column asc)."""
    n_l, n_r = score.shape
    kk = min(k, n_r)
    if kk <= 0 or n_l == 0:
        return np.empty(0, dtype=np.int64), np.empty(0, dtype=np.int64)
    if kk < n_r:
        kth = np.partition(score, n_r - kk, axis=1)[:, n_r - kk]
    else:
        kth = score.min(axis=1)
    gt = score > kth[:, None]
    eq = score == kth[:, None]
    need = kk - gt.sum(axis=1)
    take = gt | (eq & (np.cumsum(eq, axis=1) <= need[:, None]))
    li, ri = np.nonzero(take)
    keep = np.isfinite(score[li, ri])
    return li[keep], ri[keep]


TOPK_SCHEMA = "l_id BIGINT, r_id BIGINT, raw DOUBLE, score DOUBLE"
PAIR_SCHEMA = "id_a BIGINT, id_b BIGINT, sim DOUBLE"


TILE_LEFT, TILE_RIGHT = 512, 2048   # scores that a kernel holds at once


def _tiles_of(n_l: int, n_r: int, same: bool = False):
    """Corners of the tiles of a block pair; ``same``: rows ascend on both sides, tiles below the diagonal are left out."""
    for a in range(0, n_l, TILE_LEFT):
        for b in range(0, n_r, TILE_RIGHT):
            if not same or b + TILE_RIGHT > a:
                yield a, b


def topk_rows(left: np.ndarray, right: np.ndarray, k: int, scored):
    """Row-wise top-k by (score desc, column asc) of ``scored(raw, a, b)`` over the tiles of ``left @ right.T``.

    Yields ``(row, column, raw, score)`` per band of rows.  After a band's first tile only scores above a row's k-th
    so far are looked at (a later column loses a tie)."""
    for a in range(0, len(left), TILE_LEFT):
        rows = left[a: a + TILE_LEFT]
        best, kth = None, np.full(len(rows), -np.inf)
        for b in range(0, len(right), TILE_RIGHT):
            raw = rows @ right[b: b + TILE_RIGHT].T
            score = scored(raw, a, b)
            if best is None:
                x, y = _topk_mask(score, k)
            else:
                x, y = np.nonzero(score > kth[:, None])
                fit = np.isfinite(score[x, y])
                x, y = x[fit], y[fit]
            if best is not None and not len(x):
                continue
            new = x, y + b, raw[x, y], score[x, y]
            x, y, r, v = new if best is None else (np.concatenate(c) for c in zip(best, new))
            order = np.lexsort((y, -v, x))
            x, y, r, v = x[order], y[order], r[order], v[order]
            rank = np.arange(len(x)) - np.searchsorted(x, x)
            best = tuple(c[rank < k] for c in (x, y, r, v))
            full = rank == k - 1
            kth[x[full]] = v[full]
        if best is not None:
            yield best[0] + a, *best[1:]


def pair_rows(left: np.ndarray, right: np.ndarray, lid: np.ndarray, rid: np.ndarray, threshold: float, same: bool):
    """``(id_a, id_b, sim)`` of the pairs at or above the threshold, tile by tile; ``same``: one block with itself, ids ascending."""
    for a, b in _tiles_of(len(lid), len(rid), same):
        sims = left[a: a + TILE_LEFT] @ right[b: b + TILE_RIGHT].T
        hit = sims >= threshold
        if same:
            hit &= lid[a: a + TILE_LEFT, None] < rid[None, b: b + TILE_RIGHT]
        x, y = np.nonzero(hit)
        if len(x):
            p, q = lid[x + a], rid[y + b]
            yield np.minimum(p, q), np.maximum(p, q), sims[x, y]


def _topk_kernel(k: int, exclude_self, clip_bonus: bool, bonus: list[tuple[str, str, float]], cap: float):
    out_schema = pa.schema([("l_id", pa.int64()), ("r_id", pa.int64()), ("raw", pa.float64()), ("score", pa.float64())])

    def scorer(cols, i, lid, rid):
        codes = [(_np(cols[lc][i]), _np(cols[rc][i]), w) for lc, rc, w in bonus] if clip_bonus else []
        flag = _np(cols[exclude_self][i]).astype(bool) if isinstance(exclude_self, str) else None  # a per-left-row 0/1 flag

        def scored(raw, a, b):
            at, to = slice(a, a + raw.shape[0]), slice(b, b + raw.shape[1])
            score = raw.copy()
            if clip_bonus:
                np.clip(raw, 0.0, 1.0, out=score)
                add = np.zeros_like(score)
                for lv, rv, w in codes:
                    add += np.where(lv[at, None] == rv[None, to], w, 0.0)
                score = np.minimum(score + add, cap)
            if exclude_self:
                own = lid[at, None] == rid[None, to]
                score[own if flag is None else own & flag[at, None]] = -np.inf
            return score
        return scored

    def run(batches):
        for batch in batches:
            cols = dict(zip(batch.schema.names, batch.columns))
            for i in range(batch.num_rows):
                lid = _np(cols["l_ids"][i]).astype(np.int64)
                rid = _np(cols["r_ids"][i]).astype(np.int64)
                if len(lid) == 0 or len(rid) == 0:
                    continue
                left, right = _mat(lid, _np(cols["l_vecs"][i])), _mat(rid, _np(cols["r_vecs"][i]))
                for x, y, raw, score in topk_rows(left, right, k, scorer(cols, i, lid, rid)):
                    yield pa.RecordBatch.from_arrays([pa.array(lid[x]), pa.array(rid[y]), pa.array(raw), pa.array(score)], schema=out_schema)
    return run


def _pair_kernel(threshold: float):
    out_schema = pa.schema([("id_a", pa.int64()), ("id_b", pa.int64()), ("sim", pa.float64())])

    def run(batches):
        for batch in batches:
            cols = dict(zip(batch.schema.names, batch.columns))
            for i in range(batch.num_rows):
                lid = _np(cols["l_ids"][i]).astype(np.int64)
                rid = _np(cols["r_ids"][i]).astype(np.int64)
                if len(lid) == 0 or len(rid) == 0:
                    continue
                left, right = _mat(lid, _np(cols["l_vecs"][i])), _mat(rid, _np(cols["r_vecs"][i]))
                for found in pair_rows(left, right, lid, rid, threshold, cols["_same"][i].as_py()):
                    yield pa.RecordBatch.from_arrays([pa.array(c) for c in found], schema=out_schema)
    return run


def _join_roots(root: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """``root`` (per node the smallest node it is connected to) after the links ``a[i] - b[i]``."""
    while True:
        a, b = root[a], root[b]
        apart = a != b
        if not apart.any():
            return root
        a, b = a[apart], b[apart]
        root = root.copy()
        np.minimum.at(root, np.maximum(a, b), np.minimum(a, b))
        while not (root == (low := root[root])).all():
            root = low


def _forest_kernel(threshold: float):
    """Like the pair kernel, but a block pair emits a spanning forest of its
    links (every row to the smallest id it is connected to), never all pairs."""
    out_schema = pa.schema([("id_a", pa.int64()), ("id_b", pa.int64())])

    def run(batches):
        for batch in batches:
            cols = dict(zip(batch.schema.names, batch.columns))
            for i in range(batch.num_rows):
                lid = _np(cols["l_ids"][i]).astype(np.int64)
                rid = _np(cols["r_ids"][i]).astype(np.int64)
                if len(lid) == 0 or len(rid) == 0:
                    continue
                left, right = _mat(lid, _np(cols["l_vecs"][i])), _mat(rid, _np(cols["r_vecs"][i]))
                ids = np.unique(np.concatenate([lid, rid]))
                l_at, r_at, root = np.searchsorted(ids, lid), np.searchsorted(ids, rid), np.arange(len(ids))
                for a, b in _tiles_of(len(lid), len(rid), cols["_same"][i].as_py()):
                    x, y = np.nonzero(left[a: a + TILE_LEFT] @ right[b: b + TILE_RIGHT].T >= threshold)
                    root = _join_roots(root, l_at[x + a], r_at[y + b])
                far = np.flatnonzero(root != np.arange(len(ids)))
                yield pa.RecordBatch.from_arrays([pa.array(ids[root[far]]), pa.array(ids[far])], schema=out_schema)
    return run


FAN_IN = 2          # left blocks that meet on one join key, at most about
GROUP_BLOCKS = 4    # blocks of a group with enough rows, at least
GROUP_ROWS = 512    # ... of so many rows each


def parallel_blocks(spark, min_pairs: int | None, triangle: bool = False) -> int:
    """Blocks that give every core a few block pairs."""
    from ..session import default_parallelism
    want = min_pairs if min_pairs is not None else 4 * default_parallelism(spark)
    return max(1, int(math.ceil(math.sqrt((2 if triangle else 1) * want))))


def topk_join(left: DataFrame, right: DataFrame, k: int, *, left_group: Column | None = None,
              right_group: Column | None = None, group_pairs: DataFrame | None = None,
              id_col: str = "id", vec_col: str = "embedding", exclude_self: bool | str = False,
              bonus: list[tuple[str, str, float]] | None = None, clip_bonus: bool = False,
              cap: float = 1.0, block_rows: int = config.JOIN_BLOCK_ROWS,
              min_pairs: int | None = None) -> DataFrame:
    """Exact top-k of ``right`` rows for every ``left`` row.

    Score = inner product (``clip_bonus=False``), or
    ``min(clip(ip, 0, 1) + sum(w * [left.code == right.code]), cap)``.
    Order: score desc, right id asc.  Rows meet only when their groups are
    paired in ``group_pairs`` (columns ``lg``, ``rg``); without groups every
    left row meets every right row.  ``exclude_self`` may name a 0/1 column
    of ``left`` to exclude a row's own id only where the flag is set.
    Returns ``(l_id, r_id, raw, score, rank)``.
    """
    spark = left.sparkSession
    bonus = bonus or []
    lcodes = sorted({lc for lc, _, _ in bonus} | ({exclude_self} if isinstance(exclude_self, str) else set()))
    rcodes = sorted({rc for _, rc, _ in bonus})
    grouped = left_group is not None
    mb, mr = (GROUP_BLOCKS, GROUP_ROWS) if grouped else (parallel_blocks(spark, min_pairs), 64)
    lb = pack_blocks(left, left_group, id_col, vec_col, lcodes, block_rows, mb, mr, prefix="l_")
    if right is left and not grouped and not lcodes and not rcodes:
        # Self join: one packing serves both sides (one scan, one shuffle).
        rb = lb.select(F.col(_G), F.col(_B), F.col(_NB), F.col("l_ids").alias("r_ids"), F.col("l_vecs").alias("r_vecs"))
    else:
        rb = pack_blocks(right, right_group, id_col, vec_col, rcodes, block_rows, mb, mr, prefix="r_")
    lcols = ["l_ids", "l_vecs"] + [f"l_{c}" for c in lcodes]
    rcols = ["r_ids", "r_vecs"] + [f"r_{c}" for c in rcodes]
    if grouped:
        # Pair map: the right groups a left group meets, with their block counts.
        # and the salts over which a right block's partners are dealt.
        r_nb = rb.select(F.col(_G).alias("rg"), F.col(_NB).alias("r_nb")).distinct()
        l_nb = lb.select(F.col(_G).alias("lg"), F.col(_NB).alias("l_nb")).distinct()
        pm = group_pairs.select("lg", "rg").distinct().join(r_nb, "rg").join(l_nb, "lg")
        deal = pm.groupBy("rg").agg(F.ceil(F.sum("l_nb") / FAN_IN).cast("bigint").alias("_salts"))
        pm = pm.join(deal, "rg")
        lrows = (lb.join(pm, lb[_G] == pm["lg"])
                   .select(*lcols, "rg", F.pmod(F.xxhash64("lg", _B), F.col("_salts")).alias("_salt"),
                           F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("r_nb") - 1)).alias("r_b")))
        rrows = (rb.select(F.col(_G).alias("rg"), F.col(_B).alias("r_b"), *rcols).join(deal, "rg")
                   .withColumn("_salt", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("_salts") - 1))))
        pairs = lrows.join(rrows, ["rg", "r_b", "_salt"]).select(*lcols, *rcols)
    else:
        r_nb = _block_count(right.agg(F.count(F.lit(1))).scalar(), block_rows, mb, mr)
        salts = F.ceil(_block_count(left.agg(F.count(F.lit(1))).scalar(), block_rows, mb, mr) / FAN_IN).cast("bigint")
        lrows = lb.select(*lcols, F.pmod(F.col(_B), salts).alias("_salt"),
                          F.explode(F.sequence(F.lit(0).cast("bigint"), r_nb - 1)).alias("r_b"))
        rrows = rb.select(F.col(_B).alias("r_b"), *rcols, F.explode(F.sequence(F.lit(0).cast("bigint"), salts - 1)).alias("_salt"))
        pairs = lrows.join(rrows, ["r_b", "_salt"]).select(*lcols, *rcols)
    kb = [(f"l_{lc}", f"r_{rc}", w) for lc, rc, w in bonus]
    xs = f"l_{exclude_self}" if isinstance(exclude_self, str) else exclude_self
    cand = pairs.mapInArrow(_topk_kernel(k, xs, clip_bonus, kb, cap), TOPK_SCHEMA)
    return rank_topk(cand, k)


def rank_topk(cand: DataFrame, k: int, key: str = "l_id") -> DataFrame:
    """Final top-k per left id over per-block candidates (Catalyst plans a
    partial + final WindowGroupLimit, so at most k rows per key survive
    each map task before the shuffle)."""
    from pyspark.sql import Window
    w = Window.partitionBy(key).orderBy(F.col("score").desc(), F.col("r_id").asc())
    return cand.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)


def threshold_self_join(vecs: DataFrame, threshold: float, id_col: str = "id", vec_col: str = "embedding",
                        block_rows: int = config.JOIN_BLOCK_ROWS, min_pairs: int | None = None, forest: bool = False) -> DataFrame:
    """All pairs ``id_a < id_b`` with inner product >= threshold (exact), or
    with ``forest`` edges ``(id_a, id_b)`` that connect the same rows, at most
    one per row of a block pair.

    Block pairs are placed on a grid key (right block, left block mod salts),
    so a key gathers about ``FAN_IN`` left blocks however many there are.

    Blocks meet in the upper triangle ``b1 <= b2``; pairs inside one block
    are kept only for ``id_a < id_b``, so every pair is produced once.
    """
    spark = vecs.sparkSession
    mb = parallel_blocks(spark, min_pairs, triangle=True)
    lb = pack_blocks(vecs, None, id_col, vec_col, [], block_rows, mb, prefix="l_")
    rb = lb.select(F.col(_B), F.col(_NB), F.col("l_ids").alias("r_ids"), F.col("l_vecs").alias("r_vecs"))
    salts = F.ceil(F.col(_NB) / FAN_IN).cast("bigint")
    lrows = lb.select(F.col(_B).alias("l_b"), "l_ids", "l_vecs", F.pmod(F.col(_B), salts).alias("_salt"),
                      F.explode(F.sequence(F.col(_B), F.col(_NB) - 1)).alias("r_b"))
    rrows = rb.select(F.col(_B).alias("r_b"), "r_ids", "r_vecs", F.explode(F.sequence(F.lit(0).cast("bigint"), salts - 1)).alias("_salt"))
    pairs = lrows.join(rrows, ["r_b", "_salt"]).select("l_ids", "l_vecs", "r_ids", "r_vecs",
                                                      (F.col("l_b") == F.col("r_b")).alias("_same"))
    if forest:
        return pairs.mapInArrow(_forest_kernel(threshold), "id_a BIGINT, id_b BIGINT")
    return pairs.mapInArrow(_pair_kernel(threshold), PAIR_SCHEMA)
