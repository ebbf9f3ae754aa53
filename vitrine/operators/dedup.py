"""Near-duplicate detection.

pairs (exact blocked self-join, or LSH) -> connected components ->
clusters of size >= 2 -> representative (largest image, first wins) ->
unique catalog (anti-join) + per-member report + summary.

Products without a vector count as zero vectors, which are similar to
nothing for a positive threshold, so they are dropped before the join.
Cluster membership stays in tall form (one row per member); only the
preview gathers a bounded number of members (first 4) per cluster.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .. import config
from ..functions.text import or_unknown
from ..functions.vectors import dot, sq_norm
from ..session import stored
from .blocks import TILE_LEFT, TILE_RIGHT, threshold_self_join
from .components import connected_components
from .ordinal import ordinal
from .pivots import pruned_pairs


def _pos(df: DataFrame) -> str:
    return "src_pos" if "src_pos" in df.columns else "id"


def duplicate_pairs(vecs: DataFrame, threshold: float = config.DUPLICATE_SIMILARITY_THRESHOLD,
                    id_col: str = "id", vec_col: str = "embedding", method: str = "blocks") -> DataFrame:
    """All pairs ``id_a < id_b`` with cosine >= threshold (exact); ``method="pivots"`` skips block pairs that cannot
    reach the threshold (large catalogs with clusters)."""
    if threshold <= 0:
        raise ValueError("threshold must be > 0 (zero vectors are dropped before the join)")
    v = vecs.where(F.col(vec_col).isNotNull() & (sq_norm(vec_col) > 0)).select(id_col, vec_col)
    return (pruned_pairs if method == "pivots" else threshold_self_join)(v, threshold, id_col, vec_col)


def duplicate_links(vecs: DataFrame, threshold: float = config.DUPLICATE_SIMILARITY_THRESHOLD,
                    id_col: str = "id", vec_col: str = "embedding") -> DataFrame:
    """Edges ``(id_a, id_b)`` that connect the rows ``duplicate_pairs`` connects, without all pairs:
    equal vectors (by a 128-bit hash) are tied to the smallest id among them, and the block pairs
    of the rest emit spanning forests."""
    if threshold <= 0:
        raise ValueError("threshold must be > 0 (zero vectors are dropped before the join)")
    v = vecs.where(F.col(vec_col).isNotNull()).select(F.col(id_col).cast("bigint").alias("id"), F.col(vec_col).alias("v"))
    _, members = equal_vectors(v.where(sq_norm("v") >= threshold), "id", "v")
    rest = v.where(sq_norm("v") > 0).join(members.select("id"), "id", "left_anti")
    return threshold_self_join(rest, threshold, "id", "v", forest=True).unionByName(
        members.select(F.col("first").alias("id_a"), F.col("id").alias("id_b")))


LSH_TILE = 4096     # rows of one bucket tile
LSH_SALTS = 32      # parts over which a bucket's rows are counted


def _sign_hashes(bands: int, bits: int, probes: int, seed: int, codes: bool = True):
    """Rows ``(id, vector)`` to ``(bucket, home, id, code)``: the bucket of each band, and as a visitor those that differ
    in one of the ``probes`` least certain signs.  ``code``: see ``_codes``; without ``codes`` ``(bucket, home)`` alone."""
    def run(batches):
        import numpy as np
        import pyarrow as pa
        planes = None
        for b in batches:
            for at in range(0, b.num_rows, LSH_TILE):
                part = b.slice(at, LSH_TILE)
                x = part.column(1).flatten().to_numpy(zero_copy_only=False).reshape(part.num_rows, -1)
                if planes is None:
                    planes = np.random.default_rng(seed).standard_normal((x.shape[1], bands * bits))
                side = (x @ planes).reshape(-1, bands, bits)
                home = ((side > 0) * (1 << np.arange(bits))).sum(axis=2)
                near = np.argsort(np.abs(side), axis=2, kind="stable")[:, :, :probes]
                h = np.concatenate([home[:, :, None], home[:, :, None] ^ (1 << near)], axis=2) + (np.arange(bands)[:, None] << bits)
                each = bands * (probes + 1)
                out = [pa.array(h.reshape(-1)), pa.array(np.tile(np.arange(probes + 1) == 0, part.num_rows * bands))]
                names = ["bucket", "home"]
                if codes:
                    which = pa.array(np.repeat(np.arange(part.num_rows), each))
                    out += [part.column(0).take(which), pa.array(_codes(x), pa.binary()).take(which)]
                    names += ["id", "code"]
                yield pa.RecordBatch.from_arrays(out, names=names)
    return run


def _codes(x) -> list[bytes]:
    """A short form of every vector: its largest coordinate and its distance to the form (two doubles), then every
    coordinate as a share of the largest in 1/127."""
    import numpy as np
    x = x.astype(np.float64, copy=False)
    top = np.abs(x).max(axis=1)
    q = np.rint(x / np.where(top > 0, top, 1.0)[:, None] * 127).astype(np.int8)
    off = np.linalg.norm(x - q * (top / 127)[:, None], axis=1)
    head = np.stack([top, off], axis=1)
    return [h.tobytes() + c.tobytes() for h, c in zip(head, q)]


def _decoded(raw):
    """``(forms, norms of the forms, distances to the vectors)`` of a byte matrix of codes."""
    import numpy as np
    head = raw[:, :16].copy().view(np.float64)
    x = raw[:, 16:].view(np.int8) * (head[:, :1] / 127)
    return x, np.linalg.norm(x, axis=1), head[:, 1]


def lsh_bands(threshold: float, bits: int, probes: int, recall: float, trials: int = 20_000, seed: int = 11) -> int:
    """Bands that find a pair at the threshold with probability ``recall``: by simulated pairs of that angle, since a
    pair is met where all signs agree or where one differs that either row is least sure of."""
    import numpy as np
    rng = np.random.default_rng(seed)
    t = min(threshold, 1.0)
    a = rng.standard_normal((trials, bits))
    b = t * a + math.sqrt(1 - t * t) * rng.standard_normal((trials, bits))
    differ = (a > 0) != (b > 0)
    n = differ.sum(axis=1)
    unsure = [(np.argsort(np.abs(x), axis=1, kind="stable").argsort(axis=1) < probes) & differ for x in (a, b)]
    met = ((n == 0) | (n == 1) & (unsure[0] | unsure[1]).any(axis=1)).mean()
    return 1 if met >= 1 else max(1, math.ceil(math.log(1 - recall) / math.log(1 - max(met, 1 / trials))))


def _bucket_pairs(threshold: float):
    """Rows sorted by ``bucket, cell`` to the id pairs of a cell that may reach the threshold: their forms' inner product
    lies no further from the vectors' than the distances allow, so no pair that shares a bucket is lost here."""
    def found(ids, tile, home, form, cell):
        import numpy as np
        own, to = divmod(int(cell), 1 << 24)
        x, norm, off = form
        left, right = (np.arange(len(ids)),) * 2 if own == to else (np.flatnonzero(tile == own), np.flatnonzero(tile == to))
        for a in range(0, len(left), TILE_LEFT):
            for b in range(0, len(right), TILE_RIGHT):
                p, q = left[a: a + TILE_LEFT], right[b: b + TILE_RIGHT]
                spare = norm[p, None] * off[q] + off[p, None] * (norm[q] + off[q]) + 1e-9
                hit = (x[p] @ x[q].T + spare >= threshold) & (home[p, None] | home[q])
                i, j = np.nonzero(hit)
                i, j = ids[p[i]], ids[q[j]]
                keep = i < j if own == to else i != j
                yield np.minimum(i, j)[keep], np.maximum(i, j)[keep]

    def groups(rows):
        """Pairs of the whole cells of ``rows``; cells of one row or without a row at home have none."""
        import numpy as np
        import pyarrow as pa
        bucket, cell, ids, tile, home, raw = rows
        if not len(bucket):
            return
        first = np.flatnonzero(np.concatenate([[True], (np.diff(bucket) != 0) | (np.diff(cell) != 0)]))
        last = np.append(first[1:], len(bucket))
        use = (last - first > 1) & (np.add.reduceat(home.astype(np.int64), first) > 0)
        form, held, n = _decoded(raw), [], 0
        batch = lambda held: pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in zip(*held)], names=["id_a", "id_b"])
        for lo, hi in zip(first[use].tolist(), last[use].tolist()):
            for pairs in found(ids[lo:hi], tile[lo:hi], home[lo:hi], tuple(f[lo:hi] for f in form), cell[lo]):
                held.append(pairs)
                n += len(pairs[0])
                if n > 100_000:
                    yield batch(held)
                    held, n = [], 0
        if held:
            yield batch(held)

    def run(batches):
        import numpy as np
        kept = None
        for b in batches:
            if not b.num_rows:
                continue
            rows = [b.column(k).to_numpy(zero_copy_only=False) for k in range(5)]
            codes = b.column(5)
            at = np.frombuffer(codes.buffers()[1], np.int32)[codes.offset: codes.offset + len(codes) + 1]
            rows.append(np.frombuffer(codes.buffers()[2], np.uint8)[at[0]: at[-1]].reshape(len(codes), -1))
            if kept is not None:
                rows = [np.concatenate(c) for c in zip(kept, rows)]
            edge = np.flatnonzero((np.diff(rows[0]) != 0) | (np.diff(rows[1]) != 0)) + 1
            cut = int(edge[-1]) if len(edge) else 0
            yield from groups([c[:cut] for c in rows])
            kept = [c[cut:].copy() for c in rows]
        if kept is not None:
            yield from groups(kept)
    return run


def equal_vectors(vecs: DataFrame, id_col: str = "id", vec_col: str = "embedding") -> tuple[DataFrame, DataFrame]:
    """``(representatives (id, v), members (id, first))``: rows with equal vectors (by a 128-bit hash) have one
    representative, the smallest id; ``members`` lists the others."""
    hashed = vecs.select(F.col(id_col).cast("bigint").alias("id"), F.col(vec_col).alias("v"),
                         F.xxhash64(vec_col).alias("_h"), F.xxhash64(vec_col, F.lit(1)).alias("_g"))
    salted = hashed.select("id", "_h", "_g", F.pmod(F.xxhash64("id"), F.lit(LSH_SALTS)).alias("_s"))
    least = salted.groupBy("_h", "_g", "_s").agg(F.min("id").alias("least"))
    first = least.groupBy("_h", "_g").agg(F.min("least").alias("first"))
    back = least.select("_h", "_g", "_s").join(first, ["_h", "_g"])  # at most LSH_SALTS rows a vector
    members = salted.join(back, ["_h", "_g", "_s"]).where("id <> first").select("id", "first")
    return hashed.select("id", "v").join(members.select("id"), "id", "left_anti"), members


def lsh_pairs(vecs: DataFrame, threshold: float = config.DUPLICATE_SIMILARITY_THRESHOLD, bits: int = 12,
              recall: float = 0.98, seed: int = 7, id_col: str = "id", vec_col: str = "embedding", probes: int = 2) -> DataFrame:
    """Approximate pairs by banded random-hyperplane signs with several probes.

    Candidates share a bucket of ``bits`` signs, or one visits the other's; they are verified by their inner
    product: pairs can be missed, never invented.  The number of bands follows from the recall wanted at the
    threshold.  Equal vectors are collapsed first: they come as pairs with their representative (the smallest id),
    other pairs are between representatives.  What travels to a bucket is a row's short form (a byte a coordinate)
    with its error, which leaves the pairs that may reach the threshold; only these fetch their vectors.  A bucket of
    more than ``LSH_TILE`` rows is cut into tiles that meet two by two, each pair of tiles on a key of its own.  Where
    buckets would be that large on average there are more ``bits``, so copies do not grow with the rows.
    """
    v = vecs.where(F.col(vec_col).isNotNull() & (sq_norm(vec_col) > 0))
    rep, members = equal_vectors(v, id_col, vec_col)
    rep = stored(rep.where("id IS NOT NULL"), "lsh-rows")
    probes = min(probes, bits)
    bits = max(bits, math.ceil(math.log2(max(rep.count() * (probes + 1) / LSH_TILE, 1))))
    bands = lsh_bands(threshold, bits, probes, recall)
    sizes = rep.mapInArrow(_sign_hashes(bands, bits, probes, seed, codes=False), "bucket BIGINT, home BOOLEAN").groupBy("bucket").agg(F.count(F.lit(1)).alias("n"))
    # (every such bucket holds LSH_TILE rows: a few thousandths of the rows, two numbers each)
    large = F.broadcast(sizes.where(F.col("n") > LSH_TILE).select("bucket", F.ceil(F.col("n") / LSH_TILE).alias("tiles")))
    signs = rep.mapInArrow(_sign_hashes(bands, bits, probes, seed), "bucket BIGINT, home BOOLEAN, id BIGINT, code BINARY")
    dealt = signs.join(large, "bucket", "left").withColumn("tiles", F.coalesce("tiles", F.lit(1)).cast("bigint"))
    dealt = dealt.withColumn("tile", F.pmod(F.xxhash64("id", F.lit(2)), F.col("tiles")))
    other = F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("tiles") - 1)).alias("other")
    dealt = dealt.select("bucket", "id", "tile", "home", "code", other).withColumn("cell", F.least("tile", "other") * (1 << 24) + F.greatest("tile", "other"))
    dealt = dealt.select("bucket", "cell", "id", "tile", "home", "code").repartition("bucket", "cell").sortWithinPartitions("bucket", "cell")
    near = dealt.mapInArrow(_bucket_pairs(threshold), "id_a BIGINT, id_b BIGINT").distinct()
    a, b = (rep.select(F.col("id").alias(f"id_{x}"), F.col("v").alias(f"v_{x}")) for x in "ab")
    scored = near.join(a, "id_a").join(b, "id_b").select("id_a", "id_b", dot("v_a", "v_b").alias("sim")).where(F.col("sim") >= threshold)
    between = scored.groupBy("id_a", "id_b").agg(F.max("sim").alias("sim"))
    one = v.select(F.col(id_col).cast("bigint").alias("id"), sq_norm(vec_col).alias("sim"))
    equal = members.join(one, "id").where(F.col("sim") >= threshold).select(F.col("first").alias("id_a"), F.col("id").alias("id_b"), "sim")
    return between.unionByName(equal)


def cluster_members(catalog: DataFrame, components: DataFrame, min_size: int = config.MIN_CLUSTER_SIZE) -> DataFrame:
    """One row per member of a cluster with >= min_size members:
    ``component, id, pos, name, image_path, image_bytes, size``."""
    pos = _pos(catalog)
    cols = [F.col("id"), F.col(pos).alias("pos"), or_unknown("productDisplayName").alias("name"),
            F.coalesce(F.col("image_path").cast("string"), F.lit("")).alias("image_path")]
    cols.append(F.col("image_bytes").cast("bigint").alias("image_bytes") if "image_bytes" in catalog.columns
                else F.lit(None).cast("bigint").alias("image_bytes"))
    m = components.join(catalog.select(*cols), "id")
    sizes = m.groupBy("component").agg(F.count(F.lit(1)).alias("size"), F.min("pos").alias("first_pos"))
    return m.join(sizes.where(F.col("size") >= min_size), "component")


def clusters(members: DataFrame, vectors: DataFrame | None = None, id_col: str = "id",
             vec_col: str = "embedding") -> DataFrame:
    """One row per cluster: id (0.. by first member position), representative,
    size, avg_similarity (mean of the full Gram matrix = |mean vector|^2)."""
    rep = members.groupBy("component").agg(
        F.min_by(F.struct(F.col("id").alias("rid"), F.col("name").alias("rname"), F.col("image_path").alias("rimg")),
                 F.struct(-F.coalesce(F.col("image_bytes"), F.lit(-1)), F.col("pos"))).alias("r"),
        F.first("size").alias("size"), F.first("first_pos").alias("first_pos"))
    # Dense numbering by first appearance (distributed: range partitions + offsets).
    rep = ordinal(rep, "first_pos", "cluster_id")
    out = rep.select("component", "cluster_id",
                     F.col("r.rid").alias("representative_id"), F.col("r.rname").alias("representative_name"),
                     F.col("r.rimg").alias("representative_image"), F.col("size").cast("bigint").alias("size"),
                     "first_pos")
    if vectors is not None:
        out = out.join(avg_similarity(members, vectors, id_col, vec_col), "component", "left")
    return out


def avg_similarity(members: DataFrame, vectors: DataFrame, id_col: str = "id", vec_col: str = "embedding") -> DataFrame:
    """Per component: mean of E E^T over members = squared norm of the mean vector (V8)."""
    v = members.select("component", "id").join(vectors.select(F.col(id_col).alias("id"), vec_col), "id")
    tall = v.select("component", F.posexplode(vec_col).alias("dim", "x"))
    per_dim = tall.groupBy("component", "dim").agg(F.avg(F.col("x").cast("double")).alias("mu"))
    return per_dim.groupBy("component").agg(F.sum(F.col("mu") * F.col("mu")).alias("avg_similarity"))


def duplicate_report(members: DataFrame, cl: DataFrame) -> DataFrame:
    """One row per member (S12 content)."""
    j = members.drop("size", "first_pos").join(cl, "component")
    return j.select("cluster_id", F.col("id").alias("product_id"), F.col("name").alias("product_name"),
                    (F.col("id") == F.col("representative_id")).alias("is_representative"),
                    "representative_id", "representative_name",
                    F.round("avg_similarity", 4).alias("avg_similarity"),
                    F.col("size").alias("cluster_size"))


def unique_catalog(catalog: DataFrame, members: DataFrame, cl: DataFrame) -> DataFrame:
    """Catalog minus every non-representative cluster member."""
    removed = (members.join(cl.select("component", "representative_id"), "component")
                      .where(F.col("id") != F.col("representative_id")).select("id"))
    return catalog.join(removed, "id", "left_anti")


def summary(catalog: DataFrame, members: DataFrame, cl: DataFrame,
            threshold: float = config.DUPLICATE_SIMILARITY_THRESHOLD) -> DataFrame:
    """One-row dedup summary (A12); all columns always present."""
    # One aggregate over (catalog rows + cluster rows): no join of two one-row frames.
    u = catalog.select(F.lit(1).alias("p"), F.lit(0).alias("c"), F.lit(0).cast("bigint").alias("s")).unionByName(
        cl.select(F.lit(0).alias("p"), F.lit(1).alias("c"), F.col("size").cast("bigint").alias("s")))
    j = u.agg(F.coalesce(F.sum("p"), F.lit(0)).cast("bigint").alias("total_products"),
              F.coalesce(F.sum("c"), F.lit(0)).cast("bigint").alias("duplicate_clusters"),
              F.coalesce(F.sum("s"), F.lit(0)).cast("bigint").alias("products_in_clusters"))
    unique = F.col("total_products") - (F.col("products_in_clusters") - F.col("duplicate_clusters"))
    return j.select(
        "total_products", "duplicate_clusters", "products_in_clusters", unique.alias("unique_products"),
        F.when(F.col("total_products") > 0, F.round(100 * (1 - unique / F.col("total_products")), 2))
         .otherwise(F.lit(0.0)).alias("reduction_percent"),
        F.lit(float(threshold)).alias("threshold"),
        F.when(F.col("duplicate_clusters") > 0, F.round(F.col("products_in_clusters") / F.col("duplicate_clusters"), 2))
         .otherwise(F.lit(0.0)).alias("avg_cluster_size"))


def summary_series(summ: DataFrame) -> DataFrame:
    """Chart series (A13): total / in clusters / unique."""
    return summ.select(F.expr(
        "stack(3, 'Total Products', total_products, 'In Duplicate Clusters', products_in_clusters, "
        "'Unique Products', unique_products) AS (label, value)"))


def cluster_preview(members: DataFrame, cl: DataFrame, n_clusters: int = 4, n_members: int = 4) -> DataFrame:
    """First n clusters x first n members (+ representative)."""
    top = cl.where(F.col("cluster_id") < n_clusters)
    m = members.join(top.select("component", "cluster_id"), "component")
    w = Window.partitionBy("cluster_id").orderBy("pos")
    m = m.withColumn("member_rank", F.row_number().over(w).cast("bigint")).where(F.col("member_rank") <= n_members)
    return m.join(top.select("cluster_id", "representative_id"), "cluster_id").select(
        "cluster_id", "member_rank", F.col("id").alias("product_id"), F.col("name").alias("product_name"),
        (F.col("id") == F.col("representative_id")).alias("is_representative"))


def deduplicate(catalog: DataFrame, threshold: float = config.DUPLICATE_SIMILARITY_THRESHOLD,
                vec_col: str = "embedding", method: str = "exact") -> dict:
    """Whole job (C6): returns the intermediate and final DataFrames.  The catalog and the members are stored once."""
    catalog = stored(catalog, "dedup-catalog")
    vecs = catalog.select("id", vec_col)
    pairs = (lsh_pairs(vecs, threshold, vec_col=vec_col) if method == "lsh"
             else duplicate_pairs(vecs, threshold, vec_col=vec_col, method="pivots" if method == "pivots" else "blocks"))
    comps = connected_components(duplicate_links(vecs, threshold, vec_col=vec_col) if method == "exact" else pairs)
    members = stored(cluster_members(catalog, comps), "dedup-members")
    cl = clusters(members, vecs, vec_col=vec_col)
    return {"pairs": pairs, "components": comps, "members": members, "clusters": cl,
            "report": duplicate_report(members, cl), "unique": unique_catalog(catalog, members, cl),
            "summary": summary(catalog, members, cl, threshold)}
