"""Connected components of an edge table.

Alternating large-star / small-star contraction (Kiveris et al.,
"Connected Components in MapReduce and Beyond", SoCC 2014) on edge
DataFrames.  Each step is a min-aggregate (map-side combined) and the
return of the minimum to the node's edges.  A node that holds more than
one in ``HUBS`` of all edge ends is a hub; there are fewer than ``HUBS``
of them whatever the graph is, so their minima are broadcast and their
edges stay where they are, while the edges of all other nodes meet by an
equi-join in which no key has more than that share of the rows.
Lineage is cut every round by a table in the session's checkpoint folder,
so a lost executor only recomputes one round; the table of the round
before is then removed.  O(log^2 n) rounds.
The label of a component is its smallest node id.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir, remove_path

HUBS = 1000       # bound of the broadcast table of hubs (rows of two numbers)
RELABEL_PARTS = 16


def _canon(e: DataFrame) -> DataFrame:
    """Undirected edges as (a, b) with a > b, no self loops, no duplicates."""
    return (e.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
             .where(F.col("a") != F.col("b")).distinct())


def _least(rows: DataFrame, n: int) -> DataFrame:
    """``rows (u, v)`` with ``m``, the smallest v of each u; ``n``: at least the number of rows.

    A hub's rows have their minimum from the broadcast and pass the join under keys of their own."""
    least = rows.groupBy("u").agg(F.min("v").alias("m"), F.count(F.lit(1)).alias("n"))
    hub = F.col("n") * HUBS > n
    hubs = F.broadcast(least.where(hub).select("u", F.col("m").alias("hub_m")))
    key = F.when(F.col("hub_m").isNull(), F.col("u")).otherwise(F.xxhash64("u", "v"))
    rest = least.where(~hub).select(F.col("u").alias("key"), "m")
    return (rows.join(hubs, "u", "left").withColumn("key", key).join(rest, "key", "left")
            .select("u", "v", F.coalesce("hub_m", "m").alias("m")))


def _large_star(e: DataFrame, n: int) -> DataFrame:
    both = e.select(F.col("a").alias("u"), F.col("b").alias("v")).unionByName(
        e.select(F.col("b").alias("u"), F.col("a").alias("v")))
    # No distinct here: duplicates are harmless to the small-star step,
    # which ends the round with a canonical distinct edge set.
    return (_least(both, 2 * n).where(F.col("v") > F.col("u"))
            .select(F.col("v").alias("a"), F.least("u", "m").alias("b")))


def _small_star(e: DataFrame, n: int) -> DataFrame:
    o = e.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
    pairs = F.array(F.struct(F.col("v").alias("a"), F.col("m").alias("b")), F.struct(F.col("u").alias("a"), F.col("m").alias("b")))
    return _canon(_least(o, n).select(F.inline(pairs)))


def connected_components(edges: DataFrame, src: str = "id_a", dst: str = "id_b", max_rounds: int = 64) -> DataFrame:
    """``(id, component)`` for every node that appears in ``edges``.

    Every round is one job: it writes the edges to the shared checkpoint
    folder and observes their number and hash sum on the way, so lineage
    never spans more than one round (a lost executor re-reads the round
    before) and convergence needs no second pass.  ``max_rounds`` guards
    against a fault in the loop; O(log^2 n) rounds always suffice.
    """
    spark = edges.sparkSession
    folder = f"{ensure_checkpoint_dir(spark).rstrip('/')}/components-{uuid.uuid4().hex}"

    def cut(e: DataFrame, name: int) -> tuple[DataFrame, tuple]:
        seen = Observation()
        path = f"{folder}/{name}"
        e.observe(seen, F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("h")).write.parquet(path)
        return spark.read.schema(e.schema).parquet(path), (seen.get["n"], seen.get["h"])

    e, before = cut(_canon(edges.select(F.col(src).cast("bigint").alias("a"), F.col(dst).cast("bigint").alias("b"))), 0)
    for i in range(max_rounds):
        # (the large star gives one row an edge, so the small star has no more rows than there are edges)
        e, now = cut(_small_star(_large_star(e, before[0]), before[0]), i + 1)
        remove_path(spark, f"{folder}/{i}")
        if now == before:
            break
        before = now
    else:  # pragma: no cover
        raise RuntimeError("connected components did not converge")
    # Converged: every edge is (node, component minimum).
    return (e.select(F.col("a").alias("id"), F.col("b").alias("component"))
             .unionByName(e.select(F.col("b").alias("id"), F.col("b").alias("component")))
             .distinct())


def merge_components(components: DataFrame, edges: DataFrame, src: str = "id_a", dst: str = "id_b") -> DataFrame:
    """A component table ``(id, component)`` after new edges: equal to the components of all edges together.

    Only the labels that the new edges touch form a graph of their own; its components relabel the rows of those
    labels, all other rows stay as they are.  Nodes that the table does not know join it.  A label's rows are dealt
    over ``RELABEL_PARTS`` parts, so a large component is no hot key.
    """
    ends = edges.select(F.col(src).cast("bigint").alias("a"), F.col(dst).cast("bigint").alias("b"))
    label = lambda side: components.select(F.col("id").alias(side), F.col("component").alias(f"{side}_label"))
    known = ends.join(label("a"), "a", "left").join(label("b"), "b", "left")
    graph = known.select(F.coalesce("a_label", "a").alias("id_a"), F.coalesce("b_label", "b").alias("id_b"))
    # (label -> smallest label of what it is now connected with; a node unknown so far is its own label)
    moved = connected_components(graph.where("id_a <> id_b").distinct())
    to = moved.where("id <> component").select(F.col("id").alias("component"), F.col("component").alias("to"),
                                               F.explode(F.sequence(F.lit(0), F.lit(RELABEL_PARTS - 1))).alias("part"))
    rows = components.select("id", "component").withColumn("part", F.pmod(F.xxhash64("id"), F.lit(RELABEL_PARTS)).cast("int"))
    old = rows.join(to, ["component", "part"], "left").select("id", F.coalesce("to", "component").alias("component"))
    nodes = ends.select(F.col("a").alias("id")).unionByName(ends.select(F.col("b").alias("id"))).distinct()
    new = (nodes.join(components.select("id"), "id", "left_anti").join(moved, "id", "left")
           .select("id", F.coalesce("component", "id").alias("component")))
    return old.unionByName(new)
