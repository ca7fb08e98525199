"""Connected components by alternating star contractions, all in DataFrame operations.

Nothing is gathered per node: a star's centre is found by ``min`` (partial aggregates run before the
shuffle) and handed to its edges by a join, which adaptive execution can split when one node has a third
of all edges. Each round is written to the shared folder, so lineage stays short and a lost executor costs
one round at most.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import drop, written


def _large_star(edges: DataFrame) -> DataFrame:
    """Every neighbour greater than the node is linked to the least of the node and its neighbours."""
    both = edges.select("u", "v").union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    return both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """The node and its smaller neighbours are linked to the least of them. Edges have u > v."""
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    linked = edges.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return linked.union(least.select("u", F.col("m").alias("v"))).where("u <> v").distinct()


def connected_components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """Rows (node, component) for every node with a link to another; component is the least node reachable.

    Links may repeat, point either way or join a node to itself (ignored); those with a null end are
    ignored. No links give no rows. Rounds go on until nothing changes: each one takes a link's ends to no greater
    ones and some to lesser ones until every node hangs on its component's least, so they end.
    """
    e = edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).where(f"{a} is not null and {b} is not null and {a} <> {b}").distinct()
    (e, path), before = written(e, "links"), None
    while True:
        (e, new), old = written(_small_star(_large_star(e)), "links"), path
        drop(e.sparkSession, old)
        path = new
        # Both stars are fixed points exactly when every node hangs on its component's least node: the sums then stay.
        now = e.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")), F.sum(F.col("v").cast("decimal(38,0)"))).first()
        if now == before:
            break
        before = now
    roots = e.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return e.select(F.col("u").alias("node"), F.col("v").alias("component")).union(roots)
