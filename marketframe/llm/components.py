"""Connected components of an edge table by alternating large-star and
small-star steps (Kiveris et al., 2014).

Each step is a grouped minimum (partial sums before the shuffle) joined back
to the edges, so neither links nor components ever meet in one task; a hub
with many edges is split by AQE's skew join. Edges are written to the shared
folder after each round, which cuts lineage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stage


def _star(edges: DataFrame, both: DataFrame, large: bool) -> DataFrame:
    """Large star: neighbours above a node go to its smallest neighbour (or
    itself). Small star: the node and its lower neighbours go to the smallest."""
    near = both if large else edges  # edges hold u > v
    low = near.groupBy("u").agg(F.min("v").alias("m")).select(
        F.col("u").alias("c"), F.least("u", "m").alias("m"))
    if large:
        j = both.join(low, both["u"] == low["c"]).filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    else:
        j = edges.join(low, edges["u"] == low["c"]).select(F.col("v").alias("u"), F.col("m").alias("v"))
        j = j.unionByName(low.select(F.col("c").alias("u"), F.col("m").alias("v")))
    return j.filter("u > v").distinct()


def components(edges: DataFrame, u: str = "u", v: str = "v", max_rounds: int = 64) -> DataFrame:
    """(node, root) for every node that has an edge to another node; root is the
    smallest node of its component. Null ends and loops are ignored; an empty
    edge table gives no rows. Ends must be integers."""
    e = stage(edges.select(F.greatest(u, v).alias("u"), F.least(u, v).alias("v"))
                   .filter("u > v").distinct(), "edges")
    mark = None
    for _ in range(max_rounds):
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        big = stage(_star(e, both, True), "large-star")
        e = stage(_star(big, big, False), "small-star")
        now = e.agg(F.count(F.lit(1)).alias("n"),
                    F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("h")).first()
        if now == mark:
            break
        mark = now
    else:
        raise RuntimeError("components did not converge")
    # converged: every edge is (node, root)
    return e.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(
        e.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
