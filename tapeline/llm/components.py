"""Connected components by alternating large-star and small-star steps (Kiveris et al., 2014)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tapeline.llm.common import join_groups, staged


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """One step. Large: each node links its larger neighbours to its least neighbour (or itself). Small: its smaller ones and itself.

    The least neighbour is a partial aggregate and goes back to the edges by `join_groups`, so
    a hub with any share of the edges is no hot key.
    """
    both = edges.select(F.col("a").alias("u"), F.col("b").alias("v"))
    if large:
        both = both.unionByName(edges.select(F.col("b").alias("u"), F.col("a").alias("v")))
    else:
        both = both.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = staged(both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"), F.count(F.lit(1)).alias("degree")))
    total = least.agg(F.sum("degree")).first()[0] or 0
    back = join_groups(both, least, "u", "degree", total, "v")
    if large:
        linked = back.where("v > u").select(F.col("v").alias("a"), F.col("m").alias("b"))
    else:
        linked = back.select(F.col("v").alias("a"), F.col("m").alias("b")).unionByName(least.select(F.col("u").alias("a"), F.col("m").alias("b")))
    return linked.where("a <> b").distinct()


def connected_components(edges: DataFrame) -> DataFrame:
    """(node, component) for the nodes in `edges` (a, b: long); component is the least node reachable.

    Each step is written to the shared folder, so a lost executor costs one step. The number
    of rounds grows with the logarithm of the longest path. Links to oneself add nothing; an
    empty table gives no rows.
    """
    edges = staged(edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a <> b").distinct())
    mark = None
    while True:
        edges = staged(_star(edges, large=True))
        edges = staged(_star(edges, large=False))
        now = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if now == mark:
            break
        mark = now
    return edges.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(
        edges.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    )
