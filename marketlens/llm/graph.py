"""Connected components of an edge table by alternating large and small stars.

Both steps replace edges by edges to the smallest known neighbour, so a
component ends as a star around its smallest node after a logarithmic number
of rounds.  Neighbour lists are never collected: the smallest neighbour is a
map-side combined aggregate that is joined back to the edges, and adaptive
execution splits the join where one node has very many edges.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut_lineage


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, root) for every node but the roots; root is the smallest node of
    the component.  Self-loops and nulls are ignored; no edges give no rows."""
    def state(e: DataFrame) -> tuple:
        return tuple(e.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())

    x, y = F.col(a), F.col(b)
    now = cut_lineage(edges.where(x != y).select(F.greatest(x, y).alias("u"), F.least(x, y).alias("v")).distinct())
    seen = state(now)
    while seen[0]:
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = (both.join(low, "u").where("v > u")
                 .select(F.col("v").alias("u"), F.col("m").alias("v")).distinct())
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (large.join(low, "u")
                 .select(F.explode(F.array(F.struct("v", "m"), F.struct(F.col("u").alias("v"), "m"))).alias("e"))
                 .select(F.col("e.v").alias("u"), F.col("e.m").alias("v")).where("u != v").distinct())
        now = cut_lineage(small)
        after = state(now)
        if after == seen:
            break
        seen = after
    return now.select(F.col("u").alias("node"), F.col("v").alias("root"))
