"""Connected components over a table of links, by alternating star contraction; nothing is collected."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siftstone.llm.common import drop_table, materialize


def _large_star(edges: DataFrame) -> DataFrame:
    """Each node's larger neighbours are linked to the smallest of its neighbourhood."""
    both = edges.select("u", "v").unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    return both.join(least, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u <> v").distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """Each node and its smaller neighbours are linked to the smallest of them. Links go from larger to smaller."""
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    joined = edges.join(least, "u")
    moved = joined.select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.unionByName(least.select("u", F.col("m").alias("v"))).filter("u <> v").distinct()


def connected_components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """edges (u, v) of any ordered type -> (node, root): root is the smallest node of node's component.

    Every node that has a link is returned, the roots themselves included; self links and repeated links
    change nothing; an empty table gives an empty one. Each round costs a few shuffles of the links and is
    written to the shared folder, so that a lost executor repeats one round at most. Hubs are handled by
    partial aggregation (the minimum) and by joins whose other side holds one row a node, which AQE may split.
    """
    norm = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).filter("u <> v").distinct()
    now = materialize(norm, "links")
    mark = None
    for _ in range(max_rounds):
        nxt = materialize(_small_star(_large_star(now)), "links")
        new = nxt.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        drop_table(now)
        now = nxt
        if new == mark:
            break
        mark = new
    else:
        raise RuntimeError(f"components did not settle in {max_rounds} rounds")
    roots = now.select(F.col("v").alias("node")).distinct()
    return now.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(roots.select("node", F.col("node").alias("root")))
