"""Connected components by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from citeweave.llm.common import store


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """Hangs the neighbours of each node (larger ones, or itself and smaller ones) on the least of them.

    Joins by node with the minimum, an aggregate with map-side combine; a hub's edges are never gathered.
    """
    if large:
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        out = both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    else:
        least = edges.groupBy("a").agg(F.min("b").alias("m"))
        hung = edges.join(least, "a")
        out = hung.where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b")).unionByName(least.select("a", F.col("m").alias("b")))
    return out.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()


def components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """(node, root) for every node with an edge; root is the least node of its component. edges: columns a and b."""
    edges = store(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    for _ in range(max_rounds):
        new = store(_star(_star(edges, True), False))
        # Settled when every node hangs on one root and no root hangs on anything.
        unsettled = new.groupBy("a").agg(F.count(F.lit(1)).alias("n")).where("n > 1").limit(1).count()
        unsettled = unsettled or new.select("a").join(new.select(F.col("b").alias("a")), "a", "left_semi").limit(1).count()
        edges = new
        if not unsettled:
            break
    else:
        raise RuntimeError(f"components still change after {max_rounds} rounds")
    return edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
