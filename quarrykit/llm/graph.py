"""Connected components of an edge table, by alternating star operations.

Both stars only ever link a node to a smaller one of its component, so a
path of n nodes needs about log2(n) rounds and a star needs one. Each round's
edges are written to the shared folder: a lost executor costs one round at most.
Minima are grouped aggregates (partial on the map side) joined back, so a
node with very many neighbours is split by the adaptive skew join.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarrykit.sharedfs import cut, drop


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    low = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("m"))
    return both.join(low, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))


def _small_star(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a <> b").distinct()
    low = down.groupBy("a").agg(F.min("b").alias("m"))
    turned = down.join(low, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return turned.unionByName(low.select("a", F.col("m").alias("b"))).where("a <> b").distinct()


def components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """(node, root) for each node that has an edge; ``edges`` has a and b, the root is the least node reached."""
    now = cut(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges")
    seen = None
    for _ in range(max_rounds):
        # a forest of stars: every node has one edge, to a root that has none
        mark = now.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if tuple(mark) == seen:
            return now.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(now.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())
        seen = tuple(mark)
        last, now = now, cut(_small_star(_large_star(now)), "edges")
        drop(last)
    raise RuntimeError(f"components did not settle in {max_rounds} rounds")
