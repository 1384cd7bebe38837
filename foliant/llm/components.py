"""Connected components of a graph given as an edge table, without collecting any of it.

Alternating large-star and small-star contraction: each round rewrites edges towards the smallest neighbour known, and
a logarithmic number of rounds leaves every node beside the smallest node of its component. Each round's edges are
written to the shared folder, so that lineage stays short and a lost executor repeats one round at most.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from foliant.llm.common import discard, staged


def _star(edges: DataFrame, larger: bool) -> DataFrame:
    """One star step on edges (a, b).

    Large: neighbours greater than a node move to the least of the node and its neighbours. Small: a node's neighbours
    up to the node move there. A hub's neighbours are never gathered: its least neighbour comes from a partial
    aggregation and goes back by a join, which Spark may split where it is skewed.
    """
    both = edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    if not larger:
        both = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
    joined = both.join(least, "a")
    if larger:
        moved = joined.where(F.col("b") > F.col("a")).select(F.col("b").alias("a"), F.col("m").alias("b"))
    else:
        moved = joined.select(F.col("b").alias("a"), F.col("m").alias("b")).unionByName(least.select("a", F.col("m").alias("b")))
    return moved.where("a <> b").distinct()


def components(edges: DataFrame) -> DataFrame:
    """(node, component) for every node of edges (a, b), component the smallest node reachable, for numeric nodes.

    Self-loops and repeated edges are harmless, isolated nodes do not appear, and no edges give no rows.
    """
    now = staged(edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a <> b").distinct())

    def mark(df: DataFrame) -> tuple:
        r = df.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        return tuple(r)

    seen = mark(now)
    while seen[0]:
        after = staged(_star(_star(now, True), False))
        fresh = mark(after)
        discard(now)
        now, same = after, fresh == seen
        seen = fresh
        if same:
            break
    return now.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("component")).unionByName(now.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()).groupBy("node").agg(F.min("component").alias("component"))
