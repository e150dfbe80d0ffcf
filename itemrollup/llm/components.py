"""Connected components of a link table, by alternating large-star and small-star steps.

Nodes are longs.  Every step is a grouped minimum with partial aggregation and a join on the
node, so a node with a third of all links is never gathered; no link reaches the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).collect()[0])


def components(links: DataFrame) -> DataFrame:
    """(node, root) of every node in ``links`` (a, b): root is the smallest node of its component."""
    edges = cut(links.where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "links")
    before = None
    while True:
        # large star: neighbours above a node move to the smallest of its neighbourhood
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.where("b > a").join(low, "a").select(F.col("m").alias("a"), "b").where("a <> b").distinct()
        # small star: a node and its smaller neighbours move to the smallest of these
        down = large.groupBy("b").agg(F.min("a").alias("m"))
        small = large.join(down, "b").select(F.col("m").alias("m"), F.explode(F.array("a", "b")).alias("b")).where("m <> b")
        edges = cut(small.select(F.col("m").alias("a"), "b").distinct(), "stars")
        now = _state(edges)
        if now == before:
            break
        before = now
    roots = edges.select(F.col("b").alias("node"), F.col("a").alias("root"))
    return roots.unionByName(edges.select(F.col("a").alias("node"), F.col("a").alias("root")).distinct())
