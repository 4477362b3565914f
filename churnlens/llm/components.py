"""Connected components by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from churnlens.llm.common import shared_table


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
    return both.join(least, "a").filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = down.groupBy("a").agg(F.min("b").alias("m"))
    moved = down.join(least, "a").filter("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return moved.unionByName(least.select("a", F.col("m").alias("b"))).distinct()


def components(links: DataFrame) -> DataFrame:
    """(node, component) of every node that has a link; component is its smallest node.

    ``links`` has columns a, b (long). Each round ends in a written table, so
    lost executors never replay earlier rounds.
    """
    edges, before = links.filter("a <> b").select("a", "b"), None
    rows = links.count()  # a round never adds more than one edge per edge and direction
    while True:
        edges = shared_table(_small_star(_large_star(edges)), "component-edges", 2 * rows)
        state = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if state == before:
            break
        before = state
    own = edges.select(F.col("a").alias("node"), F.col("b").alias("component"))
    return own.unionByName(edges.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct())
