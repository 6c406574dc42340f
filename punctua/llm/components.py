"""Connected components over an edge table, by alternating star contractions."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from punctua.llm.common import stored


def components(edges: DataFrame) -> DataFrame:
    """(node, component) for every node of ``edges`` (``a``, ``b``: bigint);
    ``component`` is the smallest node reachable.

    Each round hangs the larger neighbours of every node below its smallest
    neighbour and then the smaller ones likewise, until the edges are stars.  A
    node's minimum is combined inside the tasks, and a hub with many neighbours
    is only ever one side of a join, which can be split.  Each round is stored.
    Loops and NULL ends are ignored; without edges the result is empty.
    """
    a, b = F.col("a"), F.col("b")
    start = edges.filter(a != b).select(F.greatest(a, b).alias("a"), F.least(a, b).alias("b"))
    now, seen = stored(start.distinct(), "edges"), None
    while True:
        mark = now.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if mark == seen or mark[0] == 0:
            break
        seen = mark
        now = stored(_small_star(_large_star(now)), "edges")
    nodes = now.select(F.col("a").alias("node"), F.col("b").alias("component"))
    return nodes.unionByName(now.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct())


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("m"))
    hung = both.filter("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return hung.distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    least = edges.groupBy("a").agg(F.min("b").alias("m"))
    hung = edges.join(least, "a").filter("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return hung.unionByName(least.select("a", F.col("m").alias("b"))).distinct()
