"""Connected components of a table of edges, by alternating stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marlstone.llm.common import staged


def _both_ways(edges: DataFrame) -> DataFrame:
    return edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))


def _large_star(edges: DataFrame) -> DataFrame:
    """Each larger neighbour of a node is linked to the node's least one."""
    both = _both_ways(edges)
    least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
    return (both.join(least, "a").where(F.col("b") > F.col("a"))
            .select(F.col("b").alias("a"), F.col("m").alias("b")).distinct())


def _small_star(edges: DataFrame) -> DataFrame:
    """A node's smaller neighbours and itself are linked to the least of them."""
    down = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = down.groupBy("a").agg(F.min("b").alias("m"))
    return (down.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
            .where(F.col("a") != F.col("b"))
            .unionByName(least.select("a", F.col("m").alias("b"))).distinct())


def components(edges: DataFrame) -> DataFrame:
    """node, component: the least node linked with it, for every node of
    ``edges`` (a, b) but the least ones themselves. NULLs and loops are left
    out. Each round is written; rounds grow with the logarithm of the longest
    path. A node with many links is aggregated before it is shuffled and its
    join is one of a table with one row for each node."""
    now = staged(edges.select("a", "b").where(F.col("a") != F.col("b"))
                 .select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges")
    state = None
    while True:
        mark = now.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("a", "b"))).first()
        if tuple(mark) == state or mark[0] == 0:
            break
        state = tuple(mark)
        now = staged(_small_star(_large_star(now)), "stars")
    return now.select(F.col("a").alias("node"), F.col("b").alias("component"))
