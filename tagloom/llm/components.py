"""Connected components by alternating stars, on edges only."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tagloom.llm.store import removed, stored


def _large_star(edges: DataFrame) -> DataFrame:
    """Each larger neighbour of a node goes to the node's least neighbour."""
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
    return both.join(least, "a").filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """Each smaller neighbour of a node, and the node, go to the least of them."""
    least = edges.groupBy("a").agg(F.min("b").alias("m"))
    near = edges.join(least, "a").filter("b > m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return near.unionByName(least.select("a", F.col("m").alias("b"))).distinct()


def components(edges: DataFrame) -> DataFrame:
    """(id, root) of every node of ``edges`` (a, b: long): ``root`` is the least id
    that is connected to it. Each round is written to the shared folder; rounds
    grow with the logarithm of the largest component's width."""
    now = stored(
        edges.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges"
    )
    told = None
    while True:
        sums = now.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("a", "b"))).first()
        if tuple(sums) == told:
            break
        told = tuple(sums)
        after = stored(_small_star(_large_star(now)), "edges")
        removed(now)
        now = after
    roots = now.select(F.col("b").alias("id"), F.col("b").alias("root")).distinct()
    return now.select(F.col("a").alias("id"), F.col("b").alias("root")).unionByName(roots)
