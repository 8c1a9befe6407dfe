"""Connected components of a link table, by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortspark.llm.common import Scratch

MAX_ROUNDS = 60


def components(links: DataFrame, scratch: Scratch) -> DataFrame:
    """``node`` and ``root`` (the smallest node it reaches) for every node in ``links`` (a, b).

    Each round hangs nodes onto smaller neighbours; the table of links never grows beyond twice its size and is stored
    every round, so a lost executor costs one round.  Rounds grow with the logarithm of the longest chain.
    """
    edges = scratch.table(links.filter("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct())
    state = _state(edges)
    for _ in range(MAX_ROUNDS):
        if not state[0]:
            break
        edges = scratch.table(_small_star(_large_star(edges)))
        now = _state(edges)
        if now == state:
            break
        state = now
    else:
        raise RuntimeError("components did not settle")
    least = edges.groupBy(F.col("u").alias("node")).agg(F.min("v").alias("root"))
    roots = edges.select(F.col("v").alias("node")).distinct().join(least.select("node"), "node", "left_anti")
    return least.unionByName(roots.select("node", F.col("node").alias("root")))


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count(F.lit(1)), F.expr("bit_xor(xxhash64(u, v))")).first())


def _large_star(edges: DataFrame) -> DataFrame:
    """Every larger neighbour of a node is linked to the node's smallest neighbour (or itself)."""
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    return both.filter("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """Every smaller neighbour of a node, and the node, are linked to its smallest one."""
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    down = edges.join(least, "u").filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return down.unionByName(least.select("u", F.col("m").alias("v"))).distinct()
