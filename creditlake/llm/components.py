"""Connected components of links, by alternating stars.

Every step hangs each node's larger neighbours, then all its neighbours, on the
smallest one it knows. Both are a minimum per node, combined before the
shuffle, and a join on the node; a node with very many links is split by the
skew handling of that join. The links of every step are written, so a lost
executor repeats one step at most. The number of steps grows with the
logarithm of the longest chain.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from creditlake.staging import stage


def components(links: DataFrame) -> DataFrame:
    """``node`` and ``root``, the smallest node it is connected to, for nodes of ``links`` (``a``, ``b``).

    Links of a node to itself, repeated links and both directions are fine; no
    links give no rows. Ids are numbers without nulls.
    """
    edges = stage(links.filter("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct())
    state = _state(edges)
    while True:
        edges = stage(_small_star(_large_star(edges)))
        new = _state(edges)
        if new == state:
            break
        state = new
    roots = edges.select(F.col("v").alias("node")).distinct()
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root")).union(
        roots.select("node", F.col("node").alias("root"))
    )


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.select("u", "v").union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    moved = both.filter("v > u").join(least, "u")
    return moved.select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u <> v").distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    moved = edges.join(least, "u").filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.union(least.select("u", F.col("m").alias("v"))).distinct()
