"""Connected components of a link table by alternating star contractions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from contrail.llm.common import BROADCAST_BYTES, stored


def components(links: DataFrame, a: str, b: str, most: int | None = None) -> DataFrame:
    """One row per linked node: ``node`` and ``root``, the smallest node it reaches.

    Each round hangs every node's larger neighbours under its smallest neighbour
    (large star), then its smaller ones (small star), until the links form stars.
    The smallest neighbour is an aggregate that combines map-side, and rows go to
    it by a join, so no node's neighbours ever meet in one task.  Links that are
    null or join a node to itself are ignored.  There are no more than ``most`` links,
    where that is known; no round makes more of them.
    """
    edges = links.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")) \
        .where(F.col(a).isNotNull() & F.col(b).isNotNull() & (F.col("u") != F.col("v"))).distinct()
    edges = stored(edges, most)
    count = edges.count()
    # two nodes a link at most, two longs each: a proven size allows the broadcast
    held = F.broadcast if 32 * count <= BROADCAST_BYTES else lambda nodes: nodes
    while True:
        both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        large = both.where(F.col("v") > F.col("u")).join(held(least), "u") \
            .select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(held(least), "u")
        small = small.select(F.col("v").alias("u"), F.col("m").alias("v")) \
            .where("u != v").union(least.select("u", F.col("m").alias("v"))).distinct()
        edges = stored(small, count)
        # stars: nobody who hangs under a node has a node hanging under itself
        deep = edges.select("v").distinct().join(edges.select(F.col("u").alias("v")).distinct(), "v", "left_semi")
        twice = edges.groupBy("u").agg(F.count("*").alias("n")).where("n > 1")
        if not deep.limit(1).count() and not twice.limit(1).count():
            break
    roots = edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
    return stored(roots.union(edges.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()),
                  2 * count)
