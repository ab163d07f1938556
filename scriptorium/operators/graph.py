"""Iterative graph operators: components and breadth-first levels, cut by checkpoint() in the shared folder."""

from __future__ import annotations

import tempfile

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def checkpointed(df: DataFrame) -> DataFrame:
    """checkpoint() in the folder of spark.checkpoint.dir; where that is unset, one of our own, which must be local mode's."""
    spark = df.sparkSession
    if not spark.conf.get("spark.checkpoint.dir", None) and not spark.sparkContext.getCheckpointDir():
        if not spark.sparkContext.master.startswith("local["):
            raise RuntimeError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="scriptorium-"))
    return df.checkpoint()


def components(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """nodes(id), edges(src, dst) -> (id, component): the smallest id reachable.

    Stars are contracted in turn (large-star and small-star steps): every step is one grouped minimum, combined before
    the shuffle, and one equi-join, and the number of steps grows with the logarithm of the longest path.
    """

    def oriented(pairs: DataFrame) -> DataFrame:
        return pairs.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).filter("u > v").distinct()

    def fingerprint(pairs: DataFrame) -> tuple:
        return tuple(pairs.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v"))).first())

    stars = checkpointed(oriented(edges.select(F.col("src").alias("a"), F.col("dst").alias("b"))))
    seen = fingerprint(stars)
    while seen[0]:
        both = stars.select("u", "v").union(stars.select("v", "u"))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = checkpointed(oriented(both.join(least, "u").filter("v > u").select(F.col("v").alias("a"), F.col("m").alias("b"))))
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").select(F.col("v").alias("a"), F.col("m").alias("b")).union(least.select("u", "m"))
        stars = checkpointed(oriented(small))
        now = fingerprint(stars)
        if now == seen:
            break
        seen = now
    return nodes.join(stars.select(F.col("u").alias("id"), F.col("v").alias("component")), "id", "left").select("id", F.coalesce("component", "id").alias("component"))


def breadth_first(seeds: DataFrame, edges: DataFrame, max_depth: int) -> DataFrame:
    """seeds(id), edges(src, dst, place) -> (id, depth, parent): least depth, parent the first discoverer of the level before."""
    found = checkpointed(seeds.select("id", F.lit(0).alias("depth"), F.lit(None).cast(seeds.schema["id"].dataType).alias("parent")).distinct())
    frontier = found
    for depth in range(1, max_depth + 1):
        reached = frontier.join(edges, frontier.id == edges.src).groupBy(F.col("dst").alias("id")).agg(F.min(F.struct("src", "place")).alias("first"))
        frontier = checkpointed(reached.join(found, "id", "left_anti").select("id", F.lit(depth).alias("depth"), F.col("first.src").alias("parent")))
        if not frontier.limit(1).count():
            break
        found = checkpointed(found.unionByName(frontier))
    return found
