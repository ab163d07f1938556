"""Connected components of an edge table by alternating star contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut, release


def _oriented(edges: DataFrame) -> DataFrame:
    return edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).filter("u > v").distinct()


def _fingerprint(edges: DataFrame) -> tuple:
    row = edges.agg(F.count("*").alias("n"), F.bit_xor(F.xxhash64("u", "v")).alias("x")).first()
    return row["n"], row["x"]


def connected_components(edges: DataFrame) -> DataFrame:
    """edges(a long, b long) -> (node, root) for every node with an edge; root is the smallest node it reaches.

    Large-star and small-star steps (Kiveris et al. 2014): each is one grouped minimum, combined map-side, and one
    equi-join, so a node with very many neighbours is never gathered in one row; AQE may split its join partition.
    Every step is written to the shared folder. Self loops and repeated edges are ignored; an empty table gives an
    empty result.
    """
    stars = cut(_oriented(edges), "edges")
    seen = _fingerprint(stars)
    while seen[0]:
        both = stars.select("u", "v").unionAll(stars.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.join(least, "u").filter("v > u").select(F.col("v").alias("a"), F.col("m").alias("b"))
        large = cut(_oriented(large), "large")
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").select(F.col("v").alias("a"), F.col("m").alias("b"))
        small = small.unionAll(least.select(F.col("u").alias("a"), F.col("m").alias("b")))
        before, stars = stars, cut(_oriented(small), "small")
        release(before, large)
        now = _fingerprint(stars)
        if now == seen:
            break
        seen = now
    return stars.select(F.col("u").alias("node"), F.col("v").alias("root")).unionAll(stars.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
