"""Connected components of a link table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marquee.session import materialize


def _with_smallest(links: DataFrame) -> DataFrame:
    """Links (u, v) with the smallest of u and all its v as ``m``. Reduced before it moves, so a node with very
    many links is a row per task; the join back can be split."""
    smallest = links.groupBy("u").agg(F.min("v").alias("low")).select("u", F.least("u", "low").alias("m"))
    return links.join(smallest, "u")


def _large_star(links: DataFrame) -> DataFrame:
    both = links.unionByName(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
    return _with_smallest(both).filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()


def _small_star(links: DataFrame) -> DataFrame:
    marked = _with_smallest(links)
    again = marked.filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return again.unionByName(marked.select("u", F.col("m").alias("v"))).distinct()


def components(links: DataFrame) -> DataFrame:
    """(node, root) of every node with a link; the root is the smallest node of its component.

    Alternating large and small stars: every round hangs nodes to the smallest node they know of, until each hangs
    directly on its root. The number of rounds grows with the logarithm of a component's size, chains included.
    Every round is a written table. ``links`` has (u, v), in any direction and with repeats.
    """
    ordered = links.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).filter("u <> v").distinct()
    stars = materialize(ordered, "links")
    mark = None
    while True:
        found = stars.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v"))).first()
        if tuple(found) == mark or not found[0]:
            break
        mark = tuple(found)
        stars = materialize(_small_star(_large_star(stars)), "stars")
    hung = stars.select(F.col("u").alias("node"), F.col("v").alias("root"))
    return hung.unionByName(hung.select(F.col("root").alias("node"), "root").distinct())
