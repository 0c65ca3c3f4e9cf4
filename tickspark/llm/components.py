"""Connected components of an edge table by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickspark.llm.common import written


def _is_star_forest(edges: DataFrame) -> bool:
    """Whether every node is a leaf of one centre, or a centre."""
    ends = edges.select(F.col("a").alias("v"), F.lit(1).alias("leaf")).union(edges.select("b", F.lit(0)))
    bad = ends.groupBy("v").agg(F.sum("leaf").alias("leaf"), F.min("leaf").alias("centre"))
    return not bad.where((F.col("leaf") > 1) | ((F.col("leaf") == 1) & (F.col("centre") == 0))).limit(1).count()


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of ``edges`` (a, b); ``root`` is the smallest node of its component.

    Each step replaces neighbours by the smallest neighbour; a component of
    any shape becomes a star in a logarithmic number of steps.  Minima are
    pre-aggregated, so a hub costs its partitions' partial minima only.
    """
    star = written(edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
                   .where("a <> b").distinct(), "cc-edges")
    while not _is_star_forest(star):
        both = star.union(star.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = written(both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("m")), "cc-min")
        large = (both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
                 .where("a <> b").distinct())
        large = written(large, "cc-large")
        low = written(large.groupBy("a").agg(F.min("b").alias("m")), "cc-low")
        small = (large.join(low, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
                 .union(low.select("a", F.col("m").alias("b"))).where("a <> b").distinct())
        star = written(small, "cc-small")
    return star.select(F.col("a").alias("node"), F.col("b").alias("root")).union(
        star.select(F.col("b"), F.col("b")).distinct())
