"""Connected components of an edge table."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from clickloom.session import materialize


def _starred(edges: DataFrame, upward: bool) -> DataFrame:
    """Tie the neighbours of every node to the smallest node around it: those above it, or those below it."""
    both = edges if not upward else edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy(F.col("a").alias("node")).agg(F.least(F.min("b"), F.min("a")).alias("least"))
    tied = both.join(least, both["a"] == least["node"])
    if upward:
        return tied.where("b > a").select(F.col("b").alias("a"), F.col("least").alias("b"))
    down = tied.select(F.col("b").alias("a"), F.col("least").alias("b"))
    return down.unionByName(least.select(F.col("node").alias("a"), F.col("least").alias("b"))).where("a > b")


def _all_stars(edges: DataFrame) -> bool:
    """Whether every node has one smaller neighbour or only larger ones; each component is a star then."""
    ends = edges.select(F.col("a").alias("node"), F.lit(1).alias("up"), F.lit(0).alias("down")).unionByName(
        edges.select(F.col("b").alias("node"), F.lit(0).alias("up"), F.lit(1).alias("down"))
    )
    nodes = ends.groupBy("node").agg(F.sum("up").alias("up"), F.max("down").alias("down"))
    return nodes.where(F.col("up") + F.col("down") > 1).count() == 0


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of ``edges`` (a, b) but the roots; a root is the smallest node it reaches.

    Alternating large-star and small-star rounds over shuffled tables; node minima are combined before they
    are shuffled, so a hub of any degree is no obstacle. Rounds grow with the logarithm of a chain's length.
    """
    now = materialize(
        edges.where("a != b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(),
        "edges",
    )
    while not _all_stars(now):
        grown = materialize(_starred(now, upward=True).distinct(), "large-star")
        now = materialize(_starred(grown, upward=False).distinct(), "small-star")
    return now.select(F.col("a").alias("node"), F.col("b").alias("root"))
