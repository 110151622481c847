"""Connected components of a link table, by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialize


def _step(links: DataFrame, large: bool) -> DataFrame:
    """Large: tie each larger neighbour of a node to the node's smallest; small: the same with smaller ones."""
    if large:
        rows = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))  # a: node, b: neighbour
    else:
        rows = links.select(F.col("b").alias("a"), F.col("a").alias("b"))
    least = rows.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
    tied = rows.join(least, "a")
    tied = tied.where("b > a").select(F.col("m").alias("a"), "b") if large else tied.select(F.col("m").alias("a"), "b").unionByName(least.select(F.col("m").alias("a"), F.col("a").alias("b")))
    return tied.where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()


def components(links: DataFrame) -> DataFrame:
    """``links`` (a, b) -> (node, root): the smallest node reachable, for each node that has a link to another.

    Every round is a written table, so the plan stays short and lost executors repeat one round at
    most.  A hub's rows are joined with one row, which adaptive skew handling can split.  The rounds end when one
    leaves every link as it was.
    """
    now = materialize(links.where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "links")
    size = now.count()
    while size:
        before, before_size = now, size
        now = materialize(_step(_step(before, True), False), "links")
        size = now.count()
        # links are distinct, so two tables of one size are equal if neither has a link that the other lacks
        if size == before_size and now.join(before, ["a", "b"], "left_anti").isEmpty():
            break
    return now.select(F.col("b").alias("node"), F.col("a").alias("root")).unionByName(now.select(F.col("a").alias("node"), F.col("a").alias("root")).distinct())
