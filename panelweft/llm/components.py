"""Connected components of a distributed edge list."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelweft.scale import materialise


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """One round: every node tells its larger neighbours (or its smaller ones
    and itself) the least node that it knows of."""
    if large:
        known = edges.select("a", "b").union(edges.select(F.col("b"), F.col("a"))).toDF("u", "v")
    else:
        known = edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
    least = known.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    told = known.join(least, "u")
    if large:
        return told.where("v > u").select(F.col("v").alias("a"), F.col("m").alias("b"))
    return told.where("v <> m").select(F.col("v").alias("a"), F.col("m").alias("b")).union(
        least.where("u <> m").toDF("a", "b")
    )


def components(edges: DataFrame) -> DataFrame:
    """(a, b) with a <> b, whole numbers -> (node, component): for every node
    of an edge the least node of its component.

    Large and small stars in turn; the number of rounds grows with the
    logarithm of the nodes, each round is a grouping and a join, and its edges
    are written to the shared folder. Nothing but two sums comes to the driver.
    """

    def state(df: DataFrame):
        row = df.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        return tuple(row)

    now = materialise(edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges")
    before, here = None, state(now)
    while before != here:
        spread = materialise(_star(now, large=True).distinct(), "large-star")
        now = materialise(_star(spread, large=False).distinct(), "small-star")
        before, here = here, state(now)
    own = now.select(F.col("b").alias("node")).distinct().select("node", F.col("node").alias("component"))
    return now.select(F.col("a").alias("node"), F.col("b").alias("component")).union(own)
