"""Connected components of an edge table by alternating large-star and small-star rounds."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfcast.llm import common as C


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """One round; a hub's minimum is a partial aggregate and a join, its neighbours are never gathered."""
    both = edges.select("u", "v").unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    near = both if large else both.where(F.col("v") < F.col("u"))
    low = near.groupBy(F.col("u").alias("c")).agg(F.min("v").alias("m")).withColumn("m", F.least("c", "m"))
    joined = near.join(low, F.col("u") == F.col("c"))
    moved = joined.where(F.col("v") > F.col("u")) if large else joined
    out = moved.select(F.col("v").alias("u"), F.col("m").alias("v"))
    if not large:
        out = out.unionByName(low.select(F.col("c").alias("u"), F.col("m").alias("v")))
    return out.where(F.col("u") != F.col("v")).distinct()


def _mark(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())


def connected(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of ``edges`` (u, v longs); the root is the component's smallest node.

    Each double round is written to the shared folder, which cuts lineage.
    Rounds grow with the logarithm of the longest chain; only two numbers a
    round reach the driver.
    """
    now = C.persisted(edges.where(F.col("u") != F.col("v")).select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "cc")
    mark = _mark(now)
    while mark[0]:
        after = C.persisted(_star(_star(now, large=True), large=False), "cc")
        new = _mark(after)
        now, same, mark = after, new == mark, new
        if same:
            break
    return now.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(
        now.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
