"""Connected components over link tables, wholly in DataFrames."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import forget, written


def _round(links: DataFrame) -> DataFrame:
    """One large-star and one small-star step: every node's links move towards the smallest node known to it."""
    both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("m")).withColumn("m", F.least("a", "m"))
    large = both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
    low = large.groupBy("a").agg(F.min("b").alias("m"))
    moved = large.join(low, "a")
    small = moved.where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b")).unionByName(low.select("a", F.col("m").alias("b")))
    return small.distinct()


def _state(links: DataFrame) -> tuple:
    return tuple(links.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())


def components(links: DataFrame, most_rounds: int = 60) -> DataFrame:
    """(a, b): undirected links of sortable ids. Returns (node, component) for every node that has a link to another;
    component is the smallest node that it reaches.

    Alternating large-star and small-star steps; the number of rounds grows with the logarithm of the diameter.
    Every round is written to the shared folder. Only a count and a checksum reach the driver.
    Null ends and links of a node to itself are left out. An empty table gives an empty table.
    """
    now = written(links.where("a is not null and b is not null and a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "links")
    before = _state(now)
    for _ in range(most_rounds):
        if not before[0]:
            break
        after = written(_round(now), "links")
        forget(now)
        now, state = after, _state(after)
        if state == before:
            break
        before = state
    else:
        raise RuntimeError(f"components did not settle in {most_rounds} rounds")
    return now.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(now.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct())
