"""Connected components of a link table by alternating stars; every round is written to the shared folder."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ventaria.session import settle


def both_ways(links: DataFrame) -> DataFrame:
    return links.union(links.select("b", "a"))


def large_star(links: DataFrame) -> DataFrame:
    """Point every larger neighbour of a node at the node's smallest neighbour."""
    around = both_ways(links)
    least = around.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
    return around.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))


def small_star(links: DataFrame) -> DataFrame:
    """Point every smaller neighbour of a node, and the node, at the smallest one."""
    down = links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a <> b").distinct()
    least = down.groupBy("a").agg(F.min("b").alias("m"))
    return down.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).union(least.select("a", F.col("m").alias("b")))


def tidy(links: DataFrame) -> DataFrame:
    return links.where("a <> b").distinct()


def components(links: DataFrame) -> DataFrame:
    """(node, component) for every node that has a link; the component is its smallest node.

    Groups are reduced to their minimum before they move, so a node with any
    number of neighbours costs one row per task.
    """
    now = settle(tidy(links.select(F.col("a").cast("long"), F.col("b").cast("long"))))
    before = None
    while True:  # every round but the last joins stars; about the square of the logarithm of a group's size
        now = settle(tidy(small_star(tidy(large_star(now)))))
        size = now.agg(F.count("*").alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("h")).first()
        if size == before:
            return now.select(F.col("a").alias("node"), F.col("b").alias("component")).union(
                now.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct())
        before = size
