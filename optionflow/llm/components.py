"""Connected components of a graph given by its links, by alternating star contraction.

A large-star step links every node's larger neighbours to its smallest neighbour, a
small-star step its smaller ones; in a few rounds every component is a star around its smallest
node (Kiveris et al., "Connected components in MapReduce and beyond", 2014). Smallest
neighbours come from map-side aggregates, and hubs only meet their neighbours in joins,
which adaptive execution can split.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from .store import drop, kept


def checksum(links: DataFrame) -> tuple[int, int]:
    """Row count and a sum over row hashes."""
    row = links.agg(F.count("*").alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(20,0)")).alias("sum")).first()
    return row["n"], int(row["sum"] or 0)


def large_star(links: DataFrame) -> DataFrame:
    both = links.select("u", "v").unionByName(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy(F.col("u").alias("hub")).agg(F.min("v").alias("least"))
    met = both.filter("v > u").join(least, F.col("u") == F.col("hub"))
    return met.select(F.col("v").alias("u"), F.least("hub", "least").alias("v")).distinct()


def small_star(links: DataFrame) -> DataFrame:
    least = links.groupBy(F.col("u").alias("hub")).agg(F.min("v").alias("least"))
    met = links.join(least, F.col("u") == F.col("hub")).filter("v <> least")
    moved = met.select(F.col("v").alias("u"), F.col("least").alias("v"))
    return moved.unionByName(least.select(F.col("hub").alias("u"), F.col("least").alias("v"))).distinct()


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, root): every linked node and the smallest node of its component.

    Nodes are whole numbers; links from a node to itself and null ends say nothing. Without links there are no rows.
    """
    u, v = F.greatest(a, b), F.least(a, b)
    now = kept(links.filter((F.col(a) != F.col(b))).select(u.alias("u"), v.alias("v")).distinct())
    before = checksum(now)
    while before[0]:
        after = kept(small_star(large_star(now)))
        drop(now.sparkSession, now)
        now, sum_now = after, checksum(after)
        if sum_now == before:
            break
        before = sum_now
    stars = now.select(F.col("u").alias("node"), F.col("v").alias("root"))
    return stars.unionByName(stars.select(F.col("root").alias("node"), "root").distinct())
