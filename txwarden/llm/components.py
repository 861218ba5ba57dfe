"""Connected components by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from txwarden.llm.store import written


def both_ways(edges: DataFrame) -> DataFrame:
    return edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))


def large_star(edges: DataFrame) -> DataFrame:
    """Each node ties its larger neighbours to the smallest node it sees. Hot nodes are pre-aggregated, then joined."""
    near = both_ways(edges)
    least = near.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
    return near.filter("b > a").join(least.hint("merge"), "a").select(F.col("b").alias("a"), F.col("m").alias("b")).filter("a <> b").distinct()


def small_star(edges: DataFrame) -> DataFrame:
    """Each node ties itself and its smaller neighbours to the smallest of them; edges come as (larger, smaller)."""
    least = edges.groupBy("a").agg(F.min("b").alias("m"))
    moved = edges.join(least.hint("merge"), "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return moved.union(least.select("a", F.col("m").alias("b"))).filter("a <> b").distinct()


def settled(edges: DataFrame) -> bool:
    """Whether edges (larger, smaller) are stars around the smallest nodes: a node has one edge to a smaller one, or is a centre."""
    ends = edges.select(F.col("a").alias("node"), F.lit(1).alias("up")).union(edges.select(F.col("b").alias("node"), F.lit(0).alias("up")))
    found = ends.groupBy("node").agg(F.sum("up").alias("up"), F.min("up").alias("least"))
    return found.filter("up > 1 or (up = 1 and least = 0)").isEmpty()


def components(links: DataFrame) -> DataFrame:
    """Node `a` and the smallest node `b` reachable from it, for every node that has a link and is not that smallest node.

    `links` has two columns of ids, in any order; loops, nulls and repeats are ignored. Every round is written to the
    shared folder, and the rounds end when each node is tied to the smallest one alone. Rounds join by merging: no nodes
    go through the driver.
    """
    first, second = links.columns[:2]
    edges = links.select(F.greatest(first, second).alias("a"), F.least(first, second).alias("b")).filter("a <> b")
    edges = written(edges.filter(F.col("b").isNotNull()).distinct(), "edges")
    while not settled(edges):
        edges = written(small_star(large_star(edges)), "edges")
    return edges
