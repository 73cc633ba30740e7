"""Connected components of a link table, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from partyard.session import settle


def components(links: DataFrame, most_rounds: int = 60) -> DataFrame:
    """``node`` and ``component`` (its smallest node) of every node in a link.

    ``links`` has two long columns ``a`` and ``b``.  Each round hooks every node to the
    smallest node it can see, so path lengths shrink by a factor and a few rounds do;
    a round is two aggregations and two joins, none of which gathers a node's links.
    """
    edges = settle(
        links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).filter("a <> b").distinct()
    )
    before = None
    for _ in range(most_rounds):
        edges = settle(_small_star(_large_star(edges)))
        state = edges.agg(F.count("*").alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("s")).first()
        if state == before:
            break
        before = state
    else:
        raise RuntimeError("components did not settle")
    roots = edges.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    return edges.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(roots)


def _large_star(edges: DataFrame) -> DataFrame:
    """Every larger neighbour of a node moves to the node's smallest neighbour."""
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy(F.col("a").alias("u")).agg(F.least(F.min("b"), F.first("a")).alias("m"))
    moved = both.join(least, F.col("a") == F.col("u")).filter("b > a")
    return moved.select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """A node and its smaller neighbours move to the smallest of them."""
    least = edges.groupBy(F.col("a").alias("u")).agg(F.min("b").alias("m"))
    moved = edges.join(least, F.col("a") == F.col("u")).filter("b <> m")
    return (
        moved.select(F.col("b").alias("a"), F.col("m").alias("b"))
        .unionByName(least.select(F.col("u").alias("a"), F.col("m").alias("b")))
        .distinct()
    )
