"""Connected components by alternating large-star and small-star joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialise


def state(edges: DataFrame) -> tuple[int, int]:
    """Number of edges and a sum of hashes that changes with any edge."""
    row = edges.agg(F.count("*").alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("h")).first()
    return row["n"], int(row["h"] or 0)


def large_star(edges: DataFrame) -> DataFrame:
    """Link each node's larger neighbours to the smallest node in its neighbourhood."""
    both = edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = materialise(both.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("k"), F.least("a", "m").alias("m")), "least")
    return both.join(least, F.col("a") == F.col("k")).where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))


def small_star(edges: DataFrame) -> DataFrame:
    """Link each node and its smaller neighbours to the smallest of them."""
    down = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = materialise(down.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("k"), "m"), "least")
    pairs = down.join(least, F.col("a") == F.col("k"))
    return (pairs.where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
            .union(least.select(F.col("k").alias("a"), F.col("m").alias("b"))).distinct())


def components(edges: DataFrame) -> DataFrame:
    """(node, component): each node of ``edges`` (a, b) with the smallest node that it reaches.

    Each round is written to the shared folder, which cuts the lineage; so are
    the minima, as a join that shared their aggregation's exchange couldn't be split. The
    rounds end when a round changes nothing (about the logarithm of the
    longest path); a node with very many neighbours is one key of joins whose
    large partitions AQE splits, and its minimum is aggregated before the shuffle.
    """
    edges = materialise(edges.where("a <> b").distinct(), "edges")
    before = None
    while (now := state(edges)) != before and now[0]:
        before = now
        edges = materialise(small_star(large_star(edges).distinct()), "edges")
    return (edges.select(F.col("a").alias("node"), F.col("b").alias("component"))
            .union(edges.select(F.col("b").alias("node"), F.col("b").alias("component"))).distinct())
