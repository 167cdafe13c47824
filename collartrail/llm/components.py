"""Connected components by alternating large and small stars, each round one written table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from collartrail.session import stage


def _min_neighbour(edges: DataFrame) -> DataFrame:
    """``u, v, m``: the edges and the least of ``u`` and all its neighbours in them."""
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    return edges.join(least, "u").select("u", "v", F.least("u", "m").alias("m"))


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.select("u", "v").unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    found = _min_neighbour(both).filter(F.col("v") > F.col("u"))
    return found.select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """Edges come with u > v, so the neighbours of ``u`` here are the lesser ones."""
    found = _min_neighbour(edges)
    moved = found.filter(F.col("v") != F.col("m")).select(F.col("v").alias("u"), F.col("m").alias("v"))
    own = found.select("u", F.col("m").alias("v"))
    return moved.unionByName(own).distinct()


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``node, component``: the least node reachable, for every node that has a link to another.

    Each round is written and read again, so a lost executor costs at most one round. The edges in
    the end are stars around the least nodes; the number of rounds grows with the logarithm of the
    longest path.
    """
    edges = links.filter(F.col(a) != F.col(b)).select(
        F.greatest(a, b).alias("u"), F.least(a, b).alias("v")
    )
    edges = stage(edges.distinct(), "edges")
    seen = None
    while True:
        state = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if state == seen or not state[0]:
            return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(
                edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
            )
        seen = state
        edges = stage(_small_star(_large_star(edges)), "edges")
