"""Connected components of an undirected edge table, as Spark jobs."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tiers.llm.frame import written


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.expr("bit_xor(xxhash64(u, v))")).first())


def _large_star(edges: DataFrame) -> DataFrame:
    """Every larger neighbour of a node is linked to the smallest node around it."""
    both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    # written, so that the join below reads both sides straight from a shuffle
    # and a node with very many neighbours is split between tasks at run time
    low = written(both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m")), "star")
    return (both.filter("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
            .filter("u <> v").distinct())


def _small_star(edges: DataFrame) -> DataFrame:
    """A node and its smaller neighbours are linked to the smallest of them."""
    low = written(edges.groupBy("u").agg(F.min("v").alias("m")), "star")
    return (edges.join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u <> v")
            .union(low.select("u", F.col("m").alias("v"))).distinct())


def components(edges: DataFrame) -> DataFrame:
    """``u, root`` for every node of ``edges`` (columns u, v: longs), root being the
    component's smallest node, which is its own root.

    Alternating large-star and small-star steps: each takes two aggregations
    combined map-side and one join, the number of rounds grows with the logarithm
    of the component's size, and no component is ever gathered in one place. Every
    round is a written table, so a lost executor costs one round at most.
    """
    edges = written(edges.filter("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
                    .distinct(), "edges")
    state = _state(edges)
    while state[0]:
        edges = written(_small_star(written(_large_star(edges), "edges")), "edges")
        before, state = state, _state(edges)
        if state == before:
            break
    return edges.select("u", F.col("v").alias("root")).union(edges.select("v", "v").distinct())
