"""Connected components of an edge list, by alternating star contractions.

A large-star step links every larger neighbour of a node to its smallest neighbour, a small-star
step does so for the smaller ones. Both keep components as they are; repeated, they leave each node
linked to the smallest of its component. Every step is written to the shared folder.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tripmill.llm.common import staged


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("lo").alias("hi"), F.col("hi").alias("lo")))
    low = staged(both.groupBy("hi").agg(F.min("lo").alias("m")), "low")
    low = low.select(F.col("hi").alias("node"), F.least("hi", "m").alias("m"))
    return (edges.join(low, edges["lo"] == low["node"])
            .select("hi", F.col("m").alias("lo")))


def _small_star(edges: DataFrame) -> DataFrame:
    low = staged(edges.groupBy("hi").agg(F.min("lo").alias("m")), "low")
    joined = edges.join(low.withColumnRenamed("hi", "node"), F.col("hi") == F.col("node"))
    moved = joined.where(F.col("lo") != F.col("m")).select(
        F.col("lo").alias("hi"), F.col("m").alias("lo"))
    return moved.unionByName(low.select("hi", F.col("m").alias("lo")))


def components(edges: DataFrame) -> DataFrame:
    """``node`` and ``root`` for every node of ``edges`` (two columns ``a`` and ``b``) but roots.

    The root is the smallest node that can be reached.
    """
    edges = edges.where(F.col("a") != F.col("b")).select(
        F.greatest("a", "b").alias("hi"), F.least("a", "b").alias("lo")).distinct()
    before = None
    while True:
        edges = staged(edges, "edges")
        now = tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("hi", "lo").cast("decimal(38,0)"))
                              ).first())
        if now == before or now[0] == 0:
            return edges.select(F.col("hi").alias("node"), F.col("lo").alias("root"))
        before = now
        edges = staged(_large_star(edges).distinct(), "stars")
        edges = _small_star(edges).distinct()
