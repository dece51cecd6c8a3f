"""Connected components of a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lendscope.llm.tables import release, written, written_counting

MOST_ROUNDS = 60


def _toward_minimum(edges: DataFrame) -> DataFrame:
    """(u, v) to (u, v, m) with m the smallest of u and all its v. Minima combine per task first."""
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    least = least.select(F.col("u").alias("at"), F.least("u", "m").alias("m"))
    return edges.join(least, F.col("u") == F.col("at")).drop("at")


def _is_forest_of_stars(edges: DataFrame) -> bool:
    """Whether every u has one v, and no v is a u: then v is the least of its component."""
    nodes = edges.select(F.col("u").alias("node"), F.lit(1).alias("below"), F.lit(0).alias("above")).union(
        edges.select(F.col("v"), F.lit(0), F.lit(1)))
    wrong = nodes.groupBy("node").agg(F.sum("below").alias("below"), F.max("above").alias("above"))
    return wrong.where("below > 1 OR below = 1 AND above = 1").isEmpty()


def connected_components(links: DataFrame) -> DataFrame:
    """(node, component): every node of the links with the smallest node it can reach.

    ``links`` has (x, y). Alternates two steps: each node points its larger neighbours to the least
    of its neighbourhood, then its smaller ones and itself. The number of rounds grows with the
    logarithm of the longest path; links never multiply. Every round is written to the shared folder; it is the last if
    its links are stars, which one aggregation tells.
    """
    edges, left = written_counting(links.where("x <> y").select(
        F.greatest("x", "y").alias("u"), F.least("x", "y").alias("v")).distinct(), F.lit(True))
    rounds = 0
    while left and not _is_forest_of_stars(edges):
        rounds += 1
        release(links.sparkSession)
        if rounds > MOST_ROUNDS:
            raise RuntimeError("components did not settle")
        both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = _toward_minimum(both).where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        small = _toward_minimum(large)
        edges = written(small.select(F.col("v").alias("u"), F.col("m").alias("v"))
                        .union(small.select("u", F.col("m").alias("v"))).where("u <> v").distinct())
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).union(
        edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())
