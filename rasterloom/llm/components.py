"""Connected components of a distributed edge list, by alternating large and small stars.

Each round is two joins and aggregations and is written to the shared folder; the number
of rounds grows with the logarithm of the longest path. Nothing but one emptiness test a
round reaches the driver. A hot node's minimum is pre-aggregated and written, so that the
join that brings it back stands alone above two exchanges and Spark can split a hot partition.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._common import discard, materialise


def _large_star(edges: DataFrame, made: list[DataFrame]) -> DataFrame:
    both = edges.select(F.col("u").alias("x"), F.col("v").alias("y")).union(edges.select("v", "u"))
    least = materialise(both.groupBy("x").agg(F.min("y").alias("m")).select("x", F.least("x", "m").alias("m")), "least")
    made.append(least)
    return both.join(least, "x").where(F.col("y") > F.col("x")).select(F.col("y").alias("u"), F.col("m").alias("v")).distinct()


def _small_star(edges: DataFrame, made: list[DataFrame]) -> DataFrame:
    least = materialise(edges.groupBy("u").agg(F.min("v").alias("m")), "least")
    made.append(least)
    moved = edges.join(least, "u").where(F.col("v") != F.col("m")).select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.union(least.select("u", F.col("m").alias("v"))).distinct()


def connected_components(edges: DataFrame) -> DataFrame:
    """(u, v) for each node u that isn't the least of its component v; edges: (u, v) with u > v.

    An empty edge list gives an empty result; repeated edges don't matter.
    """
    current = materialise(edges.select("u", "v").where(F.col("u") > F.col("v")).distinct(), "edges")
    while True:
        inner = current.select(F.col("v").alias("u")).join(current.select("u"), "u", "left_semi")
        twice = current.groupBy("u").count().where("count > 1").select("u")
        if inner.union(twice).isEmpty():
            return current
        made = [current]
        current = materialise(_small_star(_large_star(current, made), made), "stars")
        discard(*made)
