"""Reviewed objects: pairs of compartments, ownership along a tree, navigation."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window


def pair_compartments(objects: DataFrame, pair: str, compartment: str, value: str) -> DataFrame:
    """(pair, cell, nucleus, duplicate): the two compartments of each pair side by side."""
    is_ = lambda c: F.col(compartment) == c
    return objects.groupBy(pair).agg(
        F.max(F.when(is_("cell"), F.col(value))).alias("cell"), F.max(F.when(is_("nucleus"), F.col(value))).alias("nucleus"),
        ((F.count_if(is_("cell")) > 1) | (F.count_if(is_("nucleus")) > 1)).alias("duplicate"))


def owners(edges: DataFrame, view: str = "tree_edges") -> DataFrame:
    """(node, root, depth) by walking from the roots (parent is null) down; edges: node, parent."""
    edges.createOrReplaceTempView(view)
    return edges.sparkSession.sql(f"""
        WITH RECURSIVE walk(node, root, depth) AS (
          SELECT node, node, 0 FROM {view} WHERE parent IS NULL
          UNION ALL SELECT e.node, w.root, w.depth + 1 FROM {view} e JOIN walk w ON e.parent = w.node)
        SELECT node, root, depth FROM walk""")


def circular_neighbours(rows: DataFrame, group: str, order: str) -> DataFrame:
    """Adds previous and next within a group, wrapping around at its ends."""
    w = Window.partitionBy(group).orderBy(order)
    whole = w.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    return rows.withColumn("previous", F.coalesce(F.lag(order).over(w), F.last(order).over(whole))).withColumn(
        "next", F.coalesce(F.lead(order).over(w), F.first(order).over(whole)))


def repair_missing(pairs: DataFrame, candidates: DataFrame, fits: Column) -> DataFrame:
    """Pairs without a nucleus and the candidates of their owner that fit. pairs: pair, owner, nucleus, ...; candidates: candidate, owner, ..."""
    return pairs.where(F.col("nucleus").isNull()).join(candidates, "owner").where(fits)


def first_reasons(rejected: DataFrame, reason: str) -> DataFrame:
    return rejected.groupBy(reason).agg(F.count("*").alias("n")).orderBy(reason)
