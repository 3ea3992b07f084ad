"""Collects queries and their SQL by name."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None):
    """Registers a query under its function's name, with the SQL that must give the same rows."""

    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLES[f.__name__] = sql
        return f

    return add


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A table with the place of each row, (file, row), by which it is read from start to end.

    Files are ordered by their names, not by the URLs that Spark gives, where a space is %20 and comes after "!".
    """
    url = F.col("_metadata.file_path")
    file = F.when(url.contains("%"), F.url_decode(F.replace(url, F.lit("+"), F.lit("%2B")))).otherwise(url)
    return table(spark, sf_dir, name).select("*", file.alias("file"), F.col("_metadata.row_index").alias("row"))
