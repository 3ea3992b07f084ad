"""Mask tiles: label codes of a level, stored once for each content, checked against the statistics."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.pixel import label_text, mask_hue


def _cells(codes: DataFrame, tile: int) -> DataFrame:
    at = F.struct((F.col("py") % tile).alias("y"), (F.col("px") % tile).alias("x"), F.col("code"))
    return codes.groupBy(F.floor(F.col("px") / tile).alias("tx"), F.floor(F.col("py") / tile).alias("ty")).agg(
        F.sort_array(F.collect_list(at)).alias("cells"), F.count_if(F.col("code") > 0).alias("roi_pixels"), F.min("code").alias("low"), F.max("code").alias("high"))


def _digest(cells: Column) -> Column:
    return F.sha2(F.array_join(F.transform(cells, lambda c: F.concat_ws(":", c["y"].cast("string"), c["x"].cast("string"), c["code"].cast("string"))), ","), 256)


def mask_tiles(codes: DataFrame, tile: int) -> DataFrame:
    """(tx, ty, roi_pixels, sha256, constant): a row for each tile of codes (px, py, code), its pixels in reading order."""
    return _cells(codes, tile).select("tx", "ty", "roi_pixels", _digest(F.col("cells")).alias("sha256"), F.when(F.col("low") == F.col("high"), F.col("low")).alias("constant"))


def stored_contents(tiles: DataFrame) -> DataFrame:
    """One row for each distinct content."""
    return tiles.dropDuplicates(["sha256"])


def finish_differences(codes: DataFrame, histogram: DataFrame) -> DataFrame:
    """(mask, masks_n, stats_n) where the codes and the statistics disagree; empty means they agree."""
    own = codes.where(F.col("code") > 0).groupBy((F.col("code") - 1).alias("mask")).agg(F.count("*").alias("masks_n"))
    both = own.join(histogram.withColumnRenamed("n", "stats_n"), "mask", "full_outer")
    return both.where(~F.col("masks_n").eqNullSafe(F.col("stats_n")))


def write_tiles(codes: DataFrame, tile: int, path: str) -> None:
    """The level's codes as ``contents`` (each distinct one once, with its codes in reading order) and ``index`` (a row a tile).

    A constant tile's content is its size and code, so all of one code share one row.
    """
    tiles = _cells(codes, tile)
    constant = F.col("low") == F.col("high")
    flat = F.transform("cells", lambda c: c["code"])
    tiles = tiles.select("tx", "ty", "roi_pixels", _digest(F.col("cells")).alias("sha256"), F.when(constant, F.col("low")).alias("constant"), F.when(~constant, flat).alias("codes"), F.size("cells").alias("pixels"))
    tiles.select("sha256", "constant", "codes", "pixels").dropDuplicates(["sha256"]).write.mode("errorifexists").parquet(f"{path}/contents")
    tiles.select("tx", "ty", "roi_pixels", "sha256").write.mode("errorifexists").parquet(f"{path}/index")


def consume(codes: DataFrame, consumer: Callable[[pd.DataFrame], pd.DataFrame], schema: str) -> DataFrame:
    """What a consumer makes of the label codes as they pass, batch by batch: one pass, in the scan's own tasks."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        yield from map(consumer, batches)

    return codes.mapInPandas(run, schema)


def classification(shapes: DataFrame, names: list[str]) -> DataFrame:
    """(mask, label, hue, shapes): the legend of a map, a row for each mask there is."""
    rows = shapes.groupBy(F.col("mask").cast("int").alias("mask")).agg(F.count("*").alias("shapes"))
    return rows.select("mask", label_text(F.col("mask"), names).alias("label"), mask_hue(F.col("mask")).alias("hue"), "shapes")
