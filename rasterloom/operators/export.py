"""Exports: all marker combinations from one read, plan estimates, report groups, bounded inputs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.pixel import additive_component, label_text
from .marker import numbered

#: The smallest figure, and bytes a pixel needs beside its channels.
MIN_WIDTH, MIN_HEIGHT, PIXEL_BYTES = 128, 32, 40


def all_composites(pixels: DataFrame, scaled: list[Column], colours: list[tuple[int, int, int]]) -> DataFrame:
    """(mask, pixels, red, green, blue): the sums of every combination's composite, from one read of the pixels.

    A channel that a combination leaves out is scaled by 0. Sums are combined on the map side,
    so that only a row for each combination is shuffled.
    """
    top = (1 << len(scaled)) - 1
    rows = pixels.select(*[c.alias(f"s{j}") for j, c in enumerate(scaled)]).withColumn("mask", F.explode(F.sequence(F.lit(1), F.lit(top))))
    chosen = [F.when(F.col("mask").bitwiseAND(F.lit(1 << j)) != 0, F.col(f"s{j}")).otherwise(F.lit(0.0)) for j in range(len(scaled))]
    parts = {n: F.sum(additive_component(chosen, [c[k] for c in colours])).cast("long").alias(n) for k, n in enumerate(("red", "green", "blue"))}
    return rows.groupBy("mask").agg(F.count("*").alias("pixels"), *parts.values())


def export_plan(width: Column, height: Column, downsample: Column, channels: int, heap_bytes: int) -> Column:
    """struct(out_width, out_height, combinations, bytes, problem) of an export, before any work."""
    w, h = F.ceil(width / downsample).cast("long"), F.ceil(height / downsample).cast("long")
    need = w * h * (8 * channels + PIXEL_BYTES)
    problem = F.when((w < MIN_WIDTH) | (h < MIN_HEIGHT), "too_small").when(need > heap_bytes // 2, "too_large")
    return F.struct(w.alias("out_width"), h.alias("out_height"), F.lit((1 << channels) - 1).alias("combinations"), need.alias("bytes"), problem.alias("problem"))


def report_groups(rows: DataFrame) -> DataFrame:
    """(mode, metric, denominator_type, rows, defined, first_mask): the groups of a report."""
    return rows.groupBy("mode", "metric", "denominator_type").agg(F.count("*").alias("rows"), F.count("ratio").alias("defined"), F.min("mask").alias("first_mask"))


def bounded(rows: DataFrame, limit: int) -> DataFrame:
    """The rows, unless there are more than ``limit``: then an error, never a cut."""
    if len(rows.limit(limit + 1).take(limit + 1)) > limit:
        raise ValueError(f"more than {limit} rows")
    return rows


def from_source(branches: dict[str, DataFrame], chosen: str) -> DataFrame:
    """The objects of the one chosen source, with their provenance."""
    return branches[chosen].withColumn("source", F.lit(chosen))


def pyramid_info(images: DataFrame) -> DataFrame:
    """(level, images, share): stored images by level over all filters, and against the base level. images: level, filter, image."""
    own = images.groupBy("level").agg(F.count("*").alias("images"))
    base = own.agg(F.min_by("images", "level").alias("base"))
    return own.withColumn("one", F.lit(1)).join(F.broadcast(base.withColumn("one", F.lit(1))), "one").select("level", "images", (F.col("images") / F.col("base")).alias("share"))


def batch_plan(tasks: DataFrame, limit: int = 10_000) -> tuple[DataFrame, DataFrame]:
    """(accepted, rejected with reason) of (task, uri, roi): local files alone, ids well formed and unique."""
    reason = F.when(~F.coalesce(F.col("task").rlike("^[A-Za-z0-9_-]{1,64}$"), F.lit(False)), "task").when(
        ~F.coalesce(F.col("uri").rlike("^file:/"), F.lit(False)), "uri").when(F.col("roi").isNull(), "roi")
    rows = bounded(tasks, limit).withColumn("reason", reason)
    again = rows.groupBy("task").count().where("count > 1").select("task", F.lit("duplicate").alias("again"))
    rows = rows.join(again, "task", "left").withColumn("reason", F.coalesce("reason", "again")).drop("again")
    return rows.where("reason IS NULL").drop("reason"), rows.where("reason IS NOT NULL")


def export_channels(pixels: DataFrame, channels: list[str], path: str) -> DataFrame:
    """Write raw values (level, x, y, a column a channel) as files by level and channel, and return their statistics.

    (level, channel, n, min, max, mean, sha256): the hash is over the values in reading order of tiles' hashes of 256 rows of
    pixels, so that no task orders a whole level.
    """
    values = F.explode(F.array(*[F.struct(F.lit(c).alias("channel"), F.col(c).cast("double").alias("value")) for c in channels])).alias("s")
    rows = pixels.select("level", "x", "y", values).select("level", "s.channel", "x", "y", "s.value")
    rows.write.mode("errorifexists").partitionBy("level", "channel").parquet(path)
    back = pixels.sparkSession.read.parquet(path)
    line = F.concat_ws(":", F.col("x").cast("string"), F.col("y").cast("string"), F.col("value").cast("string"))
    strips = back.groupBy("level", "channel", F.floor(F.col("y") / 256).alias("strip"), F.floor(F.col("x") / 256).alias("column")).agg(
        F.count("*").alias("n"), F.min("value").alias("min"), F.max("value").alias("max"), F.sum("value").alias("sum"), F.sha2(F.array_join(F.sort_array(F.collect_list(line)), ","), 256).alias("h"))
    whole = strips.groupBy("level", "channel").agg(F.sum("n").alias("n"), F.min("min").alias("min"), F.max("max").alias("max"), (F.sum("sum") / F.sum("n")).alias("mean"),
                                                   F.sha2(F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("strip", "column", "h"))), lambda s: s["h"]), ""), 256).alias("sha256"))
    return whole


def publish_composites(pixels: DataFrame, scaled: list[Column], colours: list[tuple[int, int, int]], names: list[str], path: str) -> DataFrame:
    """Write every combination's composite pixels (x, y, red, green, blue) by its sequence number, from one read of the source, and return the figures' list."""
    top = (1 << len(scaled)) - 1
    rows = pixels.select("x", "y", *[c.alias(f"s{j}") for j, c in enumerate(scaled)]).withColumn("mask", F.explode(F.sequence(F.lit(1), F.lit(top))))
    chosen = [F.when(F.col("mask").bitwiseAND(F.lit(1 << j)) != 0, F.col(f"s{j}")).otherwise(F.lit(0.0)) for j in range(len(scaled))]
    parts = [additive_component(chosen, [c[k] for c in colours]).alias(n) for k, n in enumerate(("red", "green", "blue"))]
    places = numbered(pixels.sparkSession.range(1, top + 1).select(F.col("id").cast("int").alias("mask")))
    rows.select("mask", "x", "y", *parts).join(F.broadcast(places), "mask").write.mode("errorifexists").partitionBy("sequence").parquet(path)
    back = pixels.sparkSession.read.parquet(path)
    return back.groupBy("sequence", "mask").agg(F.count("*").alias("pixels")).select("sequence", "mask", label_text(F.col("mask"), names).alias("combination"), "pixels")
