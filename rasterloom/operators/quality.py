"""Channel statistics, display-range audits, percentiles, compatibility findings."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions.scalar import relative_difference

#: The lower and upper point of an automatic display range.
PERCENTILES = (0.01, 0.998)


def unpivot_channels(pixels: DataFrame, channels: list[str]) -> DataFrame:
    """(channel, value): a row for each pixel and channel."""
    return pixels.select(F.explode(F.array(*[F.struct(F.lit(c).alias("channel"), F.col(c).cast("double").alias("value")) for c in channels])).alias("s")).select("s.*")


def channel_statistics(pixels: DataFrame, channels: list[str]) -> DataFrame:
    """(channel, min, max, mean, non_zero, count, status). One row of aggregates, unpivoted afterwards."""
    aggs = []
    for c in channels:
        v = F.col(c).cast("double")
        aggs += [F.min(v).alias(f"{c}__min"), F.max(v).alias(f"{c}__max"), F.avg(v).alias(f"{c}__mean"), F.count_if(v != 0).alias(f"{c}__nz"), F.count(v).alias(f"{c}__n")]
    one = pixels.agg(*aggs)
    rows = one.select(F.explode(F.array(*[F.struct(
        F.lit(c).alias("channel"), F.col(f"{c}__min").alias("min"), F.col(f"{c}__max").alias("max"), F.col(f"{c}__mean").alias("mean"),
        F.col(f"{c}__nz").alias("non_zero"), F.col(f"{c}__n").alias("count")) for c in channels])).alias("s")).select("s.*")
    return rows.withColumn("status", signal_status(F.col("min"), F.col("max")))


def signal_status(low: Column, high: Column) -> Column:
    return F.when(high == 0, "ALL_ZERO").when(high - low < 4, "LOW_DYNAMIC_RANGE").otherwise("SIGNAL_PRESENT")


def display_audit(pixels: DataFrame, value: Column, low: float, high: float, *by: str) -> DataFrame:
    """Counts of values against a display range, compared in single precision; fractions are of the finite values."""
    v = value.cast("float")
    lo, hi = F.lit(low).cast("float"), F.lit(high).cast("float")
    finite = ~F.isnan(v) & (F.abs(v) != F.lit(float("inf")).cast("float")) & v.isNotNull()
    out = pixels.groupBy(*by).agg(
        F.count_if(finite).alias("finite"), F.count_if(v.isNotNull() & ~finite).alias("nonfinite"), F.count_if(finite & (v < lo)).alias("below"),
        F.count_if(finite & (v == lo)).alias("at_min"), F.count_if(finite & (v > hi)).alias("above"), F.count_if(finite & (v == hi)).alias("at_max"),
        F.min(F.when(finite, v.cast("double"))).alias("observed_min"), F.max(F.when(finite, v.cast("double"))).alias("observed_max"))
    return out.withColumn("below_fraction", F.try_divide("below", "finite")).withColumn("above_fraction", F.try_divide("above", "finite"))


def percentile_range(values: DataFrame, value: str, bin_width: float = 1.0, *by: str) -> DataFrame:
    """(by, low, high): left edges of the first bins whose running count reaches the two points.

    One aggregation to bins, then a running sum over the bins of a group.
    """
    keys = list(by) or [F.lit(0).alias("one")]
    bins = values.where(F.col(value).isNotNull()).groupBy(*keys, F.floor(F.col(value) / bin_width).alias("bin")).agg(F.count("*").alias("n"))
    names = list(by) or ["one"]
    # Blocks of bins are summed first, so that no task holds all bins of a group.
    bins = bins.withColumn("block", F.floor(F.col("bin") / BLOCK_BINS))
    blocks = bins.groupBy(*names, "block").agg(F.sum("n").alias("of_block"))
    group = Window.partitionBy(*names)
    blocks = blocks.withColumn("before", F.sum("of_block").over(group.orderBy("block")) - F.col("of_block")).withColumn("all", F.sum("of_block").over(group))
    ran = bins.join(blocks.drop("of_block"), [*names, "block"]).withColumn("upto", F.col("before") + F.sum("n").over(Window.partitionBy(*names, "block").orderBy("bin")))
    edge = lambda p: F.min(F.when(F.col("upto") >= F.col("all") * p, F.col("bin"))) * bin_width
    return ran.groupBy(*by).agg(edge(PERCENTILES[0]).alias("low"), edge(PERCENTILES[1]).alias("high"))


#: Bins that one task sums up in their order.
BLOCK_BINS = 4096


def calibration_mismatch(levels: DataFrame) -> DataFrame:
    """(level, mismatch, warn): the level whose physical ratio is farthest from its geometry; the first one wins ties.

    levels: level, downsample, um_x, um_y, base_x, base_y.
    """
    far = F.greatest(relative_difference(F.col("downsample"), F.col("um_x") / F.col("base_x")), relative_difference(F.col("downsample"), F.col("um_y") / F.col("base_y")))
    worst = levels.withColumn("mismatch", far).agg(F.max_by(F.struct("level", "mismatch"), F.struct("mismatch", -F.col("level"))).alias("w"))
    return worst.select("w.level", "w.mismatch", (F.col("w.mismatch") > 0.001).alias("warn"))


def duplicates(rows: DataFrame, key: Column, order: str) -> DataFrame:
    """Adds duplicate: true from the second row of a key on."""
    return rows.withColumn("duplicate", F.row_number().over(Window.partitionBy(key).orderBy(order)) > 1)


def findings(rows: DataFrame, rules: list[tuple[str, str, Column]], *keep: str) -> DataFrame:
    """(keep, severity, code): every rule that holds, not the first one alone."""
    offers = F.array(*[F.when(bad, F.struct(F.lit(s).alias("severity"), F.lit(c).alias("code"))) for s, c, bad in rules])
    return rows.select(*keep, F.explode(F.filter(offers, lambda x: x.isNotNull())).alias("f")).select(*keep, "f.*")


def slide_rules() -> list[tuple[str, str, Column]]:
    """Rules on one row of slide metadata; severities and codes are fixed values here and below."""
    c = F.col
    uneven = (c("divisions") <= 0) | (c("grid_x") % F.nullif(c("divisions"), F.lit(0)) != 0) | (c("grid_y") % F.nullif(c("divisions"), F.lit(0)) != 0)
    return [
        ("ERROR", "MISSING_ANCHOR_FILE", ~c("has_anchor")), ("ERROR", "MISSING_INDEX", ~c("has_index")),
        ("ERROR", "UNSUPPORTED_BIT_DEPTH", c("stored_bits") != 8), ("WARNING", "CAMERA_STORAGE_BIT_DEPTH_DIFFER", c("camera_bits") != c("stored_bits")),
        ("ERROR", "INVALID_CAMERA_GEOMETRY", uneven), ("ERROR", "NO_RESOLUTION_LEVELS", c("level_count") == 0),
        ("ERROR", "NO_FLUORESCENCE_CHANNELS", c("channel_count") == 0), ("WARNING", "NO_STITCHING_POSITIONS", c("position_record") < 0),
    ]


def level_rules() -> list[tuple[str, str, Column]]:
    c = F.col
    positive = lambda v: ~F.isnan(v) & (v > 0) & (v < float("inf"))
    return [
        ("ERROR", "UNSUPPORTED_COMPRESSION", F.upper(c("format")) != "JPEG"), ("ERROR", "INVALID_CONCAT_FACTOR", ~c("concat").between(0, 20)),
        ("ERROR", "INVALID_PIXEL_SIZE", ~(positive(c("um_x")) & positive(c("um_y")))), ("ERROR", "INVALID_TILE_SIZE", (c("tile_w") <= 0) | (c("tile_h") <= 0)),
    ]


def channel_rules(filters: int) -> list[tuple[str, str, Column]]:
    """Rules on channels (channel, name, filter_level_index, stored_component), with the duplicate flags name_again and storage_again."""
    c = F.col
    return [
        ("WARNING", "DUPLICATE_CHANNEL_NAME", c("name_again")), ("ERROR", "INVALID_FILTER_LEVEL", ~c("filter_level_index").between(0, filters - 1)),
        ("ERROR", "UNSUPPORTED_PACKED_COMPONENT", ~c("stored_component").between(0, 2)), ("WARNING", "DUPLICATE_STORAGE_MAPPING", c("storage_again")),
    ]


def compatibility(slides: DataFrame, levels: DataFrame, channels: DataFrame, files: DataFrame, filters: int) -> DataFrame:
    """(slide, severity, code) of all rules, a row for each slide, level, channel or file that breaks one.

    levels: slide, level, format, concat, um_x, um_y, tile_w, tile_h, downsample; channels: slide, channel, name,
    filter_level_index, stored_component; files: slide, name, found. The order of the levels decides ties.
    """
    again = lambda key: F.row_number().over(Window.partitionBy("slide", *key).orderBy("channel")) > 1
    told = channels.withColumn("name_again", again(["name"])).withColumn("storage_again", again(["filter_level_index", "stored_component"]))
    base = levels.groupBy("slide").agg(F.min_by(F.struct("um_x", "um_y"), "level").alias("b"))
    c = F.col
    far = F.greatest(relative_difference(c("downsample"), c("um_x") / c("b.um_x")), relative_difference(c("downsample"), c("um_y") / c("b.um_y")))
    uneven = levels.join(base, "slide").groupBy("slide").agg(F.max(far).alias("far"))
    missing = files.where(~c("found")).select("slide", F.lit("ERROR").alias("severity"), F.lit("MISSING_DATA_FILE").alias("code"))
    mismatch = uneven.where(c("far") > MAX_MISMATCH).select("slide", F.lit("WARNING").alias("severity"), F.lit("PYRAMID_PIXEL_SIZE_MISMATCH").alias("code"))
    parts = [findings(slides, slide_rules(), "slide"), findings(levels, level_rules(), "slide"), findings(told, channel_rules(filters), "slide"), missing, mismatch]
    return reduce(DataFrame.unionByName, parts)


#: Fixed value: the largest relative difference of physical and geometric downsample that isn't told.
MAX_MISMATCH = 0.001


def support_score(findings_: DataFrame, slides: DataFrame, key: str) -> DataFrame:
    """(key, score): 4.0 for slides without an ERROR, else 0."""
    bad = findings_.where(F.col("severity") == "ERROR").select(key).distinct().withColumn("bad", F.lit(True))
    return slides.select(key).join(bad, key, "left").select(key, F.when(F.col("bad"), 0.0).otherwise(4.0).alias("score"))


def workload(low: Column, high: Column, downsample: Column | float) -> Column:
    """Pixel centres in [low, high) along one axis."""
    return F.ceil(high / downsample - 0.5) - F.ceil(low / downsample - 0.5)


#: More pixel centres than this are to be confirmed.
CONFIRM_PIXELS = 100_000_000
