"""Marker combinations: histogram of bitmasks, subset lattice, ratios, long table.

The histogram is one aggregation to at most 256 rows; everything after works on those.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions.pixel import label_text


def histogram(pixels: DataFrame, mask: Column, *by: str) -> DataFrame:
    """(by, mask, n): pixels or cells of each exact mask, 0 included."""
    return pixels.groupBy(*by, mask.cast("int").alias("mask")).agg(F.count("*").alias("n"))


def combinations(hist: DataFrame, markers: int, *by: str) -> DataFrame:
    """(by, mask, inclusive, exact, total) for masks 1 to 2^markers - 1.

    Inclusive counts sum the exact ones over all supersets: each row of the histogram is
    opened into the masks that it contains (no join), and all masks are there, at 0 too.
    """
    top = (1 << markers) - 1
    opened = hist.withColumn("combo", F.explode(F.sequence(F.lit(1), F.lit(top))))
    has = F.col("mask").bitwiseAND(F.col("combo")) == F.col("combo")
    return opened.groupBy(*by, "combo").agg(
        F.coalesce(F.sum(F.when(has, F.col("n"))), F.lit(0)).cast("long").alias("inclusive"),
        F.coalesce(F.sum(F.when(F.col("mask") == F.col("combo"), F.col("n"))), F.lit(0)).cast("long").alias("exact"),
        F.sum("n").cast("long").alias("total"),
    ).withColumnRenamed("combo", "mask")


def inclusive_by_cube(hist: DataFrame, markers: int) -> DataFrame:
    """(mask, inclusive) through CUBE over the bits, where an absent bit means any value."""
    bits = [f"b{j}" for j in range(markers)]
    wide = hist.select("n", *[F.shiftright("mask", j).bitwiseAND(F.lit(1)).alias(b) for j, b in enumerate(bits)])
    sums = wide.cube(*bits).agg(F.sum("n").cast("long").alias("inclusive"), F.grouping_id().alias("gid"))
    mask = sum((F.when(F.col(b).isNotNull(), 1 << j).otherwise(0) for j, b in enumerate(bits)), F.lit(0))
    only_set = F.lit(True)
    for b in bits:
        only_set = only_set & (F.col(b).isNull() | (F.col(b) == 1))
    return sums.where(only_set & (mask > 0)).select(mask.cast("int").alias("mask"), "inclusive")


def long_table(counts: DataFrame, names: list[str], metric: str, overall: str, area_mm2: float | None, *by: str) -> DataFrame:
    """One row for each mask, mode and denominator.

    The conditional denominators are the inclusive counts of single markers, in exact mode
    too. A ratio is null where its denominator is 0; densities (cells) and areas (pixels)
    are null without an area. counts: (by, mask, inclusive, exact, total).
    """
    singles = F.map_from_entries(F.collect_list(F.struct("mask", "inclusive")))
    single = counts.where(F.bit_count("mask") == 1).groupBy(*by).agg(singles.alias("singles"))
    if by:
        joined = counts.join(single, list(by))  # 255 rows a group at most
    else:
        joined = counts.withColumn("one", F.lit(1)).join(F.broadcast(single.withColumn("one", F.lit(1))), "one").drop("one")
    offers = [F.struct(F.lit(overall).alias("denominator_type"), F.col("total").alias("denominator"))]
    for j, name in enumerate(names):
        offers.append(F.when(F.col("mask").bitwiseAND(F.lit(1 << j)) != 0, F.struct(
            F.lit(f"positive:{name}").alias("denominator_type"), F.element_at("singles", F.lit(1 << j)).alias("denominator"))))
    modes = F.array(F.struct(F.lit("inclusive").alias("mode"), F.col("inclusive").alias("numerator")),
                    F.struct(F.lit("exact").alias("mode"), F.col("exact").alias("numerator")))
    rows = joined.withColumn("m", F.explode(modes)).withColumn("d", F.explode(F.filter(F.array(*offers), lambda x: x.isNotNull())))
    numerator, pixels = F.col("m.numerator"), metric == "PA"
    per_area = F.lit(None).cast("double") if not area_mm2 or pixels else numerator / F.lit(area_mm2)
    positive = F.lit(None).cast("double") if not area_mm2 or not pixels else numerator * F.lit(area_mm2) / F.nullif(F.col("total"), F.lit(0))
    return rows.select(
        *by, label_text(F.col("mask"), names).alias("combination"), "mask", F.col("m.mode").alias("mode"), F.lit(metric).alias("metric"),
        numerator.alias("numerator"), F.col("d.denominator_type").alias("denominator_type"), F.col("d.denominator").alias("denominator"),
        F.try_divide(numerator, F.col("d.denominator")).alias("ratio"), per_area.alias("density_per_mm2"), positive.alias("positive_area_mm2"))


def expected_rows(markers: int, metrics: int) -> int:
    """Rows of a long table: two modes for each metric, mask and denominator."""
    return 2 * metrics * ((1 << markers) - 1 + markers * (1 << (markers - 1)))


def sampled_area_mm2(pixels: int, downsample: float, width_um: float, height_um: float) -> float:
    return pixels * downsample * downsample * width_um * height_um / 1e6


def enumeration_order(masks: DataFrame) -> DataFrame:
    """Most markers first, then by mask."""
    return masks.orderBy(F.bit_count("mask").desc(), "mask")


def numbered(masks: DataFrame) -> DataFrame:
    """Adds sequence, the place in the enumeration order from 1; there are at most 255 masks."""
    return masks.withColumn("sequence", F.row_number().over(Window.orderBy(F.bit_count("mask").desc(), "mask")))
