"""Objects with nested compartments: sums, means, phenotype masks, eligibility, accounting."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Reasons in the order in which the first failure is reported.
ELIGIBILITY = (
    "missing_cell_roi", "missing_nucleus_roi", "empty_or_nonarea_compartment", "different_image_plane", "cell_outside_image",
    "invalid_cell_geometry", "invalid_nucleus_geometry", "cell_not_fully_inside_roi", "nucleus_not_inside_cell",
)
MEASUREMENT = ("no_valid_compartment_pixels", "no_valid_nucleus_pixels", "no_valid_cytoplasm_pixels")
NUCLEAR = (
    "missing_nucleus_roi", "empty_or_nonarea_nucleus", "different_image_plane", "nucleus_outside_image",
    "invalid_nucleus_geometry", "nucleus_not_fully_inside_roi", "no_valid_nucleus_pixels",
)


def first_failure(order: tuple[str, ...], failed: dict[str, Column]) -> Column:
    """The first reason, in order, whose condition holds; null if none."""
    unknown = set(failed) - set(order)
    if unknown:
        raise ValueError(f"unknown reasons: {sorted(unknown)}")
    rest = F.lit(None).cast("string")
    for reason in reversed(order):
        if reason in failed:
            rest = F.when(failed[reason], F.lit(reason)).otherwise(rest)
    return rest


def measurement_failure(nucleus: Column, cytoplasm: Column) -> Column:
    """Reason by the numbers of pixels in the compartments; null where both have some."""
    return first_failure(MEASUREMENT, {
        "no_valid_compartment_pixels": (nucleus == 0) & (cytoplasm == 0), "no_valid_nucleus_pixels": nucleus == 0,
        "no_valid_cytoplasm_pixels": cytoplasm == 0})


def compartment_means(pixels: DataFrame, key: str, in_nucleus: Column, in_cytoplasm: Column, channels: list[str]) -> DataFrame:
    """(key, nucleus_pixels, cytoplasm_pixels, <channel>_nucleus, <channel>_cytoplasm): one aggregation, with partial sums."""
    parts = {"nucleus": in_nucleus, "cytoplasm": in_cytoplasm}
    counts = [F.count_if(c).alias(f"{p}_pixels") for p, c in parts.items()]
    means = [F.avg(F.when(c, F.col(ch))).alias(f"{ch}_{p}") for ch in channels for p, c in parts.items()]
    return pixels.groupBy(key).agg(*counts, *means)


def phenotype_masks(means: DataFrame, channels: list[str], nucleus: list[float], cytoplasm: list[float]) -> DataFrame:
    """Adds npn, cpn and pn: a marker is positive in the cell if it is in either compartment."""
    bits = lambda part, ts: reduce(lambda a, b: a.bitwiseOR(b), [
        F.when(F.col(f"{c}_{part}") >= t, F.lit(1 << j)).otherwise(F.lit(0)) for j, (c, t) in enumerate(zip(channels, ts, strict=True))])
    out = means.withColumn("npn", bits("nucleus", nucleus)).withColumn("cpn", bits("cytoplasm", cytoplasm))
    return out.withColumn("pn", F.col("npn").bitwiseOR(F.col("cpn")))


def coverage(proposed: Column, measured: Column, rejected: Column) -> Column:
    """struct(fraction, status); numbers that don't add up are an error."""
    fraction = F.when(proposed > 0, measured / proposed)
    status = F.when(proposed == 0, "no_cell_candidates").when(rejected > 0, "review_exclusions").otherwise("all_candidates_measurable")
    broken = F.raise_error(F.lit("measured and rejected do not add up to proposed")).cast("string")
    return F.struct(fraction.alias("fraction"), F.when(measured + rejected == proposed, status).otherwise(broken).alias("status"))


def rejected(candidates: DataFrame, measured: DataFrame, key: str) -> DataFrame:
    return candidates.join(measured.select(key), key, "left_anti")
