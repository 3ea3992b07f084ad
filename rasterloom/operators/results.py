"""One analysis from pixels, region, profile and cells, and its published tables.

``analyze`` reads the pixels for the histogram, and once more for the cells' and the nuclei's sums;
the histograms have at most 256 rows each and everything after works on those. ``save`` writes
the tables as guarded text in their row order, under a marker that goes last.
"""

from __future__ import annotations

import json
from dataclasses import asdict, dataclass
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import geometry, pixel, scalar
from ..model import Profile, Region
from . import marker, objects, runs, spatial

#: The columns of a table of combinations, and the metrics in their order.
COMBINATION_COLUMNS = ("combination", "mask", "mode", "metric", "numerator", "denominator_type", "denominator", "ratio", "density_per_mm2", "positive_area_mm2")
METRICS = ("PA", "NPN", "CPN", "PN", "NPN_NUCLEUS_ONLY")


@dataclass(frozen=True)
class Image:
    """Size in source pixels, and the sides of a sampled pixel in micrometres."""

    width: int
    height: int
    pixel_um: tuple[float, float] = (1.0, 1.0)
    downsample: float = 1.0


@dataclass(frozen=True)
class Analysis:
    profile: Profile
    roi_pixels: int
    combinations: DataFrame
    cells: DataFrame
    excluded_cells: DataFrame
    nuclei: DataFrame
    excluded_nuclei: DataFrame
    nuclear_combinations: DataFrame


def inside_region(region: Region):
    """A function of a ring's column: whether the ring lies in one of the taken rectangles and in none that is left out."""

    def one(ring: np.ndarray) -> bool:
        low, high = ring.min(0), ring.max(0)
        if not any(r[0] <= low[0] and r[1] <= low[1] and high[0] <= r[2] and high[1] <= r[3] for r in region.include):
            return False
        ends = np.roll(ring, -1, axis=0)
        for r in region.exclude:
            corner, size = np.array(r[:2]), np.array(r[2:]) - np.array(r[:2])
            with np.errstate(divide="ignore", invalid="ignore"):
                at = np.stack([(np.array(r[j : j + 3 : 2])[k] - ring[:, j]) / (ends - ring)[:, j] for j in (0, 1) for k in (0, 1)], axis=1)
            at = np.sort(np.concatenate([np.where((at > 0) & (at < 1), at, 0.0), np.zeros((len(ring), 1)), np.ones((len(ring), 1))], axis=1), axis=1)
            middle = ring[:, None] + ((at[:, 1:] + at[:, :-1]) / 2)[..., None] * (ends - ring)[:, None]
            share = (middle - corner) / size
            inner = ((share > 1e-12) & (share < 1 - 1e-12)).all(-1) & (at[:, 1:] > at[:, :-1])
            if inner.any() or geometry._within(ring, (corner + size / 2)[None])[0]:
                return False
        return True

    @F.pandas_udf("boolean")
    def covered(rings: pd.Series) -> pd.Series:
        return pd.Series([r is not None and len(r) >= 3 and one(np.array([(p["x"], p["y"]) for p in r], float)) for r in rings], dtype=bool)

    return covered


def _judged(cells: DataFrame, region: Region, image: Image) -> DataFrame:
    """``cells`` and what the cascades ask: each condition as a column."""
    c, covered = F.col, inside_region(region)

    def empty(r: str) -> Column:
        e = geometry.envelope(c(r))
        return F.coalesce((F.size(r) < 3) | (e["x0"] == e["x1"]) | (e["y0"] == e["y1"]), F.lit(False))

    def outside(r: str) -> Column:
        e = geometry.envelope(c(r))
        return F.coalesce((e["x0"] < 0) | (e["y0"] < 0) | (e["x1"] > image.width) | (e["y1"] > image.height), F.lit(False))

    own = cells if "same_plane" in cells.columns else cells.withColumn("same_plane", F.lit(True))
    return own.select("*", empty("cell").alias("__empty_cell"), empty("nucleus").alias("__empty_nucleus"), outside("cell").alias("__out_cell"), outside("nucleus").alias("__out_nucleus"),
                      geometry.is_valid_ring("cell").alias("__valid_cell"), geometry.is_valid_ring("nucleus").alias("__valid_nucleus"), covered("cell").alias("__in_cell"),
                      covered("nucleus").alias("__in_nucleus"), F.coalesce(geometry.ring_covers("cell", "nucleus"), F.lit(False)).alias("__nested"))


def _reasons() -> tuple[Column, Column]:
    """Eligibility of the cell, and of its nucleus by itself; null where it may be measured."""
    c = F.col
    cell = objects.first_failure(objects.ELIGIBILITY, {
        "missing_cell_roi": c("cell").isNull(), "missing_nucleus_roi": c("nucleus").isNull(), "empty_or_nonarea_compartment": c("__empty_cell") | c("__empty_nucleus"),
        "different_image_plane": ~c("same_plane"), "cell_outside_image": c("__out_cell"), "invalid_cell_geometry": ~c("__valid_cell"), "invalid_nucleus_geometry": ~c("__valid_nucleus"),
        "cell_not_fully_inside_roi": ~c("__in_cell"), "nucleus_not_inside_cell": ~c("__nested")})
    nucleus = objects.first_failure(objects.NUCLEAR, {
        "missing_nucleus_roi": c("nucleus").isNull(), "empty_or_nonarea_nucleus": c("__empty_nucleus"), "different_image_plane": ~c("same_plane"), "nucleus_outside_image": c("__out_nucleus"),
        "invalid_nucleus_geometry": ~c("__valid_nucleus"), "nucleus_not_fully_inside_roi": ~c("__in_nucleus")})
    return cell, nucleus


def _in_rings(points: DataFrame, rings: DataFrame, ring: str, size: int) -> DataFrame:
    e = geometry.envelope(F.col(ring))
    low = [F.floor(e[k]) for k in ("x0", "y0")]
    boxed = rings.select("*", low[0].alias("ox"), low[1].alias("oy"), (F.floor(e["x1"]) - low[0] + 1).alias("ow"), (F.floor(e["y1"]) - low[1] + 1).alias("oh"))
    return spatial.points_in_objects(points, boxed, geometry.contains(F.col(ring), F.col("x"), F.col("y")), size)


def analyze(pixels: DataFrame, region: Region, profile: Profile, cells: DataFrame, image: Image, bucket: int = 64) -> Analysis:
    """pixels: x and y (centres) and a column for each marker's name; cells: cell_id, ord (input order), cell and nucleus
    (rings, null where there is none) and, where planes differ, same_plane."""
    names, c = [m.name for m in profile.markers], F.col
    sampled = pixels.where(pixel.inside(c("x"), c("y"), region))
    hist = marker.histogram(sampled, pixel.bitmask([c(n) for n in names], [m.pixel for m in profile.markers])).collect()  # at most 256 rows
    spark, total = pixels.sparkSession, sum(r["n"] for r in hist)
    area = marker.sampled_area_mm2(1, image.downsample, *image.pixel_um)
    roi_mm2 = total * area
    cell_reason, nucleus_reason = _reasons()
    judged = _judged(cells, region, image).select("cell_id", "ord", "cell", "nucleus", cell_reason.alias("reason"), nucleus_reason.alias("nucleus_reason"))
    # What several tables are made of is kept; a lost part is computed again.
    judged = judged.withColumn("nucleus_reason", F.when(c("reason").isNotNull(), c("nucleus_reason"))).persist()

    able = judged.where("reason IS NULL").select("cell_id", "cell", "nucleus")
    in_cell = _in_rings(pixels, able, "cell", bucket)
    in_nucleus = geometry.contains(c("nucleus"), c("x"), c("y"))
    means = objects.compartment_means(in_cell, "cell_id", in_nucleus, ~in_nucleus, names)
    zero = {k: 0 for k in ("nucleus_pixels", "cytoplasm_pixels")}
    measured = judged.where("reason IS NULL").join(means, "cell_id", "left").fillna(zero)
    measured = measured.withColumn("failure", objects.measurement_failure(c("nucleus_pixels"), c("cytoplasm_pixels"))).withColumn("at", geometry.centroid(c("cell"))).drop("cell", "nucleus").persist()
    kept = objects.phenotype_masks(measured.where("failure IS NULL"), names, [m.nucleus for m in profile.markers], [m.cytoplasm for m in profile.markers])
    out_cells = kept.select("ord", "cell_id", c("at.x").alias("x"), c("at.y").alias("y"), "nucleus_pixels", "cytoplasm_pixels", "npn", "cpn", "pn", *[f"{n}_{p}" for n in names for p in ("nucleus", "cytoplasm")])
    excluded = judged.where("reason IS NOT NULL").select("ord", "cell_id", F.lit("eligibility").alias("stage"), "reason").unionByName(
        measured.where("failure IS NOT NULL").select("ord", "cell_id", F.lit("measurement").alias("stage"), c("failure").alias("reason")))

    nuclear = judged.where("nucleus_reason IS NULL AND nucleus IS NOT NULL").select("cell_id", "ord", "nucleus")
    sums = _in_rings(pixels, nuclear.select("cell_id", "nucleus"), "nucleus", bucket).groupBy("cell_id").agg(F.count("*").alias("pixels"), *[F.avg(n).alias(f"{n}_nucleus") for n in names])
    tried = nuclear.join(sums, "cell_id", "left").withColumn("at", geometry.centroid(c("nucleus"))).drop("nucleus").persist()
    bits = reduce(Column.bitwiseOR, [F.when(c(f"{m.name}_nucleus") >= m.nucleus, F.lit(1 << j)).otherwise(F.lit(0)) for j, m in enumerate(profile.markers)])
    nuclei = tried.where("pixels IS NOT NULL").select("ord", "cell_id", c("at.x").alias("x"), c("at.y").alias("y"), "pixels", bits.alias("mask"), *[f"{n}_nucleus" for n in names])
    no_nuclei = judged.where("nucleus_reason IS NOT NULL").select("ord", "cell_id", c("nucleus_reason").alias("reason")).unionByName(
        tried.where("pixels IS NULL").select("ord", "cell_id", F.lit(objects.NUCLEAR[-1]).alias("reason")))

    pa = spark.createDataFrame([(r["mask"], r["n"]) for r in hist] or [(0, 0)], "mask int, n long")
    long = lambda h, metric, overall, mm2: marker.long_table(marker.combinations(h, len(names)), names, metric, overall, mm2)
    tables = [long(pa, "PA", "all_sampled_roi_pixels", roi_mm2)]
    none = spark.createDataFrame([(0, 0)], "mask int, n long")
    for metric, column in (("NPN", "npn"), ("CPN", "cpn"), ("PN", "pn")):  # no cells: counts of 0
        tables.append(long(marker.histogram(kept, c(column)).unionByName(none), metric, "all_eligible_cells", roi_mm2))
    nuclear_table = long(marker.histogram(nuclei, c("mask")).unionByName(none), "NPN_NUCLEUS_ONLY", "all_measured_nuclei", roi_mm2)
    return Analysis(profile, total, reduce(DataFrame.unionByName, tables), out_cells, excluded, nuclei, no_nuclei, nuclear_table)


def _text(rows: DataFrame, kinds: list[tuple[str, Column]], order: list[Column]) -> DataFrame:
    """One column of lines, the header first; cells: text is guarded and quoted, numbers have 12 digits, counts stand as they are."""
    def cell(name: str, v: Column) -> Column:
        kind = rows.select(v).schema[0].dataType.typeName()
        return scalar.csv_cell(F.coalesce(v, F.lit(""))) if kind == "string" else scalar.twelve_digits(v) if kind in ("double", "float") else F.coalesce(v.cast("string"), F.lit(""))

    line = F.concat_ws(",", *[cell(n, v) for n, v in kinds])
    lines = rows.select(F.lit(1).alias("__part"), *[o.alias(f"__o{j}") for j, o in enumerate(order)], line.alias("value"))
    head = ",".join(n if n.replace("_", "").isalnum() else '"' + n.replace('"', '""') + '"' for n, _ in kinds)
    first = rows.sparkSession.createDataFrame([(0, head)], "__part int, value string")
    return first.unionByName(lines, allowMissingColumns=True).orderBy("__part", *[f"__o{j}" for j in range(len(order))]).select("value")


def _combination_lines(rows: DataFrame, names: list[str]) -> DataFrame:
    """By mask, mode, metric and denominator, as they are enumerated."""
    place = lambda column, values: F.array_position(F.array(*[F.lit(v) for v in values]), F.col(column))
    order = [F.col("mask"), place("mode", ("inclusive", "exact")), place("metric", METRICS), place("denominator_type", [f"positive:{n}" for n in names])]
    return _text(rows, [(c, F.col(c)) for c in COMBINATION_COLUMNS], order)


def sinks(a: Analysis) -> dict[str, DataFrame]:
    """Lines of each published table, by its file's name."""
    names, c, own = [m.name for m in a.profile.markers], F.col, lambda pairs: [(n, F.col(v)) for n, v in pairs]
    cells = [("cell_id", "cell_id"), ("x_source_px", "x"), ("y_source_px", "y"), ("nucleus_sample_pixels", "nucleus_pixels"), ("cytoplasm_sample_pixels", "cytoplasm_pixels"), ("NPN_mask", "npn"), ("CPN_mask", "cpn"), ("PN_mask", "pn")]
    cells += [(f"{n}:{p}_mean", f"{n}_{p}") for n in names for p in ("nucleus", "cytoplasm")]
    nuclei = [("cell_id", "cell_id"), ("x_source_px", "x"), ("y_source_px", "y"), ("nucleus_sample_pixels", "pixels"), ("NPN_nucleus_only_mask", "mask"), *[(f"{n}:nucleus_mean", f"{n}_nucleus") for n in names]]
    stage = F.when(c("stage") == "eligibility", 0).otherwise(1)
    return {
        "combinations.csv": _combination_lines(a.combinations, names), "nuclear-combinations.csv": _combination_lines(a.nuclear_combinations, names),
        "cells.csv": _text(a.cells, own(cells), [c("ord")]), "nuclei.csv": _text(a.nuclei, own(nuclei), [c("ord")]),
        "excluded-cells.csv": _text(a.excluded_cells, own([("cell_id", "cell_id"), ("stage", "stage"), ("first_failure_reason", "reason")]), [stage, c("ord")]),
        "excluded-nuclei.csv": _text(a.excluded_nuclei, own([("cell_id", "cell_id"), ("first_failure_reason", "reason")]), [c("ord")]),
    }


def save(a: Analysis, path: str, image_name: str, created_at: str) -> None:
    """Write all tables as folders of ordered text parts, then the manifest, under a marker; an existing output is refused."""
    spark = a.combinations.sparkSession
    counts = {k: df.count() for k, df in (("measured", a.cells), ("rejected", a.excluded_cells))}
    manifest = {"schemaVersion": 1, "status": "complete", "algorithm": "raw-tile-if-v1", "imageName": image_name, "createdAt": created_at, "profile": asdict(a.profile),
                "roiPixels": a.roi_pixels, "counts": {**counts, "proposed": sum(counts.values())}}
    profile = spark.createDataFrame([(json.dumps(asdict(a.profile)),)], "value string")
    with runs.publishing(spark, path) as publish:
        for name, lines in {**sinks(a), "profile.json": profile, "manifest.json": spark.createDataFrame([(json.dumps(manifest),)], "value string")}.items():
            publish(name, lines)


def read_table(spark: SparkSession, path: str) -> DataFrame:
    """A published table, all columns as text; the header is the line that no other precedes."""
    head = spark.read.csv(path, quote='"', escape='"', multiLine=True).where("_c0 = 'cell_id' OR _c0 = 'combination'").first()
    rows = spark.read.schema(", ".join(f"`{h}` string" for h in head)).csv(path, quote='"', escape='"', multiLine=True, mode="FAILFAST")
    return rows.where(F.col(f"`{head[0]}`") != head[0])
