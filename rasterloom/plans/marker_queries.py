"""Marker combinations over lineitem as a raster of four channels.

A pixel is a row, its centre at (l_partkey + 0.5, l_suppkey + 0.5). The region's bounds are
turned into bounds of the integer columns, so that the scan gets them as pushed filters.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import pixel, scalar
from ..model import Marker, Profile, Region
from ..operators import marker, runs
from ._register import query, table

PROFILE = Profile(0, (
    Marker(0, "quantity", 40, 40, 40), Marker(1, "extendedprice", 80_000, 80_000, 80_000),
    Marker(2, "discount", 0.075, 0.075, 0.075), Marker(3, "tax", 0.065, 0.065, 0.065)))
NAMES = [m.name for m in PROFILE.markers]
COLUMNS = [f"l_{n}" for n in NAMES]
THRESHOLDS = [m.pixel for m in PROFILE.markers]
REGION = Region(((20, 0, 180, 1e6),), ((60, 0, 100, 1e6),))
#: Side lengths in micrometres of a pixel.
PIXEL_UM = (0.5, 0.75)


def whole_pixels(region: Region) -> Region:
    """The same pixels by their integer coordinates instead of their centres."""
    cut = lambda r: tuple(math.ceil(v - 0.5) for v in r)
    return Region(tuple(cut(r) for r in region.include), tuple(cut(r) for r in region.exclude))


def sampled(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem")
    return lines.where(pixel.inside(F.col("l_partkey"), F.col("l_suppkey"), whole_pixels(REGION)))


def mask(thresholds=THRESHOLDS):
    return pixel.bitmask([F.col(c) for c in COLUMNS], thresholds)


SQL_MASK = " + ".join(f"CASE WHEN {c} >= {t} THEN {1 << j} ELSE 0 END" for j, (c, t) in enumerate(zip(COLUMNS, THRESHOLDS, strict=True)))
SQL_INSIDE = "l_partkey + 0.5 >= 20 AND l_partkey + 0.5 < 180 AND NOT (l_partkey + 0.5 >= 60 AND l_partkey + 0.5 < 100)"
SQL_HIST = f"h AS (SELECT CAST({SQL_MASK} AS INTEGER) AS bits, count(*) AS c FROM lineitem WHERE {SQL_INSIDE} GROUP BY 1)"
SQL_LABEL = "concat_ws('+', " + ", ".join(f"CASE WHEN mask & {1 << j} <> 0 THEN '{n}' END" for j, n in enumerate(NAMES)) + ")"


def sql_combos(hist: str = "h", by: str = "") -> str:
    """SELECT of (by, mask, inclusive, exact, total) from a histogram (by, bits, c)."""
    b = f"{by}, " if by else ""
    return f"""SELECT {b}CAST(m AS INTEGER) AS mask, CAST(coalesce(sum(CASE WHEN (bits & m) = m THEN c END), 0) AS BIGINT) AS inclusive,
  CAST(coalesce(sum(CASE WHEN bits = m THEN c END), 0) AS BIGINT) AS exact, CAST(sum(c) AS BIGINT) AS total
  FROM {hist}, (SELECT CAST(unnest(range(1, 16)) AS INTEGER) AS m) GROUP BY {b}m"""


def sql_long(combos: str, metric: str, overall: str, area: str) -> str:
    """SELECT of the long table from a relation of combinations."""
    singles = " UNION ALL ".join(f"SELECT {j} AS j, '{n}' AS name" for j, n in enumerate(NAMES))
    density = f"numerator / {area}" if metric != "PA" else "CAST(NULL AS DOUBLE)"
    positive = f"numerator * {area} / total" if metric == "PA" else "CAST(NULL AS DOUBLE)"
    return f"""SELECT {SQL_LABEL} AS combination, mask, mode, '{metric}' AS metric, numerator, denominator_type, denominator,
  numerator / nullif(CAST(denominator AS DOUBLE), 0) AS ratio, CAST({density} AS DOUBLE) AS density_per_mm2, CAST({positive} AS DOUBLE) AS positive_area_mm2 FROM (
  SELECT mask, mode, CASE WHEN mode = 'exact' THEN exact ELSE inclusive END AS numerator, denominator_type, denominator, total FROM
   (SELECT mask, inclusive, exact, total, '{overall}' AS denominator_type, total AS denominator FROM {combos}
    UNION ALL SELECT c.mask, c.inclusive, c.exact, c.total, 'positive:' || s.name, o.inclusive FROM {combos} c JOIN ({singles}) s ON c.mask & (1 << s.j) <> 0
      JOIN {combos} o ON o.mask = (1 << s.j)), (SELECT unnest(['inclusive', 'exact']) AS mode))"""


def area_mm2(pixels: int) -> float:
    return marker.sampled_area_mm2(pixels, 1.0, *PIXEL_UM)


def pixel_long_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The number of sampled pixels scales the areas inside the plan, not on the driver."""
    counts = marker.combinations(marker.histogram(sampled(spark, sf_dir), mask()), len(NAMES))
    rows = marker.long_table(counts, NAMES, "PA", "all_sampled_roi_pixels", None)
    one = area_mm2(1)  # a pixel's area: its share of the total cancels the total
    return rows.withColumn("positive_area_mm2", F.col("numerator") * F.lit(one))


@query(f"WITH {SQL_HIST} SELECT {SQL_LABEL} AS combination, * FROM ({sql_combos()})")
def flagship_marker_combinations(spark, sf_dir):
    hist = marker.histogram(sampled(spark, sf_dir), mask())
    counts = marker.combinations(hist, len(NAMES))
    return marker.enumeration_order(counts.select(pixel.label_text(F.col("mask"), NAMES).alias("combination"), "*"))


@query(f"WITH {SQL_HIST} SELECT bits AS mask, c AS n FROM h")
def pa_histogram_exact(spark, sf_dir):
    return marker.histogram(sampled(spark, sf_dir), mask())


_AREA = f"(total * {PIXEL_UM[0]}::DOUBLE * {PIXEL_UM[1]}::DOUBLE / 1e6)"
SQL_PA_LONG = f"SELECT * REPLACE (round(positive_area_mm2, 12) AS positive_area_mm2, round(ratio, 12) AS ratio) FROM ({sql_long('k', 'PA', 'all_sampled_roi_pixels', _AREA)})"


@query(f"WITH {SQL_HIST}, k AS ({sql_combos()}) {SQL_PA_LONG}")
def pa_long_table(spark, sf_dir):
    rows = pixel_long_table(spark, sf_dir)
    return rows.withColumns({c: F.round(c, 12) for c in ("positive_area_mm2", "ratio")})


@query(f"WITH {SQL_HIST} SELECT mask, inclusive FROM ({sql_combos()}) WHERE inclusive > 0")
def inclusive_via_cube(spark, sf_dir):
    return marker.inclusive_by_cube(marker.histogram(sampled(spark, sf_dir), mask()), len(NAMES))


@query(f"""WITH p AS (SELECT CASE WHEN {SQL_INSIDE} THEN {SQL_MASK} + 1 ELSE 0 END AS code FROM lineitem)
SELECT CAST(code AS INTEGER) AS code, count(*) AS n, code > 1 AS any_positive, code > 0 AND ((code - 1) & 5) = 5 AS superset, code - 1 = 5 AS exact FROM p GROUP BY code""")
def label_codes_match(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem")
    is_in = pixel.inside(F.col("l_partkey"), F.col("l_suppkey"), whole_pixels(REGION))
    code = F.col("code")
    return lines.select(pixel.label_code(mask(), is_in).alias("code")).groupBy("code").agg(F.count("*").alias("n")).select(
        "code", "n", pixel.label_matches(code, 0).alias("any_positive"), pixel.label_matches(code, 5).alias("superset"), pixel.label_matches(code, 5, exact=True).alias("exact"))


@query(f"""WITH h AS (SELECT l_returnflag AS run_id, CAST({SQL_MASK} AS INTEGER) AS bits, count(*) AS c FROM lineitem GROUP BY 1, 2) {sql_combos(by='run_id')}""")
def run_rows_union(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem").withColumn("run_id", F.col("l_returnflag"))
    return marker.combinations(marker.histogram(lines, mask(), "run_id"), len(NAMES), "run_id")


@query(f"""WITH {SQL_HIST}, k AS ({sql_combos()}), t AS (SELECT mask || ':' || mode || ':' || denominator_type AS key FROM ({SQL_PA_LONG}) WHERE mask = 3 AND mode = 'exact'),
z AS (SELECT mask || ':' || mode || ':' || denominator_type AS key FROM ({SQL_PA_LONG}) WHERE mask = 3 AND mode = 'exact' AND denominator > 0)
SELECT key, 'numerator_not_over_denominator' AS rule FROM t UNION ALL SELECT key, 'ratio_fits' FROM z""")
def combination_constraints(spark, sf_dir):
    """The constraints on a long table in which one combination's exact numerators were raised past their denominators."""
    rows = pixel_long_table(spark, sf_dir)
    spoiled = (F.col("mask") == 3) & (F.col("mode") == "exact")
    rows = rows.withColumn("numerator", F.when(spoiled, F.col("denominator") + 1).otherwise(F.col("numerator")))
    key = F.concat_ws(":", F.col("mask").cast("string"), "mode", "denominator_type")
    return runs.violations(rows, key, runs.combination_rules(NAMES)).select("key", "rule")


@query("""WITH p AS (SELECT least(greatest((l_quantity - 5) / 40.0, 0), 1) AS a, least(greatest((l_extendedprice - 1000) / 79000.0, 0), 1) AS b,
  least(greatest((l_discount - 0.01) / 0.08, 0), 1) AS c, l_partkey + 0.5 >= 20 AND l_partkey + 0.5 < 180 AND NOT (l_partkey + 0.5 >= 60 AND l_partkey + 0.5 < 100) AS i FROM lineitem),
q AS (SELECT CAST(CASE WHEN i THEN least(255, floor(a * 255 + 0.5) + floor(b * 0 + 0.5) + floor(c * 128 + 0.5)) ELSE 0 END AS INTEGER) AS r,
  CAST(CASE WHEN i THEN least(255, floor(a * 64 + 0.5) + floor(b * 255 + 0.5) + floor(c * 0 + 0.5)) ELSE 0 END AS INTEGER) AS g,
  CAST(CASE WHEN i THEN least(255, floor(a * 0 + 0.5) + floor(b * 32 + 0.5) + floor(c * 255 + 0.5)) ELSE 0 END AS INTEGER) AS b FROM p)
SELECT r, g, b, count(*) AS n FROM q GROUP BY r, g, b""")
def rgb_composite_histogram(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem")
    is_in = pixel.inside(F.col("l_partkey"), F.col("l_suppkey"), whole_pixels(REGION))
    scaled = lines.select(is_in.alias("i"), pixel.rescale(F.col("l_quantity"), 5, 45).alias("a"), pixel.rescale(F.col("l_extendedprice"), 1000, 80000).alias("b"),
                          ((lambda v: F.least(F.greatest((v - 0.01) / 0.08, F.lit(0.0)), F.lit(1.0)))(F.col("l_discount"))).alias("c"))
    abc = [F.col(x) for x in "abc"]
    parts = {"r": (255, 0, 128), "g": (64, 255, 0), "b_": (0, 32, 255)}
    rgb = scaled.select(*[pixel.blank_outside(pixel.additive_component(abc, list(p)), F.col("i")).alias(k) for k, p in parts.items()])
    return rgb.groupBy("r", "g", F.col("b_").alias("b")).agg(F.count("*").alias("n"))


@query("SELECT CAST(i AS INTEGER) AS i, round(least(255.0, greatest(0.0, 255 * pow(i / 255.0::DOUBLE, 0.45::DOUBLE))), 6) AS value FROM (SELECT unnest(range(0, 256)) AS i)")
def gamma_lut(spark, sf_dir):
    i = F.col("id").cast("int")
    return spark.range(256).select(i.alias("i"), F.round(pixel.gamma_value(i.cast("double"), 0.45), 6).alias("value"))


@query("""SELECT CASE WHEN l_extendedprice = 0 THEN 0.0 ELSE floor(l_extendedprice * pow(10.0::DOUBLE, 3 - floor(log10(l_extendedprice))) + 0.5) / pow(10.0::DOUBLE, 3 - floor(log10(l_extendedprice))) END AS value,
  count(*) AS n FROM lineitem GROUP BY 1""")
def significant_digits(spark, sf_dir):
    return table(spark, sf_dir, "lineitem").select(scalar.significant(F.col("l_extendedprice")).alias("value")).groupBy("value").agg(F.count("*").alias("n"))


@query(f"""WITH h AS (SELECT bits, sum(c) AS c FROM (SELECT CAST({SQL_MASK} AS INTEGER) AS bits, count(*) AS c FROM lineitem WHERE {SQL_INSIDE} GROUP BY 1) GROUP BY 1),
h2 AS (SELECT CAST({SQL_MASK} AS INTEGER) AS bits, count(*) AS c FROM lineitem WHERE l_linestatus = 'F' GROUP BY 1)
SELECT a.mask, a.inclusive AS pa_inclusive, a.exact AS pa_exact, b.inclusive AS npn_inclusive, b.exact AS npn_exact
FROM ({sql_combos()}) a JOIN ({sql_combos('h2')}) b ON a.mask = b.mask""")
def summary_wide_pivot(spark, sf_dir):
    """The on-screen summary: a row for each combination, a column for each metric and mode."""
    lines = table(spark, sf_dir, "lineitem")
    parts = {"pa": sampled(spark, sf_dir), "npn": lines.where(F.col("l_linestatus") == "F")}
    long = runs.union_runs({k: marker.combinations(marker.histogram(p, mask()), len(NAMES)) for k, p in parts.items()})
    wide = long.groupBy("mask").pivot("run_id", list(parts)).agg(F.first("inclusive").alias("inclusive"), F.first("exact").alias("exact"))
    return wide.select("mask", "pa_inclusive", "pa_exact", "npn_inclusive", "npn_exact")


@query("SELECT CAST(row_number() OVER (ORDER BY bit_count(m) DESC, m) AS INTEGER) AS sequence, CAST(m AS INTEGER) AS mask FROM (SELECT unnest(range(1, 16)) AS m)")
def numbered_masks(spark, sf_dir):
    hist = marker.histogram(sampled(spark, sf_dir), mask())
    return marker.numbered(marker.combinations(hist, len(NAMES))).select("sequence", "mask")
