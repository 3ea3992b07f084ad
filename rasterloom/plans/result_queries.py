"""One analysis over lineitem as a raster and suppliers as cells: its published tables, read back, and checks of them."""

from __future__ import annotations

import tempfile
import uuid
from functools import lru_cache

from pyspark.sql import functions as F

from ..model import Marker, Profile, Region
from ..operators import results, runs, validate
from ..sources import tables
from ._register import query, table
from .marker_queries import sql_combos, sql_long

PROFILE = Profile(0, (Marker(0, "quantity", 30, 25.0003, 25.0003), Marker(1, "extendedprice", 50_000, 38_000.0003, 36_000.0003), Marker(2, "discount", 0.07, 0.0500003, 0.0500003), Marker(3, "tax", 0.06, 0.0400003, 0.0400003)))
REGION = Region(((20, 0, 1900, 90),), ((600, 0, 700, 90),))
IMAGE = results.Image(1980, 100, (0.5, 0.75))

#: A cell is a rectangle, its nucleus one inside it; some lack a ring, leave the image or the region, or have a nucleus that sticks out.
_CELLS = """c AS (SELECT s_suppkey AS id, (s_suppkey * 613) % 1960 AS x0, (s_suppkey * 7) % 84 AS y0, 60 + s_suppkey % 20 AS w, 12 AS h, CASE WHEN s_suppkey % 17 = 3 THEN 70 ELSE 30 END AS nw FROM supplier),
j AS (SELECT *, CASE WHEN id % 13 = 1 THEN 'missing_cell_roi' WHEN id % 11 = 2 THEN 'missing_nucleus_roi' WHEN x0 + w > 1980 OR y0 + h > 100 THEN 'cell_outside_image'
  WHEN x0 < 20 OR x0 + w > 1900 OR y0 + h > 90 OR (x0 < 700 AND x0 + w > 600) THEN 'cell_not_fully_inside_roi' WHEN 4 + nw > w THEN 'nucleus_not_inside_cell' END AS reason,
  CASE WHEN id % 11 = 2 THEN 'missing_nucleus_roi' WHEN x0 + 4 + nw > 1980 OR y0 + 10 > 100 THEN 'nucleus_outside_image'
  WHEN x0 + 4 < 20 OR x0 + 4 + nw > 1900 OR y0 + 10 > 90 OR (x0 + 4 < 700 AND x0 + 4 + nw > 600) THEN 'nucleus_not_fully_inside_roi' END AS own FROM c),
p AS (SELECT l_partkey + 0.5 AS x, l_suppkey + 0.5 AS y, l_quantity, l_extendedprice, l_discount, l_tax FROM lineitem),
n AS (SELECT *, x >= x0 + 4 AND x < x0 + 4 + nw AND y >= y0 + 2 AND y < y0 + 10 AS nuc FROM j JOIN p ON reason IS NULL AND x >= x0 AND x < x0 + w AND y >= y0 AND y < y0 + h),
m AS (SELECT id, count(*) FILTER (nuc) AS np, count(*) FILTER (NOT nuc) AS cp, """ + ", ".join(f"avg(l_{m.name}) FILTER (nuc) AS {m.name}_n, avg(l_{m.name}) FILTER (NOT nuc) AS {m.name}_c" for m in PROFILE.markers) + """ FROM n GROUP BY id),
k AS (SELECT *, CAST(""" + " + ".join(f"CASE WHEN {m.name}_n >= {m.nucleus} THEN {1 << j} ELSE 0 END" for j, m in enumerate(PROFILE.markers)) + """ AS INTEGER) AS npn, CAST(""" + " + ".join(
    f"CASE WHEN {m.name}_c >= {m.cytoplasm} THEN {1 << j} ELSE 0 END" for j, m in enumerate(PROFILE.markers)) + """ AS INTEGER) AS cpn FROM m WHERE np > 0 AND cp > 0),
u AS (SELECT id, count(*) AS np, """ + ", ".join(f"avg(l_{m.name}) AS {m.name}_n" for m in PROFILE.markers) + """ FROM j JOIN p ON (reason IS NULL OR own IS NULL) AND id % 11 <> 2 AND x >= x0 + 4 AND x < x0 + 4 + nw AND y >= y0 + 2 AND y < y0 + 10 GROUP BY id),
v AS (SELECT *, CAST(""" + " + ".join(f"CASE WHEN {m.name}_n >= {m.nucleus} THEN {1 << j} ELSE 0 END" for j, m in enumerate(PROFILE.markers)) + " AS INTEGER) AS mask FROM u)"
_HISTS = "h0 AS (SELECT CAST(" + " + ".join(f"CASE WHEN l_{m.name} >= {m.pixel} THEN {1 << j} ELSE 0 END" for j, m in enumerate(PROFILE.markers)) + """ AS INTEGER) AS bits, count(*) AS c FROM p
  WHERE x >= 20 AND x < 1900 AND y >= 0 AND y < 90 AND NOT (x >= 600 AND x < 700) GROUP BY 1), z AS (SELECT 0 AS bits, 0 AS c),
h1 AS (SELECT npn AS bits, count(*) AS c FROM k GROUP BY 1 UNION ALL FROM z), h2 AS (SELECT cpn AS bits, count(*) AS c FROM k GROUP BY 1 UNION ALL FROM z),
h3 AS (SELECT npn | cpn AS bits, count(*) AS c FROM k GROUP BY 1 UNION ALL FROM z), h4 AS (SELECT mask AS bits, count(*) AS c FROM v GROUP BY 1 UNION ALL FROM z)"""


def _cells(spark, sf_dir):
    k, c = F.col("s_suppkey"), F.col
    ring = lambda x, y, w, h: F.array(*[F.struct(a.cast("double").alias("x"), b.cast("double").alias("y")) for a, b in ((x, y), (x + w, y), (x + w, y + h), (x, y + h))])
    rows = table(spark, sf_dir, "supplier").select(k.alias("id"), (k * 613 % 1960).alias("x0"), (k * 7 % 84).alias("y0"), (60 + k % 20).alias("w"), F.when(k % 17 == 3, 70).otherwise(30).alias("nw"))
    cell, nucleus = ring(c("x0"), c("y0"), c("w"), F.lit(12)), ring(c("x0") + 4, c("y0") + 2, c("nw"), F.lit(8))
    return rows.select(F.concat(F.lit("=cell "), c("id").cast("string")).alias("cell_id"), c("id").alias("ord"), F.when(c("id") % 13 != 1, cell).alias("cell"), F.when(c("id") % 11 != 2, nucleus).alias("nucleus"))


def analysis(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem")
    pixels = lines.select((F.col("l_partkey") + 0.5).alias("x"), (F.col("l_suppkey") + 0.5).alias("y"), *[F.col(f"l_{m.name}").alias(m.name) for m in PROFILE.markers])
    return results.analyze(pixels, REGION, PROFILE, _cells(spark, sf_dir), IMAGE)


def _scratch(spark) -> str:
    named = spark.conf.get("spark.checkpoint.dir", None)
    if not named and not spark.conf.get("spark.master", "").startswith("local"):
        raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
    return (named or f"file://{tempfile.gettempdir()}/rasterloom-runs").rstrip("/")


@lru_cache(maxsize=8)
def _saved(session: str, spark, sf_dir: str) -> str:
    path = f"{_scratch(spark)}/rasterloom-run-{uuid.uuid4().hex}"
    results.save(analysis(spark, sf_dir), path, "lineitem", "2024-01-01T00:00:00Z")
    return path


def saved(spark, sf_dir: str) -> str:
    """The run of these tables, written once a session."""
    return _saved(spark.sparkContext.applicationId, spark, sf_dir)


def _number(name: str, digits: int, add: float = 0.0):
    """Rounded; ``add`` moves means that lie half-way off the edge."""
    return F.round(F.col(f"`{name}`").cast("double") + add, digits).alias(name.replace(":", "_"))


def _combinations(rows):
    return rows.select("combination", F.col("mask").cast("int").alias("mask"), "mode", "metric", F.col("numerator").cast("long").alias("numerator"), "denominator_type",
                       F.col("denominator").cast("long").alias("denominator"), *[_number(n, d) for n, d in (("ratio", 7), ("density_per_mm2", 5), ("positive_area_mm2", 7))])


_MM2 = "((SELECT sum(c) FROM h0) * 0.5 * 0.75 / 1e6)"
_ROUNDED = "SELECT * REPLACE (round(ratio, 7) AS ratio, round(density_per_mm2, 5) AS density_per_mm2, round(positive_area_mm2, 7) AS positive_area_mm2) FROM"


def _sql_tables(pairs) -> str:
    return " UNION ALL ".join(f"SELECT * FROM ({sql_long(k, metric, overall, _MM2)})" for k, metric, overall in pairs)


@query(f"WITH {_CELLS}, {_HISTS}, " + ", ".join(f"k{j} AS ({sql_combos(f'h{j}')})" for j in range(4)) + f" {_ROUNDED} (" + _sql_tables(
    [("k0", "PA", "all_sampled_roi_pixels"), ("k1", "NPN", "all_eligible_cells"), ("k2", "CPN", "all_eligible_cells"), ("k3", "PN", "all_eligible_cells")]) + ")")
def published_combinations(spark, sf_dir):
    return _combinations(results.read_table(spark, f"{saved(spark, sf_dir)}/combinations.csv"))


@query(f"WITH {_CELLS}, {_HISTS}, k4 AS ({sql_combos('h4')}) {_ROUNDED} (" + _sql_tables([("k4", "NPN_NUCLEUS_ONLY", "all_measured_nuclei")]) + ")")
def published_nuclear_combinations(spark, sf_dir):
    return _combinations(results.read_table(spark, f"{saved(spark, sf_dir)}/nuclear-combinations.csv"))


@query(f"""WITH {_CELLS} SELECT '''=cell ' || id AS cell_id, round(x0 + w / 2, 6) AS x, round(y0 + 6.0::DOUBLE, 6) AS y, np AS nucleus_pixels, cp AS cytoplasm_pixels, npn, cpn, npn | cpn AS pn, {', '.join(f'round({m.name}_{p} + 1e-7, 4) AS {m.name}_{w}_mean' for m in PROFILE.markers for p, w in (('n', 'nucleus'), ('c', 'cytoplasm')))}
FROM k JOIN c USING (id)""")
def published_cells(spark, sf_dir):
    c = F.col
    rows = results.read_table(spark, f"{saved(spark, sf_dir)}/cells.csv")
    return rows.select("cell_id", F.round(c("x_source_px").cast("double"), 6).alias("x"), F.round(c("y_source_px").cast("double"), 6).alias("y"), c("nucleus_sample_pixels").cast("long").alias("nucleus_pixels"),
                       c("cytoplasm_sample_pixels").cast("long").alias("cytoplasm_pixels"), *[c(f"{n.upper()}_mask").cast("int").alias(n) for n in ("npn", "cpn", "pn")],
                       *[_number(f"{m.name}:{p}_mean", 4, 1e-7) for m in PROFILE.markers for p in ("nucleus", "cytoplasm")])


@query(f"""WITH {_CELLS} SELECT '''=cell ' || id AS cell_id, 'eligibility' AS stage, reason AS first_failure_reason FROM j WHERE reason IS NOT NULL
UNION ALL SELECT '''=cell ' || id, 'measurement', CASE WHEN coalesce(np, 0) = 0 AND coalesce(cp, 0) = 0 THEN 'no_valid_compartment_pixels' WHEN np = 0 THEN 'no_valid_nucleus_pixels' ELSE 'no_valid_cytoplasm_pixels' END
FROM j LEFT JOIN m USING (id) WHERE reason IS NULL AND (coalesce(np, 0) = 0 OR coalesce(cp, 0) = 0)""")
def published_excluded_cells(spark, sf_dir):
    return results.read_table(spark, f"{saved(spark, sf_dir)}/excluded-cells.csv")


@query(f"""WITH {_CELLS} SELECT '''=cell ' || id AS cell_id, np AS nucleus_pixels, mask, {', '.join(f'round({m.name}_n + 1e-7, 4) AS {m.name}_nucleus_mean' for m in PROFILE.markers)} FROM v""")
def published_nuclei(spark, sf_dir):
    c = F.col
    rows = results.read_table(spark, f"{saved(spark, sf_dir)}/nuclei.csv")
    return rows.select("cell_id", c("nucleus_sample_pixels").cast("long").alias("nucleus_pixels"), c("NPN_nucleus_only_mask").cast("int").alias("mask"), *[_number(f"{m.name}:nucleus_mean", 4, 1e-7) for m in PROFILE.markers])


@query(f"""WITH {_CELLS} SELECT '''=cell ' || id AS cell_id, own AS first_failure_reason FROM j WHERE reason IS NOT NULL AND own IS NOT NULL
UNION ALL SELECT '''=cell ' || id, 'no_valid_nucleus_pixels' FROM j WHERE (reason IS NULL OR own IS NULL) AND id % 11 <> 2 AND id NOT IN (SELECT id FROM u)""")
def published_excluded_nuclei(spark, sf_dir):
    return results.read_table(spark, f"{saved(spark, sf_dir)}/excluded-nuclei.csv")


@query("SELECT 'lineitem' AS image, 'complete' AS status, CAST(0 AS BIGINT) AS nuclear_problems, CAST(0 AS BIGINT) AS cell_problems, true AS proposed_is_all")
def published_run_checks(spark, sf_dir):
    """The catalogue takes the run, its nuclear table agrees with itself, and its cells can be results."""
    path = saved(spark, sf_dir)
    accepted, _ = tables.scan_catalogue(spark, path)
    names = [m.name for m in PROFILE.markers]
    nuclear = _combinations(results.read_table(spark, f"{path}/nuclear-combinations.csv"))
    population = results.read_table(spark, f"{path}/nuclei.csv").count()
    cells = published_cells(spark, sf_dir)
    bad = validate.nuclear_problems(nuclear, names, F.lit(population)).agg(F.count("*").alias("nuclear_problems"))
    worse = validate.cell_problems(cells, len(names), [f"{n}_nucleus_mean" for n in names]).agg(F.count("*").alias("cell_problems"))
    return accepted.select(F.col("imageName").alias("image"), "status", (F.col("counts")["proposed"] == table(spark, sf_dir, "supplier").count()).alias("proposed_is_all"), F.lit(1).alias("one")).join(
        bad.withColumn("one", F.lit(1)), "one").join(worse.withColumn("one", F.lit(1)), "one").drop("one")
