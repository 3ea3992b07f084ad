"""Cells and compartments: an order is a cell, its 'F' lines are the nucleus and its 'O' lines the cytoplasm."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions.pixel import label_text
from ..operators import marker, objects, review, runs
from ._register import query, stored, table
from .marker_queries import NAMES, SQL_LABEL, sql_combos, sql_long

CHANNELS = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]
NUCLEUS = [26.0, 50_000.0, 0.05, 0.04]
CYTOPLASM = [25.0, 48_000.0, 0.05, 0.04]
AREA_MM2 = 2.5


def means(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem")
    return objects.compartment_means(lines, "l_orderkey", F.col("l_linestatus") == "F", F.col("l_linestatus") == "O", CHANNELS)


def cells(spark: SparkSession, sf_dir: str, in_order: bool = False) -> DataFrame:
    """A row for each order: envelope of its lines, pixels and means of its compartments; one pass over lineitem and one join.

    in_order: a cell's lines are added up as they are stored. Sums of doubles depend on their order, and many means
    lie at a threshold, so that otherwise the split of the files decides on which side.
    """
    nucleus, cytoplasm = F.col("l_linestatus") == "F", F.col("l_linestatus") == "O"
    sums = {"lines": F.count("*"), "low_x": F.min("l_partkey"), "high_n": F.max("l_linenumber"), "nucleus_pixels": F.count_if(nucleus), "cytoplasm_pixels": F.count_if(cytoplasm)}
    sums |= {f"{ch}_{p}": F.avg(F.when(c, F.col(ch))) for ch in CHANNELS for p, c in (("nucleus", nucleus), ("cytoplasm", cytoplasm))}
    key = F.col("l_orderkey").alias("o_orderkey")
    if in_order:
        lines, w = stored(spark, sf_dir, "lineitem"), Window.partitionBy("l_orderkey").orderBy("file", "row")
        upto = w.rowsBetween(Window.unboundedPreceding, Window.currentRow)
        per = lines.select(key, F.lead(F.lit(True)).over(w).alias("more"), *[s.over(upto).alias(n) for n, s in sums.items()]).where("more IS NULL").drop("more")
    else:
        per = table(spark, sf_dir, "lineitem").groupBy(key).agg(*[s.alias(n) for n, s in sums.items()])
    return table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderstatus", "o_orderpriority", "o_totalprice").join(per, "o_orderkey", "left")


def reason():
    """Eligibility, then measurement: the first failure of a cell."""
    c = F.col
    eligibility = objects.first_failure(objects.ELIGIBILITY, {
        "missing_cell_roi": c("lines").isNull(), "different_image_plane": c("o_orderstatus") == "P",
        "cell_outside_image": c("high_n") > 6, "cell_not_fully_inside_roi": c("low_x") < 20})
    return F.coalesce(eligibility, objects.measurement_failure(c("nucleus_pixels"), c("cytoplasm_pixels")))


SQL_CELLS = """cells AS (SELECT o.o_orderkey, o_custkey, o_orderstatus, o_orderpriority, o_totalprice, p.* EXCLUDE (k) FROM orders o LEFT JOIN (
  SELECT l_orderkey AS k, count(*) AS lines, min(l_partkey) AS low_x, max(l_linenumber) AS high_n,
   count(*) FILTER (l_linestatus = 'F') AS nucleus_pixels, count(*) FILTER (l_linestatus = 'O') AS cytoplasm_pixels,
   """ + ", ".join(f"avg({ch}) FILTER (l_linestatus = '{s}') AS {ch}_{p}" for ch in CHANNELS for p, s in (("nucleus", "F"), ("cytoplasm", "O"))) + """
  FROM lineitem GROUP BY 1) p ON o.o_orderkey = p.k)"""
SQL_REASON = """CASE WHEN lines IS NULL THEN 'missing_cell_roi' WHEN o_orderstatus = 'P' THEN 'different_image_plane' WHEN high_n > 6 THEN 'cell_outside_image'
  WHEN low_x < 20 THEN 'cell_not_fully_inside_roi' WHEN nucleus_pixels = 0 AND cytoplasm_pixels = 0 THEN 'no_valid_compartment_pixels'
  WHEN nucleus_pixels = 0 THEN 'no_valid_nucleus_pixels' WHEN cytoplasm_pixels = 0 THEN 'no_valid_cytoplasm_pixels' END"""


def _sql_bits(part: str, ts: list[float]) -> str:
    return "(" + " + ".join(f"CASE WHEN {c}_{part} >= {t} THEN {1 << j} ELSE 0 END" for j, (c, t) in enumerate(zip(CHANNELS, ts, strict=True))) + ")"


SQL_MASKS = f"""masks AS (SELECT *, CAST({_sql_bits('nucleus', NUCLEUS)} AS INTEGER) AS npn, CAST({_sql_bits('cytoplasm', CYTOPLASM)} AS INTEGER) AS cpn FROM cells WHERE ({SQL_REASON}) IS NULL),
hists AS (SELECT 'NPN' AS metric, npn AS bits, count(*) AS c FROM masks GROUP BY npn UNION ALL SELECT 'CPN', cpn, count(*) FROM masks GROUP BY cpn
  UNION ALL SELECT 'PN', npn | cpn, count(*) FROM masks GROUP BY npn | cpn)"""


def measured(spark: SparkSession, sf_dir: str) -> DataFrame:
    good = cells(spark, sf_dir, in_order=True).where(reason().isNull())
    return objects.phenotype_masks(good, CHANNELS, NUCLEUS, CYTOPLASM)


def histograms(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(metric, mask, n): the three histograms from one pass over the cells."""
    three = F.explode(F.array(*[F.struct(F.lit(m.upper()).alias("metric"), F.col(m).alias("mask")) for m in ("npn", "cpn", "pn")]))
    rows = measured(spark, sf_dir).select(three.alias("s")).select("s.*")
    return rows.groupBy("metric", "mask").agg(F.count("*").alias("n"))


@query(f"""WITH {SQL_CELLS} SELECT o_orderkey, coalesce(nucleus_pixels, 0) AS nucleus_pixels, coalesce(cytoplasm_pixels, 0) AS cytoplasm_pixels,
  {', '.join(f"round({c}_{p}, 6) AS {c}_{p}" for c in CHANNELS for p in ('nucleus', 'cytoplasm'))} FROM cells""")
def cell_compartment_means(spark, sf_dir):
    own = means(spark, sf_dir).withColumnRenamed("l_orderkey", "o_orderkey")
    joined = table(spark, sf_dir, "orders").select("o_orderkey").join(own, "o_orderkey", "left")
    return joined.select("o_orderkey", *[F.coalesce(c, F.lit(0)).alias(c) for c in ("nucleus_pixels", "cytoplasm_pixels")],
                         *[F.round(f"{c}_{p}", 6).alias(f"{c}_{p}") for c in CHANNELS for p in ("nucleus", "cytoplasm")])


@query(f"WITH {SQL_CELLS}, {SQL_MASKS} SELECT metric, CAST(bits AS INTEGER) AS mask, c AS n FROM hists")
def cell_npn_cpn_pn(spark, sf_dir):
    return histograms(spark, sf_dir)


@query(f"WITH {SQL_CELLS} SELECT coalesce({SQL_REASON}, 'measured') AS reason, count(*) AS n FROM cells GROUP BY 1")
def cell_eligibility_reasons(spark, sf_dir):
    return review.first_reasons(cells(spark, sf_dir).select(F.coalesce(reason(), F.lit("measured")).alias("reason")), "reason")


_LONGS = " UNION ALL ".join(f"SELECT * FROM ({sql_long(f'k_{m}', m.upper(), 'all_eligible_cells', str(AREA_MM2))})" for m in ("npn", "cpn", "pn"))
_KS = ", ".join(f"h_{m} AS (SELECT bits, c FROM hists WHERE metric = '{m.upper()}'), k_{m} AS ({sql_combos(f'h_{m}')})" for m in ("npn", "cpn", "pn"))


@query(f"WITH {SQL_CELLS}, {SQL_MASKS}, {_KS} SELECT * REPLACE (round(ratio, 12) AS ratio, round(density_per_mm2, 9) AS density_per_mm2) FROM ({_LONGS})")
def cell_combinations_long(spark, sf_dir):
    counts = marker.combinations(histograms(spark, sf_dir), len(NAMES), "metric")
    rows = marker.long_table(counts.withColumnRenamed("metric", "kind"), NAMES, "cells", "all_eligible_cells", AREA_MM2, "kind")
    rows = rows.withColumn("metric", F.col("kind")).drop("kind")
    return rows.withColumns({"ratio": F.round("ratio", 12), "density_per_mm2": F.round("density_per_mm2", 9)})


@query(f"""WITH {SQL_CELLS}, n AS (SELECT *, CASE WHEN coalesce(nucleus_pixels, 0) = 0 THEN 'missing_nucleus_roi' WHEN o_orderstatus = 'P' THEN 'different_image_plane'
  WHEN high_n > 6 THEN 'nucleus_outside_image' END AS why FROM cells), h AS (SELECT CAST({_sql_bits('nucleus', NUCLEUS)} AS INTEGER) AS bits, count(*) AS c FROM n WHERE why IS NULL GROUP BY 1)
SELECT {SQL_LABEL} AS combination, * FROM ({sql_combos()})""")
def nuclear_population(spark, sf_dir):
    """Nuclei are a population of their own: also those of cells that aren't eligible."""
    c = F.col
    why = objects.first_failure(objects.NUCLEAR, {
        "missing_nucleus_roi": F.coalesce("nucleus_pixels", F.lit(0)) == 0, "different_image_plane": c("o_orderstatus") == "P", "nucleus_outside_image": c("high_n") > 6})
    nuclei = objects.phenotype_masks(cells(spark, sf_dir, in_order=True).where(why.isNull()), CHANNELS, NUCLEUS, CYTOPLASM)
    counts = marker.combinations(marker.histogram(nuclei, c("npn")), len(NAMES))
    return counts.select(label_text(c("mask"), NAMES).alias("combination"), "*")


@query(f"""WITH {SQL_CELLS}, s AS (SELECT count(*) AS proposed, count(*) FILTER (({SQL_REASON}) IS NULL) AS measured, count(*) FILTER (({SQL_REASON}) IS NOT NULL) AS rejected FROM cells)
SELECT *, CASE WHEN proposed > 0 THEN measured / CAST(proposed AS DOUBLE) END AS fraction,
  CASE WHEN proposed = 0 THEN 'no_cell_candidates' WHEN rejected > 0 THEN 'review_exclusions' ELSE 'all_candidates_measurable' END AS status FROM s""")
def measurement_coverage(spark, sf_dir):
    why = cells(spark, sf_dir).select(reason().alias("why"))
    sums = why.agg(F.count("*").alias("proposed"), F.count_if(F.col("why").isNull()).alias("measured"), F.count_if(F.col("why").isNotNull()).alias("rejected"))
    return sums.withColumn("c", objects.coverage(F.col("proposed"), F.col("measured"), F.col("rejected"))).select("proposed", "measured", "rejected", "c.*")


@query(f"WITH {SQL_CELLS} SELECT o_orderkey FROM cells WHERE ({SQL_REASON}) IS NOT NULL")
def rejected_antijoin(spark, sf_dir):
    good = cells(spark, sf_dir).where(reason().isNull())
    return objects.rejected(table(spark, sf_dir, "orders").select("o_orderkey"), good, "o_orderkey")


@query("""WITH r AS (SELECT l_orderkey AS k, count(*) AS n, min(l_linenumber) AS a FROM lineitem GROUP BY 1)
SELECT coalesce(o_orderkey, k) AS key, CASE WHEN k IS NULL THEN 'left_only' WHEN o_orderkey IS NULL THEN 'right_only' ELSE 'disagrees' END AS problem
FROM orders FULL OUTER JOIN r ON o_orderkey = k WHERE k IS NULL OR o_orderkey IS NULL OR NOT (n >= 2 AND a <= 5)""")
def history_full_outer_check(spark, sf_dir):
    left = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("key"))
    right = table(spark, sf_dir, "lineitem").groupBy(F.col("l_orderkey").alias("key")).agg(F.count("*").alias("n"), F.min("l_linenumber").alias("a"))
    return runs.reconcile(left, right, "key", lambda: (F.col("n") >= 2) & (F.col("a") <= 5))


@query("""SELECT o_custkey AS pair, max(o_totalprice) FILTER (o_orderstatus = 'F') AS cell, max(o_totalprice) FILTER (o_orderstatus = 'O') AS nucleus,
  count(*) FILTER (o_orderstatus = 'F') > 1 OR count(*) FILTER (o_orderstatus = 'O') > 1 AS duplicate FROM orders WHERE o_orderstatus IN ('F', 'O') GROUP BY 1""")
def review_pair_pivot(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").where(F.col("o_orderstatus").isin("F", "O"))
    rows = orders.select(F.col("o_custkey").alias("pair"), F.when(F.col("o_orderstatus") == "F", "cell").otherwise("nucleus").alias("compartment"), F.col("o_totalprice").alias("v"))
    return review.pair_compartments(rows, "pair", "compartment", "v")


@query("""WITH RECURSIVE e AS (SELECT 'r' || r_regionkey AS node, CAST(NULL AS VARCHAR) AS parent FROM region UNION ALL SELECT 'n' || n_nationkey, 'r' || n_regionkey FROM nation
  UNION ALL SELECT 's' || s_suppkey, 'n' || s_nationkey FROM supplier),
w(node, root, depth) AS (SELECT node, node, 0 FROM e WHERE parent IS NULL UNION ALL SELECT e.node, w.root, w.depth + 1 FROM e JOIN w ON e.parent = w.node)
SELECT node, root, CAST(depth AS INTEGER) AS depth FROM w""")
def review_tree_owner(spark, sf_dir):
    tag = lambda t, k: F.concat(F.lit(t), F.col(k).cast("string"))
    edges = table(spark, sf_dir, "region").select(tag("r", "r_regionkey").alias("node"), F.lit(None).cast("string").alias("parent"))
    edges = edges.union(table(spark, sf_dir, "nation").select(tag("n", "n_nationkey"), tag("r", "n_regionkey")))
    edges = edges.union(table(spark, sf_dir, "supplier").select(tag("s", "s_suppkey"), tag("n", "s_nationkey")))
    return review.owners(edges)


@query("""WITH r AS (SELECT o_custkey, o_orderkey FROM orders)
SELECT o_custkey, o_orderkey, coalesce(lag(o_orderkey) OVER w, last_value(o_orderkey) OVER f) AS previous, coalesce(lead(o_orderkey) OVER w, first_value(o_orderkey) OVER f) AS next FROM r
WINDOW w AS (PARTITION BY o_custkey ORDER BY o_orderkey), f AS (PARTITION BY o_custkey ORDER BY o_orderkey ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING)""")
def circular_navigation(spark, sf_dir):
    rows = table(spark, sf_dir, "orders").select("o_custkey", "o_orderkey")
    return review.circular_neighbours(rows, "o_custkey", "o_orderkey")


@query(f"""WITH {SQL_CELLS} SELECT a.o_orderkey AS pair, min(b.o_orderkey) AS candidate, count(*) AS candidates FROM cells a JOIN cells b ON a.o_custkey = b.o_custkey
WHERE coalesce(a.nucleus_pixels, 0) = 0 AND b.nucleus_pixels > 0 AND b.low_x >= a.low_x AND b.o_totalprice < a.o_totalprice GROUP BY 1""")
def missing_nucleus_repair(spark, sf_dir):
    """For each cell without a nucleus: the nuclei of its owner that would fit inside it."""
    own = cells(spark, sf_dir)
    pairs = own.select(F.col("o_orderkey").alias("pair"), F.col("o_custkey").alias("owner"), F.when(F.col("nucleus_pixels") > 0, F.col("o_orderkey")).alias("nucleus"),
                       F.col("low_x").alias("ox"), F.col("o_totalprice").alias("area"))
    offered = own.where(F.col("nucleus_pixels") > 0).select(F.col("o_orderkey").alias("candidate"), F.col("o_custkey").alias("owner"), F.col("low_x").alias("ix"), F.col("o_totalprice").alias("inner_area"))
    found = review.repair_missing(pairs, offered, (F.col("ix") >= F.col("ox")) & (F.col("inner_area") < F.col("area")))
    return found.groupBy("pair").agg(F.min("candidate").alias("candidate"), F.count("*").alias("candidates"))
