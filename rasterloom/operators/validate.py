"""Checks of what was read back: tables of nuclei and cells, journals, figures, snapshots, audits."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import geometry
from .batch import STATES
from .runs import duplicate_keys, violations


def nuclear_problems(rows: DataFrame, names: list[str], population: Column) -> DataFrame:
    """(mask, problem) of a table of nuclear combinations; empty means it agrees with itself.

    The exact counts may not exceed the population together, inclusive counts are the sums of the exact
    ones over supersets, and a conditional denominator is its marker's inclusive count. The table has a
    bounded number of rows (255 masks), so it is joined with itself.
    """
    top, c = (1 << len(names)) - 1, F.col
    overall = rows.where(c("denominator_type") == "all_measured_nuclei")
    exact = overall.where(c("mode") == "exact").select(c("mask").alias("s"), c("numerator").alias("n"))
    sums = exact.withColumn("mask", F.explode(F.sequence(F.lit(1), F.lit(top)))).groupBy("mask").agg(
        F.coalesce(F.sum(F.when(c("s").bitwiseAND(c("mask")) == c("mask"), c("n"))), F.lit(0)).alias("inclusive"), F.max(F.when(c("s") == c("mask"), c("n"))).alias("exact"))
    bit = F.coalesce(*[F.when(c("denominator_type") == f"positive:{n}", F.lit(1 << j)) for j, n in enumerate(names)])
    single = overall.where(c("mode") == "inclusive").select(c("mask").alias("bit"), c("numerator").alias("marker_count"))
    both = rows.withColumn("bit", bit).join(sums, "mask", "left").join(single, "bit", "left")
    wanted = F.when(c("mode") == "exact", c("exact")).otherwise(c("inclusive"))
    problem = F.when(~F.coalesce(c("numerator") == wanted, F.lit(False)), "inconsistent_counts").when(
        c("bit").isNotNull() & ~F.coalesce(c("denominator") == c("marker_count"), F.lit(False)), "conditional_denominator")
    over = exact.agg(F.sum("n").alias("n")).where(c("n") > population).select(F.lit(0).alias("mask"), F.lit("exact_over_population").alias("problem"))
    return both.select(c("mask").cast("int").alias("mask"), problem.alias("problem")).where("problem IS NOT NULL").distinct().unionByName(over)


def cell_problems(cells: DataFrame, markers: int, means: list[str]) -> DataFrame:
    """(rule, key) for cells (cell_id, x, y, nucleus_pixels, cytoplasm_pixels, npn, cpn, pn, means) that can't be results."""
    c, top = F.col, (1 << markers) - 1
    finite = lambda v: ~F.isnan(c(v)) & (F.abs(c(v)) < float("inf"))
    rules = [("masks_in_range", c("npn").between(0, top) & c("cpn").between(0, top) & c("pn").between(0, top)), ("pn_is_either", c("pn") == c("npn").bitwiseOR(c("cpn"))),
             ("compartments_have_pixels", (c("nucleus_pixels") >= 1) & (c("cytoplasm_pixels") >= 1)), ("id_not_blank", F.btrim("cell_id") != "")]
    rules += [("finite_numbers", F.forall(F.array(*[finite(v) for v in ("x", "y", *means)]), lambda v: F.coalesce(v, F.lit(False))))]
    again = duplicate_keys(cells, "cell_id").select(c("cell_id").cast("string").alias("key"), F.lit("unique_id").alias("rule"))
    return violations(cells, c("cell_id"), rules).unionByName(again)


def snapshot_problems(first: DataFrame, second: DataFrame) -> DataFrame:
    """(path, problem) where files (path, content) read twice differ: publishing has to stop."""
    from .runs import receipt, receipt_differences

    return receipt_differences(*(receipt(x, F.col("path"), F.col("content")) for x in (first, second)))


def journal_problems(attempts: DataFrame, plan: DataFrame) -> DataFrame:
    """(task, problem) of journal attempts (task, directory, status) against the planned tasks."""
    c = F.col
    known = attempts.join(plan.select("task", F.lit(True).alias("planned")), "task", "left")
    problem = F.when(c("planned").isNull(), "unknown_task").when(~F.coalesce(c("directory").rlike("^attempt-[a-f0-9-]{36}$"), F.lit(False)), "directory").when(
        ~F.coalesce(c("status").isin(*STATES), F.lit(False)), "status")
    return known.select("task", problem.alias("problem")).where("problem IS NOT NULL")


def plan_differences(planned: DataFrame, journal: DataFrame) -> DataFrame:
    """Items (with all their columns) of the plan that the journal lacks, or the reverse; side says which."""
    return planned.exceptAll(journal).withColumn("side", F.lit("planned")).unionByName(journal.exceptAll(planned).withColumn("side", F.lit("journal")))


def figure_problems(figures: DataFrame, runs_: DataFrame) -> DataFrame:
    """(run, problem): the first reason why a figure can't stand beside its run; null where it can.

    figures: run, manifest_sha256, found_manifest_sha256, roi_sha256, found_roi_sha256, roi, image, z, t, status, file,
    file_sha256, found_file_sha256, width, height; runs_: run, run_roi, run_image, run_z, run_t.
    """
    c = F.col
    both = figures.join(runs_, "run", "left")
    checks = [("no_run", c("run_roi").isNotNull()), ("manifest_changed", c("manifest_sha256") == c("found_manifest_sha256")), ("roi_changed", c("roi_sha256") == c("found_roi_sha256")),
              ("roi_differs", (c("roi") == c("run_roi")) & (c("z") == c("run_z")) & (c("t") == c("run_t"))), ("image_differs", c("image") == c("run_image")), ("not_complete", c("status") == "complete"),
              ("file_name", c("file").rlike(r"^[0-9]{3}-mask-[0-9]+-figure\.png$")), ("file_changed", c("file_sha256") == c("found_file_sha256")),
              ("size", (c("width") >= 1) & (c("height") >= 1) & (c("width").cast("long") * c("height") <= MAX_FIGURE_PIXELS))]
    return both.select("run", F.coalesce(*[F.when(~F.coalesce(ok, F.lit(False)), F.lit(name)) for name, ok in checks]).alias("problem"))


#: Fixed value: the largest figure of a report, in pixels.
MAX_FIGURE_PIXELS = 8_388_608


def output_audit(objects: DataFrame) -> DataFrame:
    """One row of counts over objects (kind, cell, nucleus: rings): what a segmentation gave, before anything is repaired."""
    own = F.col("kind") == "cell"
    count = lambda what, name: F.count_if(own & what).alias(name)
    return objects.withColumn("equal", geometry.same_area("cell", "nucleus")).agg(
        F.count("*").alias("objects"), F.count_if(own).alias("cell_objects"), count(F.col("cell").isNull(), "missing_cell"), count(F.col("nucleus").isNull(), "missing_nucleus"),
        count(F.coalesce("equal", F.lit(False)), "equal_compartments"))
