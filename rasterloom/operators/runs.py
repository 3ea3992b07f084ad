"""Published runs: all-or-nothing output, seals, constraint checks, reconciliation."""

from __future__ import annotations

from collections.abc import Callable
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.pixel import label_text


def _fs(spark: SparkSession, path: str):
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop.getFileSystem(spark._jsc.hadoopConfiguration()), hadoop


def publish(spark: SparkSession, path: str, tables: dict[str, DataFrame], manifest: DataFrame) -> None:
    """Write tables, then the manifest, under a marker that goes last; an existing output is refused."""
    fs, root = _fs(spark, path)
    if fs.exists(root):
        raise FileExistsError(path)
    marker = _fs(spark, f"{path}/INCOMPLETE")[1]
    fs.create(marker).close()
    for name, df in tables.items():
        df.write.mode("errorifexists").parquet(f"{path}/{name}")
    manifest.coalesce(1).write.mode("errorifexists").json(f"{path}/manifest")
    fs.delete(marker, False)


@contextmanager
def publishing(spark: SparkSession, path: str):
    """Gives a function that writes a table of lines by name; the marker goes when all are there, and stays after a failure."""
    fs, root = _fs(spark, path)
    if fs.exists(root):
        raise FileExistsError(path)
    marker = _fs(spark, f"{path}/INCOMPLETE")[1]
    fs.create(marker).close()
    yield lambda name, lines: lines.write.mode("errorifexists").text(f"{path}/{name}")
    fs.delete(marker, False)


def is_published(spark: SparkSession, path: str) -> bool:
    fs, root = _fs(spark, path)
    return fs.exists(root) and not fs.exists(_fs(spark, f"{path}/INCOMPLETE")[1]) and fs.exists(_fs(spark, f"{path}/manifest/_SUCCESS")[1])


def replace_file(spark: SparkSession, path: str, text: str) -> None:
    """Replace a small file, a journal for one, as a whole: written beside it, made durable, then renamed over it."""
    import uuid

    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    at = jvm.org.apache.hadoop.fs.Path(path)
    beside = jvm.org.apache.hadoop.fs.Path(f"{path}.{uuid.uuid4().hex}.tmp")
    out = at.getFileSystem(conf).create(beside)
    out.write(bytearray(text.encode("utf-8")))
    out.hsync()
    out.close()
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(at.toUri(), conf)
    options = spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 1)
    options[0] = jvm.org.apache.hadoop.fs.Options.Rename.OVERWRITE
    context.rename(context.makeQualified(beside), context.makeQualified(at), options)


def receipt(files: DataFrame, path: Column, content: Column) -> DataFrame:
    """(path, sha256) of each file."""
    return files.select(path.alias("path"), F.sha2(content, 256).alias("sha256"))


def receipt_differences(sealed: DataFrame, found: DataFrame) -> DataFrame:
    """(path, problem) where a sealed receipt and what is there now differ; empty means intact."""
    both = sealed.withColumnRenamed("sha256", "a").join(found.withColumnRenamed("sha256", "b"), "path", "full_outer")
    problem = F.when(F.col("b").isNull(), "missing").when(F.col("a").isNull(), "unexpected").when(F.col("a") != F.col("b"), "changed")
    return both.select("path", problem.alias("problem")).where("problem IS NOT NULL")


def violations(rows: DataFrame, key: Column, rules: list[tuple[str, Column]]) -> DataFrame:
    """(rule, key) for every row that breaks a rule; a condition that is null breaks it."""
    broken = F.array(*[F.when(~F.coalesce(ok, F.lit(False)), F.lit(rule)) for rule, ok in rules])
    return rows.select(key.cast("string").alias("key"), F.explode(F.filter(broken, lambda x: x.isNotNull())).alias("rule"))


def combination_rules(names: list[str]) -> list[tuple[str, Column]]:
    """What each row of a long table has to meet."""
    c, top = F.col, (1 << len(names)) - 1
    # The names of modes, metrics and denominators.
    known = F.array(*[F.lit(x) for x in ("all_sampled_roi_pixels", "all_eligible_cells", "all_measured_nuclei", *[f"positive:{n}" for n in names])])
    ratio_fits = F.abs(c("ratio") - F.try_divide(c("numerator"), c("denominator"))) <= 1e-10
    return [
        ("mask_range", c("mask").between(1, top)), ("numerator_not_over_denominator", c("numerator") <= c("denominator")),
        ("known_mode", c("mode").isin("inclusive", "exact")), ("known_metric", c("metric").isin("PA", "NPN", "CPN", "PN", "NPN_NUCLEUS_ONLY")),
        ("known_denominator", F.array_contains(known, c("denominator_type"))), ("label_matches_mask", c("combination") == label_text(c("mask"), names)),
        ("ratio_blank_iff_no_denominator", c("ratio").isNull() == (c("denominator") == 0)),
        ("ratio_fits", F.when(c("denominator") == 0, True).otherwise(ratio_fits)),
        ("no_negative_physical_value", (F.coalesce("density_per_mm2", F.lit(0.0)) >= 0) & (F.coalesce("positive_area_mm2", F.lit(0.0)) >= 0)),
    ]


def duplicate_keys(rows: DataFrame, *key: str) -> DataFrame:
    return rows.groupBy(*key).count().where("count > 1")


def reconcile(left: DataFrame, right: DataFrame, key: str, agree: Callable[[], Column]) -> DataFrame:
    """(key, problem) of a one-to-one check: rows on one side only, or pairs for which ``agree()`` doesn't hold.

    left and right have distinct columns besides the key.
    """
    both = left.withColumn("__l", F.lit(True)).join(right.withColumn("__r", F.lit(True)), key, "full_outer")
    problem = F.when(F.col("__r").isNull(), "left_only").when(F.col("__l").isNull(), "right_only").when(~F.coalesce(agree(), F.lit(False)), "disagrees")
    return both.select(key, problem.alias("problem")).where("problem IS NOT NULL")


def union_runs(runs: dict[str, DataFrame]) -> DataFrame:
    """Rows of all runs with their run_id; counts of different runs are never pooled."""
    out = None
    for run, rows in runs.items():
        one = rows.withColumn("run_id", F.lit(run))
        out = one if out is None else out.unionByName(one, allowMissingColumns=True)
    return out


def source_matches(want: dict[str, Column], have: dict[str, Column], tolerance: float = 1e-9) -> Column:
    """The first of the named properties that differs (numbers within a relative tolerance); null if none."""
    out = F.lit(None).cast("string")
    for name in reversed(list(want)):
        a, b = want[name], have[name]
        same = (F.abs(a - b) <= tolerance * F.greatest(F.abs(a), F.abs(b))) if name.startswith("calibration") else a.eqNullSafe(b)
        out = F.when(~F.coalesce(same, F.lit(False)), F.lit(name)).otherwise(out)
    return out
