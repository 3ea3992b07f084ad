"""Strict CSV, JSON-lines tile indexes, GeoJSON, run catalogues, fingerprints."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.runs import _fs

MAX_CELL = 32_767
SAMPLE = 64 * 1024
TILE_SCHEMA = "file STRING, levelX INT, levelY INT, width INT, height INT, roiPixels BIGINT, sha256 STRING"
GEO_SCHEMA = "type STRING, features ARRAY<STRUCT<id: STRING, properties: MAP<STRING,STRING>, geometry: STRUCT<type: STRING, coordinates: STRING>>>"
#: The geometry types.
GEOMETRIES = ("Point", "MultiPoint", "LineString", "MultiLineString", "Polygon", "MultiPolygon", "GeometryCollection")
RUN_SCHEMA = "schemaVersion INT, status STRING, algorithm STRING, imageName STRING, createdAt STRING, counts MAP<STRING,BIGINT>"


def read_strict_csv(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """Quotes doubled, line breaks inside quotes allowed; a bad row or a cell over the limit is an error."""
    rows = spark.read.schema(schema).csv(path, header=True, multiLine=True, quote='"', escape='"', mode="FAILFAST", enforceSchema=False)
    for c, kind in rows.dtypes:
        if kind == "string":
            rows = rows.withColumn(c, F.when(F.length(c) > MAX_CELL, F.raise_error(F.lit(f"a cell of {c} is too long"))).otherwise(F.col(c)))
    return rows


def tile_index(lines: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(accepted, rejected with reason) of JSON lines (value)."""
    t = lines.select("value", F.from_json("value", TILE_SCHEMA).alias("t")).select("value", "t.*")
    c = F.col
    whole = c("file").isNotNull() & c("levelX").isNotNull() & c("levelY").isNotNull() & c("width").isNotNull() & c("height").isNotNull() & c("roiPixels").isNotNull()
    area = c("width").cast("long") * c("height")
    reason = F.when(~whole, "incomplete").when((c("levelX") < 0) | (c("levelY") < 0) | (c("width") <= 0) | (c("height") <= 0), "bounds").when(
        ~c("roiPixels").between(0, area), "pixels").when(~F.coalesce(c("sha256").rlike("^[0-9a-f]{64}$"), F.lit(False)), "sha256")
    t = t.withColumn("reason", reason)
    again = t.where("reason IS NULL").groupBy("levelX", "levelY").count().where("count > 1").select("levelX", "levelY", F.lit("duplicate").alias("again"))
    t = t.join(again, ["levelX", "levelY"], "left").withColumn("reason", F.coalesce("reason", "again")).drop("again")
    return t.where("reason IS NULL").drop("reason", "value"), t.where("reason IS NOT NULL").select("value", "reason")


def geojson_features(texts: DataFrame) -> DataFrame:
    """(id, properties, type, coordinates) of FeatureCollections in ``text``; unknown geometry types are an error."""
    parsed = texts.select(F.from_json("text", GEO_SCHEMA).alias("g")).select(F.explode("g.features").alias("f")).select("f.id", "f.properties", "f.geometry.type", "f.geometry.coordinates")
    return parsed.withColumn("type", F.when(F.col("type").isin(*GEOMETRIES), F.col("type")).otherwise(F.raise_error(F.concat(F.lit("unknown geometry "), F.col("type")))))


def polygon_rings(features: DataFrame) -> DataFrame:
    """(id, ring, points) of polygons."""
    rings = F.from_json("coordinates", "array<array<array<double>>>")
    rows = features.where(F.col("type") == "Polygon").select("id", F.posexplode(rings).alias("ring", "raw"))
    return rows.select("id", "ring", F.transform("raw", lambda p: F.struct(p[0].alias("x"), p[1].alias("y"))).alias("points"))


def feature_collection(features: DataFrame, ident: Column, geometry: Column) -> DataFrame:
    """One line of text for each feature, for a streamed FeatureCollection; geometry: struct(type, coordinates)."""
    return features.select(F.to_json(F.struct(F.lit("Feature").alias("type"), ident.alias("id"), geometry.alias("geometry"))).alias("value"))


def run_catalogue(manifests: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(accepted, skipped with reason) of (path, text, incomplete)."""
    m = manifests.select("path", "incomplete", F.from_json("text", RUN_SCHEMA).alias("m")).select("path", "incomplete", "m.*")
    c = F.col
    reason = F.when(c("incomplete"), "incomplete").when(c("schemaVersion").isNull(), "unreadable").when(c("schemaVersion") != 1, "version").when(
        c("status") != "complete", "status").when(c("algorithm") != "raw-tile-if-v1", "algorithm").when(
        c("counts")["measured"] + c("counts")["rejected"] != c("counts")["proposed"], "counts")
    m = m.withColumn("reason", reason)
    return m.where("reason IS NULL").drop("reason", "incomplete"), m.where("reason IS NOT NULL").select("path", "reason")


#: The tables that a run must have, and the most entries of a folder of runs.
RUN_FILES = ("combinations.csv", "cells.csv", "excluded-cells.csv")
MAX_RUNS = 10_000


def scan_catalogue(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """(accepted, skipped with reason) of a run's folder, or of the folders right below ``path``.

    Only names are listed on the driver, at most ``MAX_RUNS`` of them; manifests and profiles are read by Spark.
    """
    fs, root = _fs(spark, path)
    is_run = lambda p: any(fs.exists(_fs(spark, f"{p}/{name}")[1]) for name in ("manifest.json", "INCOMPLETE"))
    if is_run(path):
        folders = [path]
    else:
        listed = fs.listStatus(root)
        if len(listed) > MAX_RUNS:
            raise ValueError(f"more than {MAX_RUNS} entries in {path}")
        folders = sorted(f"{path.rstrip('/')}/{x.getPath().getName()}" for x in listed if x.isDirectory())
    rows = []
    for f in folders:
        have = lambda name, f=f: fs.exists(_fs(spark, f"{f}/{name}")[1])
        rows.append((f, have("INCOMPLETE"), have("manifest.json"), have("profile.json"), [n for n in RUN_FILES if not have(n)]))
    listed = spark.createDataFrame(rows, "path string, incomplete boolean, manifest boolean, profile boolean, missing array<string>")

    def texts(name: str, there: int) -> DataFrame:
        files = [f"{r[0]}/{name}" for r in rows if r[there]]
        own = F.regexp_replace(F.regexp_replace("_metadata.file_path", f"/{name}(/[^/]*)?$", ""), "^file:/*", "/")
        return spark.read.text(files, wholetext=True).select(own.alias("own"), F.col("value").alias(name[:-5])) if files else spark.createDataFrame([], f"own string, {name[:-5]} string")

    known = listed.withColumn("own", F.regexp_replace("path", "^file:/*", "/"))
    known = known.drop("manifest", "profile").join(texts("manifest.json", 2), "own", "left").join(texts("profile.json", 3), "own", "left")
    embedded = F.get_json_object("manifest", "$.profile")
    early = F.when(F.col("incomplete"), "incomplete").when(F.col("manifest").isNull(), "no manifest").when(F.size("missing") > 0, F.concat(F.lit("missing "), F.array_join("missing", ", "))).when(
        F.col("profile").isNull() | (F.regexp_replace("profile", r"\s", "") != F.regexp_replace(F.coalesce(embedded, F.lit("")), r"\s", "")), "profile")
    known = known.withColumn("early", early)
    accepted, skipped = run_catalogue(known.where("early IS NULL").select("path", F.col("manifest").alias("text"), "incomplete"))
    return accepted, skipped.unionByName(known.where("early IS NOT NULL").select("path", F.col("early").alias("reason")))


def fingerprint(content: Column, size: Column) -> Column:
    """SHA-256 of up to three samples of a file (head, middle, tail), each behind its offset of 8 bytes; equal offsets count once."""
    starts = F.array_distinct(F.array(F.lit(0).cast("long"), F.greatest(F.floor((size - SAMPLE) / 2), F.lit(0)).cast("long"), F.greatest(size - SAMPLE, F.lit(0)).cast("long")))
    hexed = F.array_join(F.transform(starts, lambda s: F.concat(F.lpad(F.hex(s), 16, "0"), F.hex(F.substr(content, (s + 1).cast("int"), F.lit(SAMPLE))))), "")
    return F.sha2(F.unhex(hexed), 256)


def read_fingerprints(spark: SparkSession, path: str) -> DataFrame:
    files = spark.read.format("binaryFile").load(path)
    return files.select(F.col("path").alias("uri"), F.col("length").alias("size"), F.col("modificationTime").alias("mtime"), fingerprint(F.col("content"), F.col("length")).alias("sha256"))


def roi_id(name: Column) -> Column:
    return F.concat(F.lit("roi-"), F.substring(F.sha2(name, 256), 1, 32))
