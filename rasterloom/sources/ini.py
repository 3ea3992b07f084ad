"""INI documents as rows, and the slide metadata that they describe. Native expressions throughout."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window


def read_ini(spark: SparkSession, path: str) -> DataFrame:
    """(file, section, key, value) of all INI files under a path."""
    text = spark.read.text(path, wholetext=True).select(F.col("_metadata.file_path").alias("file"), F.col("value").alias("text"))
    return parse_ini(text)


def parse_ini(texts: DataFrame) -> DataFrame:
    """(file, section, key, value) from (file, text).

    Blank lines and lines that begin with ; or # are skipped, as are lines before the first
    section; the first = splits; the last of several values of a key wins.
    """
    lines = texts.select("file", F.posexplode(F.split(F.regexp_replace("text", "^\\uFEFF", ""), "\\r\\n|\\n|\\r")).alias("n", "raw"))
    lines = lines.withColumn("line", F.btrim("raw")).where((F.col("line") != "") & ~F.col("line").rlike("^[;#]"))
    header = F.when(F.col("line").rlike(r"^\[.*\]$"), F.btrim(F.expr("substr(line, 2, length(line) - 2)")))
    lines = lines.withColumn("header", header)
    upto = Window.partitionBy("file").orderBy("n")  # the lines of one file
    named = lines.withColumn("section", F.last("header", ignorenulls=True).over(upto))
    pairs = named.where(F.col("header").isNull() & F.col("section").isNotNull() & (F.instr("line", "=") > 0))
    at = F.instr("line", "=")
    pairs = pairs.select("file", "section", F.btrim(F.substr("line", F.lit(1), at - 1)).alias("key"), F.btrim(F.substr("line", at + 1)).alias("value"), "n")
    return pairs.groupBy("file", "section", "key").agg(F.max_by("value", "n").alias("value"))


def lookup(ini: DataFrame, section: str, key: str, kind: str = "string", default=None) -> DataFrame:
    """(file, value) of a typed key; without a default a missing or malformed value is an error."""
    found = ini.where((F.col("section") == section) & (F.col("key") == key)).select("file", F.col("value").alias("v"))
    rows = ini.select("file").distinct().join(found, "file", "left")
    cast = F.col("v").try_cast(kind)
    bad = F.raise_error(F.concat(F.lit(f"[{section}] {key} is missing or malformed in "), F.col("file"))).cast(kind)
    missing = bad if default is None else F.when(F.col("v").isNull(), F.lit(default).cast(kind)).otherwise(bad)
    return rows.select("file", F.coalesce(cast, missing).alias("value"))


def _dimension(ini: DataFrame, name: str) -> DataFrame:
    """(file, i, j, label, section) of the values of the hierarchy dimension with a name, ignoring case."""
    own = ini.where(F.col("section") == "HIERARCHICAL")
    index = own.where(F.col("key").rlike(r"^HIER_\d+_NAME$") & (F.lower("value") == name.lower())).select(
        "file", F.regexp_extract("key", r"\d+", 0).cast("int").alias("i"))
    part = lambda end, out: own.where(F.col("key").rlike(rf"^HIER_\d+_VAL_\d+{end}$")).select(
        "file", F.regexp_extract("key", r"HIER_(\d+)", 1).cast("int").alias("i"), F.regexp_extract("key", r"VAL_(\d+)", 1).cast("int").alias("j"), F.col("value").alias(out))
    return index.join(part("", "label"), ["file", "i"]).join(part("_SECTION", "part"), ["file", "i", "j"])


def _with_keys(values: DataFrame, ini: DataFrame, keys: list[str]) -> DataFrame:
    """The values' sections, with some of their keys as columns."""
    wide = ini.where(F.col("key").isin(keys)).groupBy("file", F.col("section").alias("part")).pivot("key", keys).agg(F.first("value"))
    return values.join(wide, ["file", "part"], "left")


def zoom_levels(ini: DataFrame) -> DataFrame:
    # The names of the keys.
    keys = ["MICROMETER_PER_PIXEL_X", "MICROMETER_PER_PIXEL_Y", "DIGITIZER_WIDTH", "DIGITIZER_HEIGHT", "IMAGE_CONCAT_FACTOR", "OVERLAP_X", "OVERLAP_Y", "IMAGE_FORMAT"]
    rows = _with_keys(_dimension(ini, "Slide zoom level"), ini, keys)
    num = lambda k, t, d: F.coalesce(F.col(k).try_cast(t), d)
    return rows.select(
        "file", F.col("j").alias("level"), F.col(keys[0]).cast("double").alias("um_x"), F.col(keys[1]).cast("double").alias("um_y"), F.col(keys[2]).cast("int").alias("tile_w"),
        F.col(keys[3]).cast("int").alias("tile_h"), num(keys[4], "int", F.col("j")).alias("concat"), num(keys[5], "double", F.lit(0.0)).alias("overlap_x"),
        num(keys[6], "double", F.lit(0.0)).alias("overlap_y"), F.coalesce(keys[7], F.lit("JPEG")).alias("format"))


def channels(ini: DataFrame) -> DataFrame:
    """Channels: filter values whose section has a name; their storage level is found by name, else by place."""
    keys = ["FILTER_NAME", "COLOR_R", "COLOR_G", "COLOR_B", "DATA_IN_THIS_FILTER_LEVEL", "STORING_CHANNEL_NUMBER", "EXCITATION_WAVELENGTH", "EMISSION_WAVELENGTH", "EXPOSURE_TIME", "IS_MASTER_FILTER"]
    values = _dimension(ini, "Slide filter level")
    rows = _with_keys(values, ini, keys).where(F.btrim(F.coalesce("FILTER_NAME", F.lit(""))) != "")
    level = F.coalesce("DATA_IN_THIS_FILTER_LEVEL", F.col("label"))
    names = values.groupBy("file", F.lower("label").alias("low")).agg(F.min("j").alias("storage"))
    rows = rows.withColumn("low", F.lower(level)).join(names, ["file", "low"], "left")
    num = lambda k, t, d: F.coalesce(F.col(k).try_cast(t), F.lit(d))
    colour = num("COLOR_R", "int", 255) * 65536 + num("COLOR_G", "int", 255) * 256 + num("COLOR_B", "int", 255)
    place = F.row_number().over(Window.partitionBy("file").orderBy("j")) - 1
    return rows.select(
        "file", place.alias("channel"), F.col("FILTER_NAME").alias("name"), level.alias("filter_level"), F.coalesce("storage", "j").alias("filter_level_index"),
        num("STORING_CHANNEL_NUMBER", "int", 0).alias("stored_component"), colour.alias("color"), F.col("EXCITATION_WAVELENGTH").try_cast("double").alias("exc"),
        F.col("EMISSION_WAVELENGTH").try_cast("double").alias("emi"), num("EXPOSURE_TIME", "int", 0).alias("exposure"),
        (F.lower(F.coalesce("IS_MASTER_FILTER", F.lit("false"))) == "true").alias("master"))


def data_files(ini: DataFrame) -> DataFrame:
    own = ini.where((F.col("section") == "DATAFILE") & F.col("key").rlike(r"^FILE_\d+$"))
    return own.select("file", F.regexp_extract("key", r"\d+", 0).cast("int").alias("file_number"), F.col("value").alias("name"))


def position_record(ini: DataFrame) -> DataFrame:
    """(file, record, compressed): the record of stitching positions, a running sum of the counts before it."""
    own = ini.where((F.col("section") == "HIERARCHICAL") & F.col("key").rlike(r"^NONHIER_\d+_(NAME|COUNT)$"))
    rows = own.groupBy("file", F.regexp_extract("key", r"\d+", 0).cast("int").alias("i")).agg(
        F.max(F.when(F.col("key").endswith("_NAME"), F.lower("value"))).alias("name"), F.max(F.when(F.col("key").endswith("_COUNT"), F.col("value").cast("long"))).alias("n"))
    before = Window.partitionBy("file").orderBy("i").rowsBetween(Window.unboundedPreceding, -1)
    rows = rows.withColumn("record", F.coalesce(F.sum(F.coalesce("n", F.lit(0))).over(before), F.lit(0)))
    plain = F.min(F.when(F.col("name") == "vimslide_position_buffer", F.col("record")))
    packed = F.min(F.when(F.col("name") == "stitchingintensitylayer", F.col("record")))
    out = rows.groupBy("file").agg(plain.alias("a"), packed.alias("b"))
    return out.select("file", F.coalesce("a", "b", F.lit(-1)).alias("record"), (F.col("a").isNull() & F.col("b").isNotNull()).alias("compressed"))


def metadata(ini: DataFrame) -> DataFrame:
    """One row for each file: its levels, channels, data files (arrays of structs, in order) and position record."""
    listed = lambda df, name: df.groupBy("file").agg(F.sort_array(F.collect_list(F.struct(*[c for c in df.columns if c != "file"]))).alias(name))
    out = ini.select("file").distinct()
    for df, name in ((zoom_levels(ini), "levels"), (channels(ini), "channels"), (data_files(ini), "data_files")):
        out = out.join(listed(df, name), "file", "left").withColumn(name, F.coalesce(name, F.array().cast(listed(df, name).schema[name].dataType)))
    return out.join(position_record(ini).withColumnRenamed("record", "position_record"), "file", "left")
