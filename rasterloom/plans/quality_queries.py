"""Channel statistics, display audits, percentiles, findings, text guards, receipts."""

from __future__ import annotations


from pyspark.sql import functions as F

from ..functions import scalar
from ..operators import batch, quality, runs
from ._register import query, table

CHANNELS = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


@query(" UNION ALL ".join(f"""SELECT '{c}' AS channel, CAST(min({c}) AS DOUBLE) AS min, CAST(max({c}) AS DOUBLE) AS max, round(avg({c}), 6) AS mean, count(*) FILTER ({c} <> 0) AS non_zero, count({c}) AS count,
  CASE WHEN max({c}) = 0 THEN 'ALL_ZERO' WHEN max({c}) - min({c}) < 4 THEN 'LOW_DYNAMIC_RANGE' ELSE 'SIGNAL_PRESENT' END AS status FROM lineitem""" for c in CHANNELS))
def channel_statistics(spark, sf_dir):
    return quality.channel_statistics(table(spark, sf_dir, "lineitem"), CHANNELS).withColumn("mean", F.round("mean", 6))


@query("""WITH v AS (SELECT l_linestatus, CAST(l_extendedprice AS FLOAT) AS v FROM lineitem)
SELECT *, below / nullif(CAST(finite AS DOUBLE), 0) AS below_fraction, above / nullif(CAST(finite AS DOUBLE), 0) AS above_fraction FROM (
SELECT l_linestatus, count(*) FILTER (isfinite(v)) AS finite, count(*) FILTER (NOT isfinite(v)) AS nonfinite, count(*) FILTER (v < 20000::FLOAT) AS below, count(*) FILTER (v = 20000::FLOAT) AS at_min,
 count(*) FILTER (v > 80000::FLOAT) AS above, count(*) FILTER (v = 80000::FLOAT) AS at_max, CAST(min(v) AS DOUBLE) AS observed_min, CAST(max(v) AS DOUBLE) AS observed_max FROM v GROUP BY 1)""")
def display_range_audit(spark, sf_dir):
    return quality.display_audit(table(spark, sf_dir, "lineitem"), F.col("l_extendedprice"), 20_000, 80_000, "l_linestatus")


@query("""WITH b AS (SELECT l_returnflag, floor(l_quantity) AS bin, count(*) AS n FROM lineitem GROUP BY 1, 2),
r AS (SELECT *, sum(n) OVER (PARTITION BY l_returnflag ORDER BY bin) AS upto, sum(n) OVER (PARTITION BY l_returnflag) AS total FROM b)
SELECT l_returnflag, CAST(min(bin) FILTER (upto >= total * 0.01) AS DOUBLE) AS low, CAST(min(bin) FILTER (upto >= total * 0.998) AS DOUBLE) AS high FROM r GROUP BY 1""")
def percentile_display_range(spark, sf_dir):
    return quality.percentile_range(table(spark, sf_dir, "lineitem").select("l_returnflag", "l_quantity"), "l_quantity", 1.0, "l_returnflag")


#: A small pyramid: level, concat exponent and pixel size, whose last step is off its geometry.
LEVELS = [(0, 0, 0.325, 0.325), (1, 1, 0.65, 0.65), (2, 1, 1.3, 1.3004), (3, 2, 5.21, 5.2)]
_LEVEL_VALUES = ", ".join(f"({z}, {c}, {x}::DOUBLE, {y}::DOUBLE)" for z, c, x, y in LEVELS)


@query(f"""WITH l(level, concat, um_x, um_y) AS (VALUES {_LEVEL_VALUES}), d AS (SELECT *, pow(2.0::DOUBLE, sum(concat) OVER (ORDER BY level)) AS ds FROM l),
m AS (SELECT level, greatest(abs(ds - um_x / 0.325::DOUBLE) / greatest(ds, um_x / 0.325::DOUBLE), abs(ds - um_y / 0.325::DOUBLE) / greatest(ds, um_y / 0.325::DOUBLE)) AS mismatch FROM d)
SELECT CAST(level AS INTEGER) AS level, round(mismatch, 12) AS mismatch, mismatch > 0.001 AS warn FROM m ORDER BY mismatch DESC, level LIMIT 1""")
def calibration_mismatch(spark, sf_dir):
    from ..operators.raster import level_geometry
    levels = level_geometry(spark.createDataFrame(LEVELS, "level int, concat int, um_x double, um_y double"), 85_280, 190_235)
    levels = levels.withColumn("base_x", F.lit(LEVELS[0][2])).withColumn("base_y", F.lit(LEVELS[0][3]))
    return quality.calibration_mismatch(levels).withColumn("mismatch", F.round("mismatch", 12))


@query("""SELECT n_nationkey, n_name, row_number() OVER (PARTITION BY lower(substr(n_name, 1, 1)) ORDER BY n_nationkey) > 1 AS name_again,
  row_number() OVER (PARTITION BY n_regionkey ORDER BY n_nationkey) > 1 AS storage_again FROM nation""")
def duplicate_channel_findings(spark, sf_dir):
    rows = quality.duplicates(table(spark, sf_dir, "nation"), F.lower(F.substring("n_name", 1, 1)), "n_nationkey").withColumnRenamed("duplicate", "name_again")
    rows = quality.duplicates(rows, F.col("n_regionkey"), "n_nationkey").withColumnRenamed("duplicate", "storage_again")
    return rows.select("n_nationkey", "n_name", "name_again", "storage_again")


_SLIDES = """s AS (SELECT s_suppkey AS slide, s_suppkey % 11 <> 0 AS has_anchor, s_suppkey % 7 <> 0 AS has_index, CASE WHEN s_suppkey % 5 = 0 THEN 16 ELSE 8 END AS stored_bits,
  CASE WHEN s_suppkey % 3 = 0 THEN 12 ELSE 8 END AS camera_bits, s_suppkey % 4 AS divisions, 8 AS grid_x, s_suppkey AS grid_y, s_suppkey % 13 AS level_count, s_suppkey % 6 AS channel_count, s_nationkey - 3 AS position_record FROM supplier)"""
_RULES = [("ERROR", "MISSING_ANCHOR_FILE", "NOT has_anchor"), ("ERROR", "MISSING_INDEX", "NOT has_index"), ("ERROR", "UNSUPPORTED_BIT_DEPTH", "stored_bits <> 8"),
          ("WARNING", "CAMERA_STORAGE_BIT_DEPTH_DIFFER", "camera_bits <> stored_bits"), ("ERROR", "INVALID_CAMERA_GEOMETRY", "CASE WHEN divisions <= 0 THEN true ELSE grid_x % divisions <> 0 OR grid_y % divisions <> 0 END"),
          ("ERROR", "NO_RESOLUTION_LEVELS", "level_count = 0"), ("ERROR", "NO_FLUORESCENCE_CHANNELS", "channel_count = 0"), ("WARNING", "NO_STITCHING_POSITIONS", "position_record < 0")]


def slides(spark, sf_dir):
    k = F.col("s_suppkey")
    return table(spark, sf_dir, "supplier").select(
        k.alias("slide"), (k % 11 != 0).alias("has_anchor"), (k % 7 != 0).alias("has_index"), F.when(k % 5 == 0, 16).otherwise(8).alias("stored_bits"),
        F.when(k % 3 == 0, 12).otherwise(8).alias("camera_bits"), (k % 4).alias("divisions"), F.lit(8).alias("grid_x"), k.alias("grid_y"),
        (k % 13).alias("level_count"), (k % 6).alias("channel_count"), (F.col("s_nationkey") - 3).alias("position_record"))


@query(f"WITH {_SLIDES} " + " UNION ALL ".join(f"SELECT slide, '{s}' AS severity, '{c}' AS code FROM s WHERE {w}" for s, c, w in _RULES))
def compat_findings_explode(spark, sf_dir):
    return quality.findings(slides(spark, sf_dir), quality.slide_rules(), "slide")


@query(f"WITH {_SLIDES} SELECT slide, CAST(CASE WHEN " + " OR ".join(f"({w})" for s, _, w in _RULES if s == "ERROR") + " THEN 0 ELSE 4 END AS DOUBLE) AS score FROM s")
def format_support_score(spark, sf_dir):
    own = slides(spark, sf_dir)
    return quality.support_score(quality.findings(own, quality.slide_rules(), "slide"), own, "slide")


@query("""SELECT p_partkey, CASE WHEN g IN ('=', '+', '-', '@', chr(9), chr(13)) THEN '''' ELSE '' END || g || p_name AS guarded,
  '"' || CASE WHEN g IN ('=', '+', '-', '@', chr(9), chr(13)) THEN '''' ELSE '' END || replace(g || p_name, '"', '""') || '"' AS cell FROM (
  SELECT p_partkey, p_name, ['=', '+', '-', '@', chr(9), chr(13), '"', ''][p_partkey % 8 + 1] AS g FROM part)""")
def csv_guard_text(spark, sf_dir):
    signs = F.array(*[F.lit(x) for x in ("=", "+", "-", "@", "\t", "\r", '"', "")])
    text = F.concat(F.get(signs, (F.col("p_partkey") % 8).cast("int")), F.col("p_name"))
    return table(spark, sf_dir, "part").select("p_partkey", scalar.guard_text(text).alias("guarded"), scalar.csv_cell(text).alias("cell"))


@query("""WITH a AS (SELECT 'doc-' || doc_id AS path, sha256(coalesce(text, '')) AS sha256 FROM documents WHERE doc_id % 10 <> 3),
b AS (SELECT 'doc-' || doc_id AS path, sha256(coalesce(text, '') || CASE WHEN doc_id % 10 = 5 THEN '!' ELSE '' END) AS sha256 FROM documents WHERE doc_id % 10 <> 7)
SELECT coalesce(a.path, b.path) AS path, CASE WHEN b.path IS NULL THEN 'missing' WHEN a.path IS NULL THEN 'unexpected' ELSE 'changed' END AS problem
FROM a FULL OUTER JOIN b ON a.path = b.path WHERE a.path IS NULL OR b.path IS NULL OR a.sha256 <> b.sha256""")
def file_hash_receipt(spark, sf_dir):
    """A seal against what is found: some files are gone, some are new, some have changed."""
    docs = table(spark, sf_dir, "documents").select("doc_id", F.coalesce("text", F.lit("")).alias("t"))
    path = F.concat(F.lit("doc-"), F.col("doc_id").cast("string"))
    last = F.col("doc_id") % 10
    sealed = runs.receipt(docs.where(last != 3), path, F.col("t"))
    found = runs.receipt(docs.where(last != 7), path, F.concat("t", F.when(last == 5, "!").otherwise("")))
    return runs.receipt_differences(sealed, found)


@query("""SELECT p_partkey, CAST(ceil((p_size + 100 * p_retailprice / 10) / 4.0 - 0.5) - ceil(p_size / 4.0 - 0.5) AS BIGINT) AS across, CAST(ceil((p_size * 50) / 4.0 - 0.5) - ceil(0 / 4.0 - 0.5) AS BIGINT) AS down,
  (ceil((p_size + 100 * p_retailprice / 10) / 4.0 - 0.5) - ceil(p_size / 4.0 - 0.5)) * (ceil((p_size * 50) / 4.0 - 0.5) - ceil(0 / 4.0 - 0.5)) > 1000000 AS confirm FROM part""")
def workload_estimate(spark, sf_dir):
    size, price = F.col("p_size").cast("double"), F.col("p_retailprice")
    across = quality.workload(size, size + 100 * price / 10, 4.0).cast("long")
    down = quality.workload(F.lit(0.0), size * 50, 4.0).cast("long")
    return table(spark, sf_dir, "part").select("p_partkey", across.alias("across"), down.alias("down"), (across * down > 1_000_000).alias("confirm"))


@query("""SELECT n_regionkey, count(*) AS profiles, count(DISTINCT sha256(CAST(n_nationkey % 3 AS VARCHAR) || ':' || substr(n_name, 1, 1))) AS groups FROM nation GROUP BY 1""")
def profile_groups(spark, sf_dir):
    key = scalar.sha256_hex(F.concat_ws(":", (F.col("n_nationkey") % 3).cast("string"), F.substring("n_name", 1, 1)))
    return table(spark, sf_dir, "nation").groupBy("n_regionkey").agg(F.count("*").alias("profiles"), F.count_distinct(key).alias("groups"))


@query("""SELECT event_type, count(*) AS n, sum(CAST(json_extract_string(props, '$.k') AS BIGINT))::BIGINT AS total, max(CAST(json_extract_string(props, '$.k') AS BIGINT)) AS top FROM events GROUP BY 1""")
def json_props_extract(spark, sf_dir):
    k = F.from_json("props", "k bigint")["k"]
    return table(spark, sf_dir, "events").groupBy("event_type").agg(F.count("*").alias("n"), F.sum(k).alias("total"), F.max(k).alias("top"))


@query("""SELECT doc_id, length(guarded) AS chars, sha256(guarded) AS sha256 FROM (SELECT doc_id, CASE WHEN regexp_matches(coalesce(text, ''), '^[=+\\-@\\t\\r]') THEN '''' ELSE '' END || coalesce(text, '') AS guarded FROM documents)""")
def guarded_document_hash(spark, sf_dir):
    text = scalar.guard_text(F.coalesce("text", F.lit("")))
    return table(spark, sf_dir, "documents").select("doc_id", F.char_length(text).cast("long").alias("chars"), scalar.sha256_hex(text).alias("sha256"))


@query("""SELECT s_suppkey, CASE WHEN s_acctbal > 0 THEN pow(10.0::DOUBLE, floor(log10(s_acctbal))) * CASE WHEN s_acctbal / pow(10.0::DOUBLE, floor(log10(s_acctbal))) >= 5 THEN 5
  WHEN s_acctbal / pow(10.0::DOUBLE, floor(log10(s_acctbal))) >= 2 THEN 2 ELSE 1 END END AS nice, round(s_suppkey * 2.54::DOUBLE / 300, 9) AS print_cm,
  CASE WHEN s_acctbal > 0 AND s_nationkey > 0 THEN round(abs(s_acctbal - s_nationkey) / greatest(s_acctbal, s_nationkey), 12) END AS apart FROM supplier""")
def lengths_and_differences(spark, sf_dir):
    v = F.col("s_acctbal")
    apart = F.round(scalar.finite_or_null(scalar.relative_difference(v, F.col("s_nationkey").cast("double"))), 12)
    return table(spark, sf_dir, "supplier").select("s_suppkey", F.when(v > 0, scalar.nice_length(v)).alias("nice"), F.round(scalar.print_size_cm(F.col("s_suppkey"), 300), 9).alias("print_cm"), apart.alias("apart"))


@query("""SELECT o_custkey, sha256('{"c":' || o_custkey || ',"s":' || CASE WHEN max(o_orderstatus) = 'P' THEN 'null' ELSE '"' || max(o_orderstatus) || '"' END || '}') AS resume_key FROM orders GROUP BY 1""")
def resume_identity(spark, sf_dir):
    rows = table(spark, sf_dir, "orders").groupBy("o_custkey").agg(F.max("o_orderstatus").alias("s"))
    return rows.select("o_custkey", batch.resume_key(F.col("o_custkey").alias("c"), F.when(F.col("s") != "P", F.col("s")).alias("s")).alias("resume_key"))




@query("""SELECT coalesce(CASE WHEN o_orderstatus <> 'F' THEN 'status' WHEN abs(o_totalprice - round(o_totalprice)) > 1e-9 * greatest(abs(o_totalprice), abs(round(o_totalprice))) THEN 'calibration_price' END, 'match') AS differs, count(*) AS n FROM orders GROUP BY 1""")
def history_source_gate(spark, sf_dir):
    want = {"status": F.lit("F"), "calibration_price": F.round("o_totalprice")}
    have = {"status": F.col("o_orderstatus"), "calibration_price": F.col("o_totalprice")}
    rows = table(spark, sf_dir, "orders").select(F.coalesce(runs.source_matches(want, have), F.lit("match")).alias("differs"))
    return rows.groupBy("differs").agg(F.count("*").alias("n"))


@query("""SELECT l_orderkey AS orderkey, l_linenumber AS linenumber, count(*) AS count FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1""")
def duplicate_key_check(spark, sf_dir):
    rows = table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("orderkey"), F.col("l_linenumber").alias("linenumber"))
    return runs.duplicate_keys(rows, "orderkey", "linenumber")




_LEVELS = """l AS (SELECT s_suppkey AS slide, k AS level, CASE WHEN (s_suppkey + k) % 9 = 0 THEN 'PNG' ELSE 'jpeg' END AS format, CASE WHEN s_suppkey % 8 = k THEN 21 ELSE k END AS concat,
  CASE WHEN s_suppkey % 12 = 5 AND k = 2 THEN 0 ELSE 0.25 * pow(2, k) * CASE WHEN s_suppkey % 7 = 4 AND k = 1 THEN 1.01 ELSE 1 END END AS um_x, 0.25 * pow(2, k) AS um_y,
  CASE WHEN s_suppkey % 10 = k THEN 0 ELSE 32 END AS tile_w, 32 AS tile_h, pow(2.0::DOUBLE, k) AS downsample FROM supplier, (SELECT unnest([0, 1, 2]) AS k)),
h AS (SELECT s_suppkey AS slide, k AS channel, CASE WHEN s_suppkey % 4 = 1 THEN 'A' ELSE 'C' || k END AS name, CASE WHEN s_suppkey % 6 = k THEN 9 ELSE k % 2 END AS filter_level_index, (s_suppkey + k) % 5 AS stored_component FROM supplier, (SELECT unnest([0, 1, 2]) AS k)),
f AS (SELECT s_suppkey AS slide, s_suppkey % 16 <> 7 OR k <> 1 AS found FROM supplier, (SELECT unnest([0, 1]) AS k))"""
_MORE = [("ERROR", "UNSUPPORTED_COMPRESSION", "FROM l WHERE upper(format) <> 'JPEG'"), ("ERROR", "INVALID_CONCAT_FACTOR", "FROM l WHERE concat > 20"), ("ERROR", "INVALID_PIXEL_SIZE", "FROM l WHERE um_x = 0"),
         ("ERROR", "INVALID_TILE_SIZE", "FROM l WHERE tile_w = 0"), ("ERROR", "INVALID_FILTER_LEVEL", "FROM h WHERE filter_level_index > 1"), ("ERROR", "UNSUPPORTED_PACKED_COMPONENT", "FROM h WHERE stored_component > 2"),
         ("WARNING", "DUPLICATE_CHANNEL_NAME", "FROM h a WHERE EXISTS (SELECT 1 FROM h b WHERE b.slide = a.slide AND b.name = a.name AND b.channel < a.channel)"),
         ("WARNING", "DUPLICATE_STORAGE_MAPPING", "FROM h a WHERE EXISTS (SELECT 1 FROM h b WHERE b.slide = a.slide AND b.filter_level_index = a.filter_level_index AND b.stored_component = a.stored_component AND b.channel < a.channel)"),
         ("ERROR", "MISSING_DATA_FILE", "FROM f WHERE NOT found"), ("WARNING", "PYRAMID_PIXEL_SIZE_MISMATCH", "FROM supplier WHERE s_suppkey % 7 = 4 OR s_suppkey % 12 = 5")]


@query(f"WITH {_SLIDES}, {_LEVELS} " + " UNION ALL ".join([*(f"SELECT slide, '{s}' AS severity, '{c}' AS code FROM s WHERE {w}" for s, c, w in _RULES),
                                                           *(f"SELECT {'s_suppkey' if 'supplier' in w else 'slide'}, '{s}', '{c}' {w}" for s, c, w in _MORE)]))
def compat_findings_all(spark, sf_dir):
    """All 18 codes: rules on slides, levels, channels, data files and the pyramid."""
    k, c = F.col("s_suppkey"), F.col
    base = table(spark, sf_dir, "supplier").select("s_suppkey", k.alias("slide"))
    per = lambda n, name: base.withColumn(name, F.explode(F.array(*[F.lit(i) for i in range(n)])))
    two = F.pow(F.lit(2.0), c("level"))
    um = F.when((k % 12 == 5) & (c("level") == 2), 0.0).otherwise(0.25 * two * F.when((k % 7 == 4) & (c("level") == 1), 1.01).otherwise(1.0))
    levels = per(3, "level").select("slide", "level", F.when((k + c("level")) % 9 == 0, "PNG").otherwise("jpeg").alias("format"), F.when(k % 8 == c("level"), 21).otherwise(c("level")).alias("concat"), um.alias("um_x"),
                                    (0.25 * two).alias("um_y"), F.when(k % 10 == c("level"), 0).otherwise(32).alias("tile_w"), F.lit(32).alias("tile_h"), two.alias("downsample"))
    channels = per(3, "channel").select("slide", "channel", F.when(k % 4 == 1, "A").otherwise(F.concat(F.lit("C"), c("channel").cast("string"))).alias("name"),
                                        F.when(k % 6 == c("channel"), 9).otherwise(c("channel") % 2).alias("filter_level_index"), ((k + c("channel")) % 5).alias("stored_component"))
    files = per(2, "n").select("slide", ((k % 16 != 7) | (c("n") != 1)).alias("found"))
    return quality.compatibility(slides(spark, sf_dir), levels, channels, files, 2)


_TAILS = ["", "e3", "e-5", "E10"]
_SHOWN = """SELECT p_partkey, d || t AS text, floor(log10(p_retailprice)) + e AS power, CASE WHEN p_retailprice < 1000 THEN round(CAST(d AS DECIMAL(18, 4)) * 10) ELSE round(CAST(d AS DECIMAL(18, 4))) END AS head
FROM (SELECT p_partkey, p_retailprice, printf('%.2f', p_retailprice) AS d, ['', 'e3', 'e-5', 'E10'][p_partkey % 4 + 1] AS t, [0, 3, -5, 10][p_partkey % 4 + 1] AS e FROM part)"""
_STRIP = "regexp_replace(regexp_replace({0}, '0+$', ''), '[.]$', '')"


@query(f"""SELECT p_partkey, text, CASE WHEN power < -3 OR power >= 5 THEN {_STRIP.format("printf('%.3f', CAST(head AS DOUBLE) / 1000)")} || 'e' || CAST(power AS INTEGER) ELSE {_STRIP.format("printf('%.9f', CAST(head AS DOUBLE) * pow(10, power - 3))")} END AS shown,
  true AS safe, '_x005F_x0041_ ' || chr(92) || chr(92) || 'n' || chr(92) || '"' AS escaped FROM ({_SHOWN})""")
def office_number_text(spark, sf_dir):
    """Numbers as a report shows them, and if a spreadsheet holds them."""
    text = F.concat(F.format_string("%.2f", F.col("p_retailprice")), F.get(F.array(*[F.lit(t) for t in _TAILS]), (F.col("p_partkey") % 4).cast("int")))
    mark = scalar.json_escape(scalar.escape_cell_codes(F.lit('_x0041_ \\n"')))
    return table(spark, sf_dir, "part").select("p_partkey", text.alias("text"), scalar.four_digit_text(text).alias("shown"), scalar.fits_fifteen_digits(text).alias("safe"), mark.alias("escaped"))
