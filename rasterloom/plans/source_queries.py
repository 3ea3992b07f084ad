"""Sources over fixed inputs: INI text, index bytes, polygons; segmentation and mask tiles over lineitem."""

from __future__ import annotations

import struct
import zlib

from pyspark.sql import functions as F

from ..functions import geometry, pixel
from ..operators import marker, masks, segment
from ..sources import ini, slide_index, tables
from ._register import query, table
from .marker_queries import REGION, mask, sampled, whole_pixels

INI = "﻿stray=1\r\n[GENERAL]\r\n; note\r\nSLIDE_ID = abc \r\n# more\nA=1\nA=2=3\n\n[HIERARCHICAL]\nHIER_COUNT=2\nHIER_0_NAME=Slide zoom level\nHIER_0_COUNT=2\n" \
      "HIER_0_VAL_0=Z0\nHIER_0_VAL_0_SECTION=ZOOM_0\nHIER_0_VAL_1=Z1\nHIER_0_VAL_1_SECTION=ZOOM_1\nHIER_1_NAME=slide FILTER level\nHIER_1_COUNT=3\nHIER_1_VAL_0=F0\nHIER_1_VAL_0_SECTION=FILTER_0\n" \
      "HIER_1_VAL_1=F1\nHIER_1_VAL_1_SECTION=FILTER_1\nHIER_1_VAL_2=F2\nHIER_1_VAL_2_SECTION=FILTER_2\nNONHIER_COUNT=3\nNONHIER_0_NAME=X\nNONHIER_0_COUNT=2\nNONHIER_1_NAME=Y\nNONHIER_1_COUNT=3\n" \
      "NONHIER_2_NAME=VIMSLIDE_POSITION_BUFFER\nNONHIER_2_COUNT=1\n[ZOOM_0]\nMICROMETER_PER_PIXEL_X=0.5\nMICROMETER_PER_PIXEL_Y=0.75\nDIGITIZER_WIDTH=32\nDIGITIZER_HEIGHT=8\nIMAGE_CONCAT_FACTOR=0\n" \
      "[ZOOM_1]\nMICROMETER_PER_PIXEL_X=1\nMICROMETER_PER_PIXEL_Y=1.5\nDIGITIZER_WIDTH=32\nDIGITIZER_HEIGHT=8\n[FILTER_0]\nFILTER_NAME=DAPI\nCOLOR_R=0\nCOLOR_G=0\nSTORING_CHANNEL_NUMBER=2\n" \
      "[FILTER_1]\nFILTER_NAME=  \n[FILTER_2]\nFILTER_NAME=CD8\nDATA_IN_THIS_FILTER_LEVEL=f0\n[DATAFILE]\nFILE_COUNT=1\nFILE_0=Data0000.dat\n"


def ini_rows(spark):
    return ini.parse_ini(spark.createDataFrame([("a.ini", INI)], "file string, text string"))


@query("SELECT * FROM (VALUES ('GENERAL', 'SLIDE_ID', 'abc'), ('GENERAL', 'A', '2=3'), ('FILTER_0', 'FILTER_NAME', 'DAPI'), ('FILTER_0', 'COLOR_R', '0'), ('FILTER_0', 'COLOR_G', '0'), ('FILTER_0', 'STORING_CHANNEL_NUMBER', '2')) AS t(section, key, value)")
def ini_parse(spark, sf_dir):
    return ini_rows(spark).where(F.col("section").isin("GENERAL", "FILTER_0")).select("section", "key", "value")


@query("SELECT CAST(channel AS INTEGER) AS channel, name, filter_level, CAST(idx AS INTEGER) AS filter_level_index, CAST(comp AS INTEGER) AS stored_component, CAST(color AS INTEGER) AS color FROM (VALUES (0, 'DAPI', 'F0', 0, 2, 255), (1, 'CD8', 'f0', 0, 0, 16777215)) AS t(channel, name, filter_level, idx, comp, color)")
def ini_channels(spark, sf_dir):
    return ini.channels(ini_rows(spark)).select("channel", "name", "filter_level", "filter_level_index", "stored_component", "color")


@query("SELECT CAST(level AS INTEGER) AS level, CAST(x AS DOUBLE) AS um_x, CAST(y AS DOUBLE) AS um_y, CAST(c AS INTEGER) AS concat, CAST(5 AS BIGINT) AS position_record FROM (VALUES (0, 0.5, 0.75, 0), (1, 1.0, 1.5, 1)) AS t(level, x, y, c)")
def ini_levels(spark, sf_dir):
    rows = ini_rows(spark)
    return ini.zoom_levels(rows).join(ini.position_record(rows), "file").select("level", "um_x", "um_y", "concat", F.col("record").alias("position_record"))


def index_bytes(slide_id: str = "s" * 32) -> bytes:
    """A small index of 2 levels x 3 filters: two chained pages at (0, 0), one page at (1, 2)."""
    out = bytearray(b"01.02" + slide_id.encode() + struct.pack("<II", 45, 0) + bytes(4 * 6))
    def place(*numbers):
        at = len(out)
        out.extend(struct.pack(f"<{len(numbers)}I", *numbers))
        return at
    second = place(1, 0, 9, 300, 30, 1)
    first = place(2, second, 4, 100, 10, 0, 5, 200, 20, 0)
    struct.pack_into("<I", out, 45 + 4 * slide_index.flat_index([0, 0], [2, 3]), place(0, first))
    other = place(1, 0, 7, 4_000_000_000, 40, 2)
    struct.pack_into("<I", out, 45 + 4 * slide_index.flat_index([1, 2], [2, 3]), place(0, other))
    return bytes(out)


@query("SELECT CAST(a AS INTEGER) AS level, CAST(b AS INTEGER) AS filter, CAST(c AS BIGINT) AS image_index, CAST(d AS BIGINT) AS \"offset\", CAST(e AS BIGINT) AS length, CAST(f AS BIGINT) AS file_number FROM (VALUES (0, 0, 4, 100, 10, 0), (0, 0, 5, 200, 20, 0), (0, 0, 9, 300, 30, 1), (1, 2, 7, 4000000000, 40, 2)) AS t(a, b, c, d, e, f)")
def slide_index_scan(spark, sf_dir):
    files = spark.createDataFrame([("Index.dat", bytearray(index_bytes()))], "path string, content binary")
    return slide_index.scan_index_files(files, "s" * 32, [2, 3], [0, 0], 0, 1)


RINGS = {
    "square": [(0, 0), (4, 0), (4, 4), (0, 4)], "bow-tie": [(0, 0), (4, 4), (4, 0), (0, 4)], "two-points": [(0, 0), (1, 1)], "spike": [(0, 0), (4, 0), (2, 0), (2, 3)],
    "nan": [(0, 0), (float("nan"), 1), (1, 0)], "closed": [(0, 0), (2, 0), (1, 2), (0, 0)], "touching": [(0, 0), (4, 0), (4, 4), (2, 0), (0, 4)],
}


@query("SELECT id, valid, CAST(area AS DOUBLE) AS area, inside FROM (VALUES ('square', true, 16, true), ('bow-tie', false, NULL, NULL), ('two-points', false, NULL, NULL), ('spike', false, NULL, NULL), ('nan', false, NULL, NULL), ('closed', true, 2, true), ('touching', false, NULL, NULL)) AS t(id, valid, area, inside)")
def polygon_validity(spark, sf_dir):
    rows = spark.createDataFrame([(k, [{"x": float(x), "y": float(y)} for x, y in v]) for k, v in RINGS.items()], f"id string, ring {geometry.RING}")
    rows = rows.withColumn("valid", geometry.is_valid_ring("ring"))
    ring = F.col("ring")
    return rows.select("id", "valid", F.when(F.col("valid"), F.abs(geometry.signed_area(ring))).alias("area"), F.when(F.col("valid"), geometry.contains(ring, F.lit(1.0), F.lit(0.5))).alias("inside"))


@query("SELECT id, CAST(ring AS INTEGER) AS ring, CAST(vertices AS INTEGER) AS vertices, CAST(area AS DOUBLE) AS area FROM (VALUES ('a', 0, 5, 16), ('a', 1, 5, 1)) AS t(id, ring, vertices, area)")
def geojson_polygons(spark, sf_dir):
    text = '{"type":"FeatureCollection","features":[{"id":"a","properties":{"k":"v"},"geometry":{"type":"Polygon","coordinates":[[[0,0],[4,0],[4,4],[0,4],[0,0]],[[1,1],[2,1],[2,2],[1,2],[1,1]]]}},{"id":"p","properties":{},"geometry":{"type":"Point","coordinates":[1,2]}}]}'
    rings = tables.polygon_rings(tables.geojson_features(spark.createDataFrame([(text,)], "text string")))
    return rings.select("id", "ring", F.size("points").alias("vertices"), F.abs(geometry.signed_area(F.col("points"))).alias("area"))


@query("SELECT path, reason FROM (VALUES ('b', 'version'), ('c', 'unreadable'), ('d', 'incomplete'), ('e', 'counts')) AS t(path, reason)")
def run_catalogue_skipped(spark, sf_dir):
    good = '{"schemaVersion":1,"status":"complete","algorithm":"raw-tile-if-v1","counts":{"measured":2,"rejected":1,"proposed":3}}'
    rows = [("a", good, False), ("b", good.replace(":1,", ":2,", 1), False), ("c", "{", False), ("d", good, True), ("e", good.replace(':3}', ':4}'), False)]
    return tables.run_catalogue(spark.createDataFrame(rows, "path string, text string, incomplete boolean"))[1]


@query()
def segmentation_udtf(spark, sf_dir):
    """Connected areas of positive pixels, by tiles with a halo; the tests hold it against one image."""
    lines = table(spark, sf_dir, "lineitem")
    return segment.segment_tiles(lines.select((F.col("l_orderkey") % 65_536).alias("x"), (F.col("l_partkey") % 65_536).alias("y")), 1024, 32)


@query("SELECT CAST(NULL AS INTEGER) AS mask, CAST(NULL AS BIGINT) AS masks_n, CAST(NULL AS BIGINT) AS stats_n WHERE false")
def mask_finish_check(spark, sf_dir):
    """Codes of the whole raster against the statistics of its region: no differences."""
    lines = table(spark, sf_dir, "lineitem")
    code = pixel.label_code(mask(), pixel.inside(F.col("l_partkey"), F.col("l_suppkey"), whole_pixels(REGION)))
    return masks.finish_differences(lines.select(code.alias("code")), marker.histogram(sampled(spark, sf_dir), mask()))


@query("SELECT CAST(2 AS INTEGER) AS levels, CAST(2 AS INTEGER) AS channels, ['Data0000.dat'] AS files, CAST(5 AS BIGINT) AS position_record, false AS compressed, 'Z' AS first_channel_storage")
def slide_metadata(spark, sf_dir):
    """All of a slide's metadata as one row."""
    m = ini.metadata(ini_rows(spark))
    return m.select(F.size("levels").alias("levels"), F.size("channels").alias("channels"), F.transform("data_files", lambda f: f["name"]).alias("files"), "position_record", "compressed",
                    F.when(F.get("channels", F.lit(0))["filter_level_index"] == 0, "Z").alias("first_channel_storage"))


@query("SELECT s_suppkey AS slide, CAST(u.k AS INTEGER) AS camera, CAST((s_suppkey * 10 + u.k) * 4 AS BIGINT) AS x, CAST((-s_nationkey - u.k) * 4 AS BIGINT) AS y FROM supplier, (SELECT unnest([0, 1, 2]) AS k) u")
def stitch_position_rows(spark, sf_dir):
    """Records of nine bytes, made from the table and read back; every other slide's are compressed."""
    import pandas as pd

    def pack(batches):
        for b in batches:
            raw = [b"".join(struct.pack("<Bii", k & 1, s * 10 + k, -n - k) for k in range(3)) for s, n in zip(b["s_suppkey"].tolist(), b["s_nationkey"].tolist(), strict=True)]
            packed = (b["s_suppkey"] % 2 == 1).tolist()
            yield pd.DataFrame({"file": b["s_suppkey"].astype(str), "payload": [zlib.compress(r) if p else r for r, p in zip(raw, packed, strict=True)], "compressed": packed, "concat": 2})

    records = table(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey").mapInPandas(pack, "file string, payload binary, compressed boolean, concat int")
    return slide_index.positions(records).select(F.col("file").cast("long").alias("slide"), "camera", "x", "y")



@query("""WITH t AS (SELECT (l_partkey % 512) // 32 AS tx, (l_suppkey % 64) // 32 AS ty, min(code) AS low, max(code) AS high, count(*) FILTER (code > 0) AS roi_pixels,
  sha256(string_agg(((l_suppkey % 64) % 32) || ':' || ((l_partkey % 512) % 32) || ':' || code, ',' ORDER BY (l_suppkey % 64) % 32, (l_partkey % 512) % 32, code)) AS h
  FROM (SELECT l_partkey, l_suppkey, CASE WHEN l_quantity >= 40 THEN 2 ELSE 1 END AS code FROM lineitem) GROUP BY 1, 2)
SELECT count(*) AS tiles, count(DISTINCT h) AS contents, CAST(sum(roi_pixels) AS BIGINT) AS roi_pixels FROM t""")
def mask_tile_store(spark, sf_dir):
    """Tiles of codes, each content once."""
    lines = table(spark, sf_dir, "lineitem")
    code = pixel.label_code(F.when(F.col("l_quantity") >= 40, 1).otherwise(0), F.lit(True))
    tiles = masks.mask_tiles(lines.select((F.col("l_partkey") % 512).alias("px"), (F.col("l_suppkey") % 64).alias("py"), code.alias("code")), 32)
    return tiles.agg(F.count("*").alias("tiles"), F.count_distinct("sha256").alias("contents"), F.sum("roi_pixels").alias("roi_pixels"))


@query("""SELECT CAST(mask AS INTEGER) AS mask, label, shapes, round(CAST(hue AS DOUBLE), 9) AS hue FROM (SELECT p_size % 4 AS mask, count(*) AS shapes FROM part GROUP BY 1) JOIN (VALUES (0, '', NULL), (1, 'A', 0.61803398875), (2, 'B', 0.2360679775), (3, 'A+B', 0.85410196625)) AS t(m, label, hue) ON m = mask""")
def classification_legend(spark, sf_dir):
    """Distinct masks with their labels, colours and numbers of shapes."""
    rows = masks.classification(table(spark, sf_dir, "part").select((F.col("p_size") % 4).alias("mask")), ["A", "B"])
    return rows.withColumn("hue", F.round("hue", 9))
