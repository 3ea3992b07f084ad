"""Tiles, buckets, stitching, subtiles, level choice and pyramid geometry over the driver's tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import raster, spatial
from ._register import query, table

DOWNSAMPLES = [float(1 << k) for k in range(10)]

_PART_RECT = "(p_partkey * 37) % 4096 AS lx, (p_partkey * 91) % 4096 AS ly, CAST(p_size + 1 AS BIGINT) AS lw, CAST(p_size % 20 + 1 AS BIGINT) AS lh"
_TILE_RECT = "(s_suppkey * 613) % 4096 AS rx, (s_suppkey * 271) % 4096 AS ry, 128 AS rw, 128 AS rh"


def part_rects(spark, sf_dir):
    k, s = F.col("p_partkey"), F.col("p_size").cast("long")
    return table(spark, sf_dir, "part").select(k.alias("l_id"), (k * 37 % 4096).alias("lx"), (k * 91 % 4096).alias("ly"), (s + 1).alias("lw"), (s % 20 + 1).alias("lh"))


@query(f"""SELECT p_partkey AS l_id, s_suppkey AS r_id FROM (SELECT p_partkey, {_PART_RECT} FROM part), (SELECT s_suppkey, {_TILE_RECT} FROM supplier)
WHERE lx < rx + rw AND rx < lx + lw AND ly < ry + rh AND ry < ly + lh""")
def tile_bucket_overlap_join(spark, sf_dir):
    k = F.col("s_suppkey")
    tiles = table(spark, sf_dir, "supplier").select(k.alias("r_id"), (k * 613 % 4096).alias("rx"), (k * 271 % 4096).alias("ry"), F.lit(128).alias("rw"), F.lit(128).alias("rh"))
    return spatial.overlap_join(part_rects(spark, sf_dir), tiles, 128).select("l_id", "r_id")


@query(f"""SELECT p_partkey AS object, count(*) AS pixels FROM (SELECT p_partkey, {_PART_RECT} FROM part), (SELECT (l_partkey * 3) % 4096 + 0.5 AS x, (l_orderkey * 7) % 4096 + 0.5 AS y FROM lineitem)
WHERE x >= lx AND x < lx + lw AND y >= ly AND y < ly + lh GROUP BY 1""")
def pixels_in_objects(spark, sf_dir):
    """Many-to-many: overlapping objects each get the pixel."""
    lines = table(spark, sf_dir, "lineitem")
    points = lines.select((F.col("l_partkey") * 3 % 4096 + 0.5).alias("x"), (F.col("l_orderkey") * 7 % 4096 + 0.5).alias("y"))
    objects = part_rects(spark, sf_dir).toDF("object", "ox", "oy", "ow", "oh")
    return spatial.points_in_objects(points, objects, F.lit(True), 64).groupBy("object").agg(F.count("*").alias("pixels"))


@query("""SELECT px, py, quantity, discount FROM (SELECT l_partkey % 512 AS px, l_suppkey % 64 AS py, l_quantity AS quantity, l_discount AS discount,
  row_number() OVER (PARTITION BY l_partkey % 512, l_suppkey % 64 ORDER BY l_shipdate DESC, l_orderkey DESC, l_linenumber DESC, l_quantity DESC, l_discount DESC) AS k FROM lineitem) WHERE k = 1""")
def last_writer_wins_stitch(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem").select((F.col("l_partkey") % 512).alias("px"), (F.col("l_suppkey") % 64).alias("py"), F.col("l_quantity").alias("quantity"),
                                                    F.col("l_discount").alias("discount"), "l_shipdate", "l_orderkey", "l_linenumber")
    return raster.last_writer(lines, F.struct("l_shipdate", "l_orderkey", "l_linenumber", "quantity", "discount"), ["quantity", "discount"], "px", "py")


@query("""WITH i AS (SELECT p_partkey AS image, a AS part_x, b AS part_y, p_partkey % 64 + a * 2 AS gx, (p_partkey // 64) % 64 + b * 2 AS gy FROM part, (SELECT unnest([0, 1]) AS a), (SELECT unnest([0, 1]) AS b))
SELECT image, CAST(part_x AS INTEGER) AS part_x, CAST(part_y AS INTEGER) AS part_y, gx, gy FROM i WHERE gx < 64 AND gy < 64 AND (gy // 2) * 32 + gx // 2 IN (SELECT s_suppkey FROM supplier WHERE s_suppkey = 0 OR s_nationkey % 2 <> 0)""")
def subtile_explode_active(spark, sf_dir):
    """Places on the grid are used again by later images: 4,096 lies where 0 does."""
    images = table(spark, sf_dir, "part").select(F.col("p_partkey").alias("number"), (F.col("p_partkey") % (64 * 64)).alias("image"))
    cells = raster.explode_subtiles(images, 2, 2, 64, 64).withColumn("camera", raster.camera(F.col("gx"), F.col("gy"), 2, 32))
    cameras = table(spark, sf_dir, "supplier").where(raster.active_camera(F.col("s_suppkey"), F.col("s_nationkey") % 2, F.lit(0)))
    return cells.join(cameras.select(F.col("s_suppkey").alias("camera")), "camera", "left_semi").select(F.col("number").alias("image"), "part_x", "part_y", "gx", "gy")


@query(f"""SELECT p_partkey AS id, lx >= 0 AND ly >= 0 AND lw > 0 AND lh > 0 AND lx + lw <= 3000 AND ly + lh <= 2500 AS in_bounds,
  greatest(lx, 500) AS clip_x, greatest(least(lx + lw, 2000) - greatest(lx, 500), 0) AS clip_w FROM (SELECT p_partkey, {_PART_RECT} FROM part)""")
def region_bounds_filter(spark, sf_dir):
    c = F.col
    at, size = spatial.clip(c("lx"), c("lw"), 500, 2000)
    return part_rects(spark, sf_dir).select(c("l_id").alias("id"), spatial.in_bounds(c("lx"), c("ly"), c("lw"), c("lh"), 3000, 2500).alias("in_bounds"), at.alias("clip_x"), size.alias("clip_w"))


@query("""WITH g AS (SELECT a * 50 AS x, b * 5 AS y, least(50, 2000 - a * 50) AS w, least(5, 100 - b * 5) AS h, a AS tx, b AS ty FROM (SELECT unnest(range(0, 40)) AS a), (SELECT unnest(range(0, 20)) AS b))
SELECT CAST(x AS INTEGER) AS x, CAST(y AS INTEGER) AS y, CAST(w * h AS BIGINT) AS pixels FROM g WHERE NOT EXISTS (SELECT 1 FROM lineitem WHERE l_partkey // 7 = tx AND l_suppkey // 5 = ty)""")
def certified_empty_tiles(spark, sf_dir):
    """Tiles that nothing is stored in: their pixels are counted from their size, without a scan of them."""
    lines = table(spark, sf_dir, "lineitem")
    stored = lines.select(F.floor(F.col("l_partkey") / 7).alias("tx"), F.floor(F.col("l_suppkey") / 5).alias("ty"))
    # Tiles of 50 x 5: the grid is made at the finer step and thinned to it.
    tiles = raster.tile_grid(2000, 20, 50, spark.range(1)).select("x", "w").distinct().withColumn("ty", F.explode(F.sequence(F.lit(0), F.lit(19))))
    tiles = tiles.select((F.col("x") / 50).cast("long").alias("tx"), F.col("ty").cast("long").alias("ty"), "x", (F.col("ty") * 5).alias("y"), (F.col("w") * 5).cast("long").alias("pixels"))
    return spatial.certified_empty(tiles, stored).select("x", "y", "pixels")


@query("""SELECT event_id, CAST(coalesce(max(level) FILTER (value >= pow(2.0::DOUBLE, level)), 0) AS INTEGER) AS level FROM (SELECT event_id, value, unnest(range(0, 10)) AS level FROM events) GROUP BY 1""")
def asof_native_level(spark, sf_dir):
    return table(spark, sf_dir, "events").select("event_id", raster.backward_level(F.col("value"), DOWNSAMPLES).cast("int").alias("level"))


@query("""WITH d AS (SELECT event_id, value, unnest(range(0, 10)) AS level FROM events)
SELECT event_id, CAST(arg_min(level, abs(ln(greatest(value, 0.001) / pow(2.0::DOUBLE, level))) + level * 1e-12) AS INTEGER) AS level FROM d GROUP BY 1""")
def nearest_native_level(spark, sf_dir):
    return table(spark, sf_dir, "events").select("event_id", raster.nearest_level(F.greatest("value", F.lit(0.001)), DOWNSAMPLES).alias("level"))


@query("""WITH l(level, concat) AS (VALUES (0, 0), (1, 1), (2, 1), (3, 2)), s AS (SELECT *, pow(2.0::DOUBLE, sum(concat) OVER (ORDER BY level)) AS scale FROM l)
SELECT CAST(level AS INTEGER) AS level, scale, scale / first_value(scale) OVER (ORDER BY level) AS downsample, CAST(greatest(ceil(85280 / scale), 1) AS BIGINT) AS width, CAST(greatest(ceil(190235 / scale), 1) AS BIGINT) AS height FROM s""")
def pyramid_geometry(spark, sf_dir):
    levels = spark.createDataFrame([(0, 0), (1, 1), (2, 1), (3, 2)], "level int, concat int")
    return raster.level_geometry(levels, 85_280, 190_235).select("level", "scale", "downsample", F.col("width").cast("long"), F.col("height").cast("long"))


@query("""SELECT s_suppkey, (s_suppkey + 1) * 100 - ((s_suppkey + 1 - 1) // 4) * (s_nationkey % 7) AS extent FROM supplier""")
def stitched_extent(spark, sf_dir):
    images = F.col("s_suppkey") + 1
    return table(spark, sf_dir, "supplier").select("s_suppkey", raster.stitched_extent(images, F.lit(100), F.lit(4), F.col("s_nationkey") % 7).cast("long").alias("extent"))
