"""Spatial joins over grid buckets: an equi-join that Spark can shuffle, then the exact test."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.scalar import bucket


def in_buckets(rects: DataFrame, size: int, x: str, y: str, w: str, h: str) -> DataFrame:
    """A row for each grid bucket that a half-open rectangle touches: adds bx and by.

    The bucket size is to follow the objects' size, as a rectangle has about
    (w / size + 1) x (h / size + 1) rows.
    """
    last = lambda at, by: bucket(F.col(at) + F.col(by) - 1, size)
    out = rects.where((F.col(w) > 0) & (F.col(h) > 0))
    out = out.withColumn("bx", F.explode(F.sequence(bucket(F.col(x), size), last(x, w))))
    return out.withColumn("by", F.explode(F.sequence(bucket(F.col(y), size), last(y, h))))


def overlap_join(left: DataFrame, right: DataFrame, size: int = 512) -> DataFrame:
    """Pairs of overlapping half-open rectangles; left: l_id, lx, ly, lw, lh; right: r_id, rx, ry, rw, rh.

    A pair that meets in several buckets is kept only in the bucket of its overlap's corner,
    so that no pairs have to be deduplicated by a shuffle.
    """
    a, b = in_buckets(left, size, "lx", "ly", "lw", "lh"), in_buckets(right, size, "rx", "ry", "rw", "rh")
    both = a.join(b, ["bx", "by"])
    meets = (F.col("lx") < F.col("rx") + F.col("rw")) & (F.col("rx") < F.col("lx") + F.col("lw")) & (
        F.col("ly") < F.col("ry") + F.col("rh")) & (F.col("ry") < F.col("ly") + F.col("lh"))
    first = (bucket(F.greatest("lx", "rx"), size) == F.col("bx")) & (bucket(F.greatest("ly", "ry"), size) == F.col("by"))
    return both.where(meets & first).drop("bx", "by")


def covered_join(left: DataFrame, right: DataFrame, size: int, low: int, high: int, parts: int) -> DataFrame:
    """Pairs whose left rectangle covers the right one; left: lx, ly, lw, lh with sides over 0; right: rx, ry, rw, rh.

    A covered rectangle is needed only in the bucket of its corner, as that lies in the cover. One of a side
    below 0 reaches back from its corner; the pair counts in the first bucket that both touch. All corners are
    in [low, high], so longer sides are cut there. The number of parts is given, as Spark would merge them by
    the bytes that they read, while a pair may stand for many rows.
    """
    c = F.col
    back = lambda at, by: F.greatest(F.least(c(at), c(at) + c(by)), F.lit(low))
    over = lambda start, end: F.explode(F.sequence(bucket(start, size), bucket(end, size)))
    a = left.where((c("lw") > 0) & (c("lh") > 0))
    a = a.withColumn("bx", over(c("lx"), F.least(c("lx") + c("lw"), F.lit(high)))).withColumn("by", over(c("ly"), F.least(c("ly") + c("lh"), F.lit(high))))
    b = right.withColumn("bx", over(back("rx", "rw"), c("rx"))).withColumn("by", over(back("ry", "rh"), c("ry")))
    inside = covers(c("lx"), c("ly"), c("lw"), c("lh"), c("rx"), c("ry"), c("rw"), c("rh"))
    first = (bucket(F.greatest(c("lx"), back("rx", "rw")), size) == c("bx")) & (bucket(F.greatest(c("ly"), back("ry", "rh")), size) == c("by"))
    return a.repartition(parts, "bx", "by").join(b.repartition(parts, "bx", "by"), ["bx", "by"]).where(inside & first).drop("bx", "by")


def points_in_objects(points: DataFrame, objects: DataFrame, test: Column, size: int = 512) -> DataFrame:
    """Many-to-many: each point with every object that holds it. points: x, y; objects: ox, oy, ow, oh (envelope)."""
    a = points.withColumn("bx", bucket(F.col("x"), size)).withColumn("by", bucket(F.col("y"), size))
    b = in_buckets(objects, size, "ox", "oy", "ow", "oh")
    near = (F.col("x") >= F.col("ox")) & (F.col("x") < F.col("ox") + F.col("ow")) & (F.col("y") >= F.col("oy")) & (F.col("y") < F.col("oy") + F.col("oh"))
    return a.join(b, ["bx", "by"]).where(near & test).drop("bx", "by")


def certified_empty(tiles: DataFrame, *occupied: DataFrame) -> DataFrame:
    """Tiles (tx, ty) that no occupied set holds: their counts follow from their size alone."""
    out = tiles
    for o in occupied:
        out = out.join(o.select("tx", "ty").distinct(), ["tx", "ty"], "left_anti")
    return out


def covers(ox: Column, oy: Column, ow: Column, oh: Column, ix: Column, iy: Column, iw: Column, ih: Column) -> Column:
    return (ix >= ox) & (iy >= oy) & (ix + iw <= ox + ow) & (iy + ih <= oy + oh)


def clip(at: Column, size: Column, low: float, high: float) -> tuple[Column, Column]:
    """Start and length of an interval inside [low, high)."""
    start = F.greatest(at, F.lit(low))
    return start, F.greatest(F.least(at + size, F.lit(high)) - start, F.lit(0))


def in_bounds(x: Column, y: Column, w: Column, h: Column, width: int, height: int) -> Column:
    return (x >= 0) & (y >= 0) & (w > 0) & (h > 0) & (x.cast("long") + w <= width) & (y.cast("long") + h <= height)
