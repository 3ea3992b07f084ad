"""Pyramid levels, tile grids, level choice and stitching."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window


def level_geometry(levels: DataFrame, width: int, height: int) -> DataFrame:
    """Adds scale (product of the 2^concat so far), downsample against level 0, and dims, rounded up, at least 1."""
    upto = Window.orderBy("level").rowsBetween(Window.unboundedPreceding, 0)  # a row for each level of one pyramid
    out = levels.withColumn("scale", F.pow(F.lit(2.0), F.sum("concat").over(upto)))
    out = out.withColumn("downsample", F.col("scale") / F.first("scale").over(upto))
    return out.withColumn("width", F.greatest(F.ceil(F.lit(width) / F.col("downsample")), F.lit(1))).withColumn(
        "height", F.greatest(F.ceil(F.lit(height) / F.col("downsample")), F.lit(1)))


def stitched_extent(images: Column, size: Column, divisions: Column, overlap: Column) -> Column:
    """Width of a row of images: overlaps are taken off at each camera's end but the last."""
    ends = F.floor((images - 1) / divisions)
    return images * size - ends * overlap


def tile_grid(width: int, height: int, tile: int, frame: DataFrame) -> DataFrame:
    """All tiles that cover an image of one level; frame: a one-row DataFrame to hang them on."""
    xs = F.explode(F.sequence(F.lit(0), F.lit(max(0, (width - 1) // tile)))).alias("tx")
    ys = F.explode(F.sequence(F.lit(0), F.lit(max(0, (height - 1) // tile)))).alias("ty")
    grid = frame.select(xs).select("tx", ys)
    clip = lambda at, full: F.least(F.lit(tile), F.lit(full) - F.col(at) * tile)
    return grid.select((F.col("tx") * tile).alias("x"), (F.col("ty") * tile).alias("y"), clip("tx", width).alias("w"), clip("ty", height).alias("h"))


def backward_level(requested: Column, downsamples: list[float]) -> Column:
    """As-of: the coarsest level that isn't coarser than asked for, 0 if none. Levels ascend and are few."""
    out = F.lit(0)
    for level, d in enumerate(downsamples):
        out = F.when(requested >= d, level).otherwise(out)
    return out


def nearest_level(requested: Column, downsamples: list[float]) -> Column:
    """The level whose downsample is nearest in ratio; ties go to the finer one."""
    far = [F.abs(F.log(requested / d)) for d in downsamples]
    return F.array_min(F.array(*[F.struct(d.alias("far"), F.lit(i).alias("level")) for i, d in enumerate(far)]))["level"]


def last_writer(placed: DataFrame, order: Column, values: list[str], *keys: str) -> DataFrame:
    """Overlapping rows of a key: the one latest in composition order wins, a zero too."""
    return placed.groupBy(*keys).agg(F.max_by(F.struct(*values), order).alias("v")).select(*keys, "v.*")


def explode_subtiles(images: DataFrame, parts: int, divisions: int, grid_x: int, grid_y: int) -> DataFrame:
    """(image, gx, gy, part_x, part_y): every stored image in parts x parts crops that lie on the grid.

    images: (image, ...) with image = gx + gy * grid_x.
    """
    cells = images.withColumn("part_x", F.explode(F.sequence(F.lit(0), F.lit(parts - 1)))).withColumn("part_y", F.explode(F.sequence(F.lit(0), F.lit(parts - 1))))
    cells = cells.withColumn("gx", F.col("image") % grid_x + F.col("part_x") * divisions).withColumn("gy", F.floor(F.col("image") / grid_x) + F.col("part_y") * divisions)
    return cells.where((F.col("gx") < grid_x) & (F.col("gy") < grid_y))


def camera(gx: Column, gy: Column, divisions: int, across: int) -> Column:
    return F.floor(gy / divisions) * across + F.floor(gx / divisions)


def active_camera(number: Column, x: Column, y: Column) -> Column:
    """Camera 0 always; others where they have been moved."""
    return (number == 0) | (x != 0) | (y != 0)
