"""Segmentation as a table function: tiles with a halo go to a segmenter, objects to their owner tile."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

OBJECTS = "tile_x INT, tile_y INT, object_x BIGINT, object_y BIGINT, pixels BIGINT"


def connected(image: np.ndarray) -> np.ndarray:
    """Labels of 4-connected areas: each pixel takes the least label around it until nothing changes."""
    labels = np.where(image, np.arange(1, image.size + 1).reshape(image.shape), 0)
    while True:
        big = np.where(labels > 0, labels, image.size + 1)
        low = big.copy()
        low[1:] = np.minimum(low[1:], big[:-1])
        low[:-1] = np.minimum(low[:-1], big[1:])
        low[:, 1:] = np.minimum(low[:, 1:], big[:, :-1])
        low[:, :-1] = np.minimum(low[:, :-1], big[:, 1:])
        new = np.where(labels > 0, low, 0)
        if (new == labels).all():
            return labels
        labels = new


def segment_tiles(pixels: DataFrame, tile: int, halo: int, segmenter: Callable[[np.ndarray], np.ndarray] = connected) -> DataFrame:
    """Objects of positive pixels (x, y): their first pixel and size.

    Each pixel goes to its tile and to the tiles whose halo it lies in. An object is reported
    by the tile that owns its first pixel in reading order, so objects that reach no farther
    than the halo beyond that tile are whole. One that reaches the halo's edge may go on
    beyond it: that is an error, which a wider halo mends, and never a cut object.
    """
    span = lambda c: F.sequence(F.floor((F.col(c) - halo) / tile), F.floor((F.col(c) + halo) / tile))
    dealt = pixels.select("x", "y").distinct().withColumn("tx", F.explode(span("x"))).withColumn("ty", F.explode(span("y")))

    def run(x: pd.DataFrame) -> pd.DataFrame:
        tx, ty = int(x["tx"].iloc[0]), int(x["ty"].iloc[0])
        left, top, side = tx * tile - halo, ty * tile - halo, tile + 2 * halo
        image = np.zeros((side, side), bool)
        px, py = x["x"].to_numpy() - left, x["y"].to_numpy() - top
        inside = (px < side) & (py < side)
        image[py[inside], px[inside]] = True
        labels = segmenter(image)
        found, first, count = np.unique(labels, return_index=True, return_counts=True)
        oy, ox = np.divmod(first, side)
        edge = np.unique(np.concatenate([labels[0], labels[-1], labels[:, 0], labels[:, -1]]))
        own = (found > 0) & (ox >= halo) & (ox < halo + tile) & (oy >= halo) & (oy < halo + tile)
        if np.isin(found[own], edge).any():
            raise ValueError(f"an object of tile {tx}, {ty} reaches the edge of its halo of {halo} pixels")
        return pd.DataFrame({"tile_x": tx, "tile_y": ty, "object_x": ox[own] + left, "object_y": oy[own] + top, "pixels": count[own]})

    return dealt.groupBy("tx", "ty").applyInPandas(run, OBJECTS)


def reconcile_tiles(scheduled: int, processed: int, failed: int) -> None:
    """A tiled run counts only if every scheduled tile was processed."""
    if scheduled <= 0 or processed != scheduled or failed:
        raise ValueError(f"{processed} of {scheduled} tiles, {failed} failed")
