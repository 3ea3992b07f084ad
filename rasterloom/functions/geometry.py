"""Rings as arrays of struct(x, y): area, centroid, crossing number, validity."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

RING = "array<struct<x:double,y:double>>"


def _edges(ring: Column) -> Column:
    """(p, q) for each edge, the last one closing the ring."""
    return F.transform(ring, lambda p, i: F.struct(p.alias("p"), F.coalesce(F.get(ring, i + 1), F.get(ring, F.lit(0))).alias("q")))


def signed_area(ring: Column) -> Column:
    return F.aggregate(_edges(ring), F.lit(0.0), lambda a, e: a + e["p"]["x"] * e["q"]["y"] - e["q"]["x"] * e["p"]["y"]) / 2


def centroid(ring: Column) -> Column:
    """struct(x, y) of the area's centre."""
    cross = lambda e: e["p"]["x"] * e["q"]["y"] - e["q"]["x"] * e["p"]["y"]
    part = lambda c: F.aggregate(_edges(ring), F.lit(0.0), lambda a, e: a + (e["p"][c] + e["q"][c]) * cross(e))
    six = 6 * signed_area(ring)
    return F.struct((part("x") / six).alias("x"), (part("y") / six).alias("y"))


def contains(ring: Column, x: Column, y: Column) -> Column:
    """Crossing number: odd means inside.

    The point goes into the lambda as an argument: Spark may push a filter whose lambda captures a
    column of one side of a join below the other side.
    """
    def crosses(e: Column, at: Column) -> Column:
        p, q = e["p"], e["q"]
        spans = (p["y"] > at["y"]) != (q["y"] > at["y"])
        cut = p["x"] + (at["y"] - p["y"]) / F.nullif(q["y"] - p["y"], F.lit(0.0)) * (q["x"] - p["x"])
        return F.when(spans & (at["x"] < cut), 1).otherwise(0)

    point = F.struct(x.cast("double").alias("x"), y.cast("double").alias("y"))
    hits = F.zip_with(_edges(ring), F.array_repeat(point, F.size(ring)), crosses)
    return F.aggregate(hits, F.lit(0), lambda a, h: a + h) % 2 == 1


def envelope(ring: Column) -> Column:
    low = lambda c: F.array_min(F.transform(ring, lambda p: p[c]))
    high = lambda c: F.array_max(F.transform(ring, lambda p: p[c]))
    return F.struct(low("x").alias("x0"), low("y").alias("y0"), high("x").alias("x1"), high("y").alias("y1"))


def simple_ring(points: np.ndarray) -> bool:
    """At least three finite vertices and no two edges that cross or touch outside a shared end."""
    if len(points) and (points[0] == points[-1]).all():
        points = points[:-1]
    n = len(points)
    if n < 3 or not np.isfinite(points).all() or len(np.unique(points, axis=0)) != n:
        return False
    a, b = points, np.roll(points, -1, axis=0)
    side = lambda o, p, q: (p[..., 0] - o[..., 0]) * (q[..., 1] - o[..., 1]) - (p[..., 1] - o[..., 1]) * (q[..., 0] - o[..., 0])
    i, j = np.triu_indices(n, 2)
    apart = ~((i == 0) & (j == n - 1))
    i, j = i[apart], j[apart]
    d1, d2 = side(a[i], b[i], a[j]), side(a[i], b[i], b[j])
    d3, d4 = side(a[j], b[j], a[i]), side(a[j], b[j], b[i])
    def on(o, p, q, d):
        return (d == 0) & (np.minimum(o, p) <= q).all(-1) & (q <= np.maximum(o, p)).all(-1)
    meets = (np.sign(d1) * np.sign(d2) < 0) & (np.sign(d3) * np.sign(d4) < 0)
    meets |= on(a[i], b[i], a[j], d1) | on(a[i], b[i], b[j], d2) | on(a[j], b[j], a[i], d3) | on(a[j], b[j], b[i], d4)
    spike = side(a, b, np.roll(b, -1, axis=0)) == 0
    folded = spike & (((b - a) * (np.roll(b, -1, axis=0) - b)).sum(-1) < 0)
    return not meets.any() and not folded.any()


@F.pandas_udf(T.BooleanType())
def is_valid_ring(rings: pd.Series) -> pd.Series:
    """Whether a ring could bound a polygon as it stands; nothing is repaired."""
    out = []
    for ring in rings:
        points = [(p["x"], p["y"]) for p in ring] if ring is not None else []
        bad = any(v is None for p in points for v in p)
        out.append(not bad and simple_ring(np.array(points, float).reshape(-1, 2)))
    return pd.Series(out)


def covers_ring(outer: np.ndarray, inner: np.ndarray) -> bool:
    """Whether a simple ring's area holds another's: no vertex of one and no piece of an edge lies outside."""
    a, b = outer, np.roll(outer, -1, axis=0)
    ends = np.roll(inner, -1, axis=0)
    d, e = ends - inner, b - a
    # Edges of the inner ring are cut where they meet the outer one; no piece's middle may be outside.
    cross = d[:, None, 0] * e[None, :, 1] - d[:, None, 1] * e[None, :, 0]
    gap = a[None] - inner[:, None]
    with np.errstate(divide="ignore", invalid="ignore"):
        t = (gap[..., 0] * e[None, :, 1] - gap[..., 1] * e[None, :, 0]) / cross
        u = (gap[..., 0] * d[:, None, 1] - gap[..., 1] * d[:, None, 0]) / cross
    length = (d * d).sum(1)
    along = [(((p[None] - inner[:, None]) * d[:, None]).sum(-1) / np.maximum(length[:, None], 1e-300)) for p in (a,)][0]
    points = [inner]
    for k in range(len(inner)):
        cuts = [0.0, 1.0, *t[k][(t[k] > 0) & (t[k] < 1) & (u[k] >= 0) & (u[k] <= 1)], *along[k][(along[k] > 0) & (along[k] < 1)]]
        cuts = np.unique(cuts)
        points.append(inner[k] + ((cuts[1:] + cuts[:-1]) / 2)[:, None] * d[k])
    return bool(_within(outer, np.concatenate(points)).all())


def _within(ring: np.ndarray, points: np.ndarray) -> np.ndarray:
    """Inside or on the ring."""
    a, b = ring[None], np.roll(ring, -1, axis=0)[None]
    x, y = points[:, None, 0], points[:, None, 1]
    side = (b[..., 0] - a[..., 0]) * (y - a[..., 1]) - (b[..., 1] - a[..., 1]) * (x - a[..., 0])
    scale = np.maximum(np.abs(b - a).max(-1), 1e-300)
    near = (np.abs(side) <= 1e-9 * scale * np.maximum(1, scale)) & (x >= np.minimum(a[..., 0], b[..., 0]) - 1e-9) & (x <= np.maximum(a[..., 0], b[..., 0]) + 1e-9)
    near &= (y >= np.minimum(a[..., 1], b[..., 1]) - 1e-9) & (y <= np.maximum(a[..., 1], b[..., 1]) + 1e-9)
    spans = (a[..., 1] > y) != (b[..., 1] > y)
    with np.errstate(divide="ignore", invalid="ignore"):
        at = a[..., 0] + (y - a[..., 1]) / (b[..., 1] - a[..., 1]) * (b[..., 0] - a[..., 0])
    return near.any(1) | ((spans & (x < at)).sum(1) % 2 == 1)


@F.pandas_udf(T.BooleanType())
def ring_covers(outer: pd.Series, inner: pd.Series) -> pd.Series:
    """Whether a valid ring covers another; null where one of them is null."""
    points = lambda ring: np.array([(p["x"], p["y"]) for p in ring], float).reshape(-1, 2)
    return pd.Series([None if a is None or b is None or not len(a) or not len(b) else covers_ring(points(a), points(b)) for a, b in zip(outer, inner, strict=True)], dtype=object)


@F.pandas_udf(T.BooleanType())
def same_area(one: pd.Series, other: pd.Series) -> pd.Series:
    """Whether two valid rings bound the same area, wherever they begin and whichever way they run."""
    points = lambda ring: np.array([(p["x"], p["y"]) for p in ring], float).reshape(-1, 2)
    both = [(None, None) if a is None or b is None else (points(a), points(b)) for a, b in zip(one, other, strict=True)]
    return pd.Series([None if a is None else covers_ring(a, b) and covers_ring(b, a) for a, b in both], dtype=object)


def source_to_device(v: Column, origin: Column | float, scale: Column | float) -> Column:
    return (v - origin) * scale
