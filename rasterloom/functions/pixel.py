"""Expressions on pixels: centres, bitmasks, labels, display colours. All compile to JVM code."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..model import Region


def centre(tile: Column, offset: Column, downsample: Column | float) -> Column:
    """Source coordinate of a pixel's centre."""
    return (tile + offset + 0.5) * downsample


def stored_band(component: Column, bands: Column) -> Column:
    """Band of a packed component: colour order is reversed where there are three bands or more."""
    return F.when((bands >= 3) & component.between(0, 2), 2 - component).otherwise(F.least(F.greatest(component, F.lit(0)), bands - 1))


def inside(x: Column, y: Column, region: Region) -> Column:
    """Half-open membership of a region with holes."""
    within = lambda r: (x >= r[0]) & (x < r[2]) & (y >= r[1]) & (y < r[3])
    taken = reduce(lambda a, b: a | b, [within(r) for r in region.include])
    return reduce(lambda a, r: a & ~within(r), region.exclude, taken)


def bitmask(values: list[Column], thresholds: list[float]) -> Column:
    """Bit j is set where value j is at least threshold j; a value that isn't finite is an error."""
    def bit(v: Column, t: float, j: int) -> Column:
        v = v.cast("double")
        bad = F.isnan(v) | (F.abs(v) == float("inf"))
        return F.when(bad, F.raise_error(F.lit("a selected sample is not finite")).cast("int")).when(v >= t, F.lit(1 << j)).otherwise(F.lit(0))
    return reduce(lambda a, b: a.bitwiseOR(b), [bit(v, t, j) for j, (v, t) in enumerate(zip(values, thresholds, strict=True))])


def zero_mask(thresholds: list[float]) -> int:
    """Mask of an all-zero pixel."""
    return sum(1 << j for j, t in enumerate(thresholds) if t <= 0)


def label_code(mask: Column, is_inside: Column) -> Column:
    """Mask + 1 inside the region, 0 outside."""
    return F.when(is_inside, mask + 1).otherwise(F.lit(0))


def label_matches(code: Column, required: Column | int, exact: bool = False) -> Column:
    """Codes of 0 never match; required 0 asks for any positive; exact for equality; else for a superset."""
    required = F.lit(required) if isinstance(required, int) else required
    mask = code - 1
    wanted = (mask == required) if exact else (mask.bitwiseAND(required) == required)
    return F.when(code == 0, False).when(required == 0, mask > 0).otherwise(wanted)


def outline_matches(mask: Column, required: int, exact: bool = False) -> Column:
    """As label_matches, but required 0 filters nothing."""
    return F.lit(True) if required == 0 else (mask == required) if exact else (mask.bitwiseAND(F.lit(required)) == required)


def label_text(mask: Column, names: list[str]) -> Column:
    """Names of the set bits in marker order, joined by '+'."""
    return F.concat_ws("+", *[F.when(mask.bitwiseAND(F.lit(1 << j)) != 0, F.lit(n)) for j, n in enumerate(names)])


def rescale(v: Column, low: float, high: float) -> Column:
    """Linear, clamped to 0..1; 0 where the range doesn't ascend."""
    return F.least(F.greatest((v - low) / (high - low), F.lit(0.0)), F.lit(1.0)) if high > low else F.lit(0.0)


def additive_component(scaled: list[Column], parts: list[int]) -> Column:
    """One colour component of the additive composite, saturating at 255; halves round up."""
    return F.least(F.lit(255), reduce(lambda a, b: a + b, [F.floor(s * p + 0.5) for s, p in zip(scaled, parts, strict=True)])).cast("int")


def gamma_value(i: Column, gamma: float) -> Column:
    """Entry i of the 256-entry gamma table."""
    return F.least(F.lit(255.0), F.greatest(F.lit(0.0), 255 * F.pow(i / 255.0, F.lit(gamma))))


def mask_hue(mask: Column) -> Column:
    """Hue in 0..1 of a mask's pseudo-colour (golden-ratio steps); null for mask 0, which is grey."""
    turn = mask * 0.61803398875
    return F.when(mask != 0, turn - F.floor(turn))


def blank_outside(v: Column, is_inside: Column) -> Column:
    return F.when(is_inside, v).otherwise(F.lit(0))
