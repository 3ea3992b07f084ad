"""Validated configuration: profiles, regions, display ranges, segmentation settings."""

from __future__ import annotations

import math
from dataclasses import dataclass

MAX_MARKERS = 8


def _need(ok: bool, what: str) -> None:
    if not ok:
        raise ValueError(what)


@dataclass(frozen=True)
class Marker:
    """A channel that is gated: thresholds for pixels, nucleus means and cytoplasm means."""

    channel: int
    name: str
    pixel: float
    nucleus: float
    cytoplasm: float


@dataclass(frozen=True)
class Profile:
    """One analysis: a pyramid level and 1 to 8 markers; bit j of a mask is markers[j]."""

    level: int
    markers: tuple[Marker, ...]
    schema_version: int = 1

    def __post_init__(self):
        _need(self.schema_version == 1, "unknown profile version")
        _need(self.level >= 0, "level must not be negative")
        _need(1 <= len(self.markers) <= MAX_MARKERS, "1 to 8 markers")
        _need(len({m.channel for m in self.markers}) == len(self.markers), "channels must differ")
        _need(len({m.name for m in self.markers}) == len(self.markers), "names must differ")
        for m in self.markers:
            _need(bool(m.name.strip()) and m.channel >= 0, "marker needs a name and a channel")
            _need(all(math.isfinite(t) for t in (m.pixel, m.nucleus, m.cytoplasm)), "thresholds must be finite")


@dataclass(frozen=True)
class Region:
    """Half-open rectangles (x0, y0, x1, y1) to take, less those to leave out."""

    include: tuple[tuple[float, float, float, float], ...]
    exclude: tuple[tuple[float, float, float, float], ...] = ()

    def __post_init__(self):
        _need(bool(self.include), "region must not be empty")
        for r in (*self.include, *self.exclude):
            _need(all(math.isfinite(v) for v in r) and r[0] < r[2] and r[1] < r[3], "rectangles need finite, ordered bounds")


@dataclass(frozen=True)
class DisplayChannel:
    """Linear range; the end points are compared in single precision."""

    name: str
    low: float
    high: float
    rgb: int
    selected: bool = True

    def __post_init__(self):
        _need(self.low < self.high, "display range must ascend")


@dataclass(frozen=True)
class DisplayProfile:
    gamma: float
    channels: tuple[DisplayChannel, ...]

    def __post_init__(self):
        _need(0.01 <= self.gamma <= 10, "gamma is 0.01 to 10")
        _need(bool(self.channels), "no channels")


@dataclass(frozen=True)
class TiledInference:
    """Settings of a tiled model: 1 to 4 threads; padding is at least 16 and under half a tile."""

    threads: int = 1
    tile: int = 512
    padding: int = 32

    def __post_init__(self):
        _need(1 <= self.threads <= 4, "1 to 4 threads")
        _need(self.tile in (256, 512, 1024), "tile is 256, 512 or 1024")
        _need(16 <= self.padding < self.tile / 2, "padding is 16 to under half a tile")


@dataclass(frozen=True)
class Watershed:
    background_um: float = 8.0
    median_um: float = 0.0
    sigma_um: float = 1.0

    def __post_init__(self):
        _need(all(math.isfinite(v) and v >= 0 for v in (self.background_um, self.median_um, self.sigma_um)), "radii must not be negative")
