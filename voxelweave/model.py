"""Data model shared by every operator.

Two physical forms of one volume:

* voxel form ``(round, channel, z, y, x, value)`` -- sparse, a missing row is background 0;
* block form ``(round, channel, bz, by, bx, z0, y0, x0, nz, ny, nx, dtype, data)`` -- dense,
  one row per block, ``data`` in C order, little endian.

Axis order is always z, y, x.
"""

from __future__ import annotations

from dataclasses import dataclass

AXES = ("z", "y", "x")
UINT16_MAX = 65535

BLOCK_KEY = ("bz", "by", "bx")
BLOCK_SCHEMA = (
    "round string, channel string, bz int, by int, bx int, z0 bigint, y0 bigint, x0 bigint, "
    "nz int, ny int, nx int, dtype string, data binary"
)
VOXEL_SCHEMA = "round string, channel string, z bigint, y bigint, x bigint, value bigint"

# Display colours given to channels without a configured one.
DEFAULT_COLOR = "#ffffff"
NUCLEAR_STAIN_COLOR = "#0080ff"
DEFAULT_OPACITY = 0.8
DEFAULT_PERCENTILES = (1.0, 99.9)
DEFAULT_MIN_OBJECT_SIZE = 100
DEFAULT_PAD_XY = 25
DEFAULT_PAGE_SIZE = 10
MAX_PAGE_SIZE = 100


@dataclass(frozen=True)
class Shape:
    """Extent of a dense volume in voxels."""

    nz: int
    ny: int
    nx: int

    def __iter__(self):
        return iter((self.nz, self.ny, self.nx))

    @property
    def size(self) -> int:
        return self.nz * self.ny * self.nx

    def scaled_down(self, factors) -> "Shape":
        return Shape(*(int(n / f) for n, f in zip(self, factors)))

    def scaled_up(self, factors) -> "Shape":
        return Shape(*(int(n * f) for n, f in zip(self, factors)))

    def common(self, other: "Shape") -> "Shape":
        return Shape(*(min(a, b) for a, b in zip(self, other)))


def check_percentile_range(bounds) -> tuple[float, float]:
    """Return ``(lo, hi)`` or raise when not ``0 <= lo < hi <= 100``."""
    if len(bounds) != 2 or not 0 <= bounds[0] < bounds[1] <= 100:
        raise ValueError("percentile range must be (lo, hi) with 0 <= lo < hi <= 100")
    return float(bounds[0]), float(bounds[1])
