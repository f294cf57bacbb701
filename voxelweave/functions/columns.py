"""Small column builders used across operators."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from voxelweave.model import AXES, UINT16_MAX, Shape

DECIMALS = 6


def f32(value) -> Column:
    """Single-precision value; intensity math follows float32 like the display code expects."""
    return (value if isinstance(value, Column) else F.lit(value)).cast("float")


def f32_divide(a: Column, b: Column) -> Column:
    """float32 quotient (Spark divides in double; one final rounding gives the same result)."""
    return F.try_divide(a.cast("double"), b.cast("double")).cast("float")


def clip(value: Column, lo, hi) -> Column:
    return F.greatest(F.least(value, F.lit(hi).cast("float")), F.lit(lo).cast("float"))


def clip_uint16(value: Column) -> Column:
    return clip(value, 0.0, float(UINT16_MAX))


def half_even(value: Column) -> Column:
    return F.rint(value).cast("bigint")


def half_up(value: Column) -> Column:
    """Round half up; pre-rounding makes the result independent of summation order."""
    return F.floor(F.round(value.cast("double"), DECIMALS) + F.lit(0.5)).cast("bigint")


def truncate(value: Column) -> Column:
    return F.floor(value).cast("bigint")


def within(shape: Shape) -> Column:
    """Predicate selecting voxels inside ``shape``; pushed down to the scan."""
    cond = F.lit(True)
    for axis, n in zip(AXES, shape):
        cond = cond & (F.col(axis) >= 0) & (F.col(axis) < n)
    return cond


def linear_index(shape: Shape, z="z", y="y", x="x") -> Column:
    return (F.col(z) * shape.ny + F.col(y)) * shape.nx + F.col(x)


def axis_columns(index: Column, shape: Shape) -> dict[str, Column]:
    """z, y, x columns of a row-major linear index (integer arithmetic only)."""
    i = index.cast("bigint")
    plane = F.lit(shape.ny * shape.nx).cast("bigint")
    row = F.lit(shape.nx).cast("bigint")
    in_plane = i % plane
    return {
        "z": F.floor((i - in_plane) / plane).cast("bigint"),
        "y": F.floor((in_plane - in_plane % row) / row).cast("bigint"),
        "x": in_plane % row,
    }
