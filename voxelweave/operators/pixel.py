"""Pixel-wise operators on the voxel form: scaling, merging, selection, reorientation."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from voxelweave.functions.columns import clip_uint16, f32, half_even, truncate, within
from voxelweave.model import AXES, UINT16_MAX, Shape

VOLUME = ["round", "channel"]
MERGE_STRATEGIES = ("mean", "max", "stack")
REGISTRATION_SUFFIX = "_registration"


def volume_range(voxels: DataFrame, shape: Shape) -> DataFrame:
    """Global minimum and maximum of each dense (round, channel) volume.

    A volume with fewer stored voxels than ``shape`` holds also contains background 0.
    """
    lo, hi, n = F.min("value"), F.max("value"), F.count(F.lit(1))
    zero = F.lit(0).cast("bigint")
    return voxels.groupBy(*VOLUME).agg(
        F.when(n < shape.size, F.least(lo, zero)).otherwise(lo).alias("lo"),
        F.when(n < shape.size, F.greatest(hi, zero)).otherwise(hi).alias("hi"),
    )


def _scaled(lo: Column, hi: Column) -> Column:
    slope = f32(F.lit(float(UINT16_MAX)) / F.nullif((hi - lo).cast("double"), F.lit(0.0)))
    return (f32(F.col("value")) - f32(lo)) * slope


def scale_to_uint16(voxels: DataFrame, shape: Shape, bounds: tuple[float, float] | None = None) -> DataFrame:
    """Linear stretch to 0..65535 with half-up rounding; flat volumes become 0.

    ``bounds`` fixes the range; otherwise each volume's own range is computed once (one row per
    volume) and shared, so the second pass over the voxels needs no shuffle.
    """
    if bounds is not None:
        lo, hi = (F.lit(float(b)) for b in bounds)
        out = voxels
    else:
        out = voxels.join(volume_range(voxels, shape), VOLUME)
        lo, hi = F.col("lo"), F.col("hi")
    value = F.when(hi > lo, truncate(clip_uint16(_scaled(lo, hi)) + f32(0.5))).otherwise(F.lit(0).cast("bigint"))
    return out.withColumn("value", value).select(*voxels.columns)


def _scale_for_merge(voxels: DataFrame, shape: Shape) -> DataFrame:
    out = voxels.join(volume_range(voxels, shape), VOLUME)
    lo, hi = F.col("lo"), F.col("hi")
    value = F.when(hi > lo, half_even(clip_uint16(F.rint(_scaled(lo, hi))))).otherwise(F.lit(0).cast("bigint"))
    return out.withColumn("value", value).select(*voxels.columns)


def merge_channels(
    voxels: DataFrame, a: str, b: str, shape: Shape, strategy: str = "mean", scale: bool = True,
    output: str = "merged",
) -> DataFrame:
    """Merge two channels on their common extent.

    Both inputs travel through one partially aggregated shuffle keyed by voxel position instead
    of a full outer join; absent voxels are background 0. ``stack`` keeps both, as
    channels ``0`` and ``1``, and needs no shuffle at all.
    """
    if strategy not in MERGE_STRATEGIES:
        raise ValueError(f"unknown merge strategy {strategy!r}; expected one of {MERGE_STRATEGIES}")
    pair = voxels.filter(F.col("channel").isin(a, b) & within(shape))
    if scale:
        pair = _scale_for_merge(pair, shape)
    if strategy == "stack":
        return pair.withColumn("channel", F.when(F.col("channel") == a, "0").otherwise("1"))

    def of(channel: str) -> Column:
        return F.coalesce(F.max(F.when(F.col("channel") == channel, F.col("value"))), F.lit(0).cast("bigint"))

    both = pair.groupBy("round", *AXES).agg(of(a).alias("va"), of(b).alias("vb"))
    if strategy == "max":
        merged = F.greatest("va", "vb")
    else:
        merged = half_even((f32(F.col("va")) + f32(F.col("vb"))) * f32(0.5))
    return both.select("round", F.lit(output).alias("channel"), *AXES, merged.alias("value"))


def registration_channel(
    voxels: DataFrame, channels: list[str], shape: Shape, strategy: str = "mean", output: str = "registration"
) -> DataFrame:
    """Channel used to estimate transforms: one channel passes through unscaled, two are merged."""
    if len(channels) == 1:
        return voxels.filter(F.col("channel") == channels[0]).withColumn("channel", F.lit(output))
    if len(channels) == 2:
        return merge_channels(voxels, *channels, shape, strategy, output=output)
    raise ValueError("registration needs one or two channels")


def stack_images(voxels: DataFrame, a: str, b: str, shape_a: Shape, shape_b: Shape) -> DataFrame:
    """Two equally shaped channels as stack positions 0 and 1 (order z, position, y, x)."""
    if shape_a != shape_b:
        raise ValueError("images to stack must have the same shape")
    stacked = merge_channels(voxels, a, b, shape_a, "stack", scale=False)
    return stacked.select("round", "z", F.col("channel").cast("bigint").alias("position"), "y", "x", "value")


def imaging_channels(voxels: DataFrame) -> DataFrame:
    """Everything except derived registration channels."""
    return voxels.filter(~F.col("channel").endswith(REGISTRATION_SUFFIX))


def select_channels(voxels: DataFrame, channels: list[str]) -> DataFrame:
    return voxels.filter(F.col("channel").isin(channels))


def flip(voxels: DataFrame, axes: list[str], shape: Shape) -> DataFrame:
    """Mirror along one or more axes: a projection of coordinates."""
    extent = dict(zip(AXES, shape))
    unknown = [a for a in axes if a not in extent]
    if unknown:
        raise ValueError(f"unknown axes {unknown}")
    return voxels.withColumns({a: F.lit(extent[a] - 1) - F.col(a) for a in axes})


def reorient(voxels: DataFrame, shape: Shape, rotation: int, flip_z: bool = False) -> DataFrame:
    """Clockwise rotation in the (y, x) plane by 0/90/180/270 degrees, then an optional z flip."""
    if rotation not in (0, 90, 180, 270):
        raise ValueError("rotation must be 0, 90, 180 or 270 degrees")
    y, x = F.col("y"), F.col("x")
    up, left = F.lit(shape.ny - 1), F.lit(shape.nx - 1)
    moved = {0: (y, x), 90: (x, up - y), 180: (up - y, left - x), 270: (left - x, y)}[rotation]
    out = {"y": moved[0].cast("bigint"), "x": moved[1].cast("bigint")}
    if flip_z:
        out["z"] = (F.lit(shape.nz - 1) - F.col("z")).cast("bigint")
    return voxels.withColumns(out)
