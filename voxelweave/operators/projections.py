"""Per-object maximum-intensity projections (MIPs), statistics, contrast and composites."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from voxelweave.functions.columns import clip, f32, f32_divide, truncate
from voxelweave.functions.histograms import percentiles
from voxelweave.functions.sizing import parts_for, spread
from voxelweave.model import DEFAULT_COLOR, DEFAULT_OPACITY, DEFAULT_PERCENTILES, check_percentile_range


def masked_voxels(labels: DataFrame, voxels: DataFrame, nuclei: DataFrame | None = None) -> DataFrame:
    """``label, channel, z, y, x, value`` for voxels whose mask equals a known object.

    An inner join on the unique voxel position (so no key is hot). ``nuclei`` restricts the
    labels first, by a semi join that never grows rows.
    """
    kept = labels.filter("label > 0")
    if nuclei is not None:
        kept = kept.join(nuclei.select("label"), "label", "left_semi")
    return kept.join(voxels, ["z", "y", "x"]).select("label", "channel", "z", "y", "x", "value")


def crop_pixels(nuclei: DataFrame, channels: list[str]) -> DataFrame:
    """Every (y, x) pixel of every object's padded crop, per channel, value 0.

    Crop rows are spread over the cluster before they are widened to pixels, so one object as
    large as the volume is not expanded by a single task.
    """
    lines = (
        nuclei.select("label", "pmin_y", "pmax_y", "pmin_x", "pmax_x")
        .withColumn("channel", F.explode(F.array(*[F.lit(c) for c in channels])))
        .withColumn("y", F.explode(F.sequence("pmin_y", F.col("pmax_y") - 1)))
    )
    # An explicit number of parts: adaptive execution would put many short lines into one task.
    return (
        spread(lines, "label", "y")
        .withColumn("x", F.explode(F.sequence("pmin_x", F.col("pmax_x") - 1)))
        .select("label", "channel", "y", "x", F.lit(0).cast("bigint").alias("value"))
    )


def nucleus_mip(masked: DataFrame, crops: DataFrame | None = None) -> DataFrame:
    """Maximum over z per (label, channel, y, x).

    With ``crops`` (see :func:`crop_pixels`) the result covers the whole padded crop, zero
    outside the mask; background rows join the same aggregation, so there is one shuffle, in parts
    that grow in number with the crops, and no outer join.
    """
    pixels = masked.select("label", "channel", "y", "x", "value")
    if crops is not None:
        parts = parts_for(masked.sparkSession, crops.count())
        pixels = pixels.unionByName(crops).repartition(parts, "label", "channel", "y", "x")
    return pixels.groupBy("label", "channel", "y", "x").agg(F.max("value").alias("value"))


def channel_stats(masked: DataFrame, nuclei: DataFrame, channels: list[str]) -> DataFrame:
    """min, max, mean, population std and count of masked voxels > 0; zeros when there are none."""
    seen = masked.filter("value > 0").select("label", "channel", F.col("value").cast("double").alias("v"))
    wanted = nuclei.select(
        "label",
        F.explode(F.array(*[F.lit(c) for c in channels])).alias("channel"),
        F.lit(None).cast("double").alias("v"),
    )
    zero = F.lit(0.0)
    return (
        seen.unionByName(wanted)
        .groupBy("label", "channel")
        .agg(
            F.coalesce(F.min("v"), zero).alias("min"),
            F.coalesce(F.max("v"), zero).alias("max"),
            F.coalesce(F.avg("v"), zero).alias("mean"),
            F.coalesce(F.stddev_pop("v"), zero).alias("std"),
            F.count("v").alias("nonzero_voxels"),
        )
    )


def resolve_channels(available: DataFrame, requested: list[str] | None) -> tuple[list[str], list[str]]:
    """(usable, missing) channel names; all available ones by default, an error when none is left."""
    names = [r[0] for r in available.select("channel").distinct().orderBy("channel").collect()]
    usable = names if requested is None else [c for c in requested if c in names]
    if not usable:
        raise ValueError("no valid channel available")
    return usable, [c for c in requested or [] if c not in names]


def mip_metadata(nuclei: DataFrame, pad_xy: int) -> DataFrame:
    """Crop and projection shapes, area, centroid and padding per object."""
    extent = {a: F.col(f"pmax_{a}") - F.col(f"pmin_{a}") for a in "zyx"}
    return nuclei.select(
        "label",
        "area",
        "cz",
        "cy",
        "cx",
        extent["z"].alias("crop_z"),
        extent["y"].alias("crop_y"),
        extent["x"].alias("crop_x"),
        extent["y"].alias("mip_h"),
        extent["x"].alias("mip_w"),
        F.lit(pad_xy).cast("bigint").alias("pad_xy"),
    )


def to_gray(value: Column, lo: Column, hi: Column) -> Column:
    """``trunc(255 * clip((v - lo) / (hi - lo), 0, 1))`` in float32; 0 when ``hi <= lo``."""
    ratio = clip(f32_divide(f32(value) - f32(lo), f32(hi - lo)), 0.0, 1.0)
    return F.when(hi > lo, truncate(ratio * f32(255.0))).otherwise(F.lit(0).cast("bigint"))


def contrast(images: DataFrame, keys: list[str], bounds=DEFAULT_PERCENTILES) -> DataFrame:
    """Percentile contrast of dense images (rows must include background) to 0..255.

    Percentiles come from per-image value histograms, so an image of any size is summarised by
    its distinct values; flat images give 0.
    """
    lo, hi = check_percentile_range(bounds)
    hist = images.groupBy(*keys, "value").agg(F.count(F.lit(1)).alias("n"))
    ranges = percentiles(hist, keys, {"p_lo": lo, "p_hi": hi})
    gray = to_gray(F.col("value"), F.col("p_lo"), F.col("p_hi"))
    return images.join(ranges, keys).withColumn("gray", gray).drop("p_lo", "p_hi", "vmin", "vmax")


def manual_scale(images: DataFrame, keys: list[str], lo: float | None = None, hi: float | None = None) -> DataFrame:
    """Explicit-range contrast; a missing bound is the image's own minimum or maximum."""
    out = images
    if lo is None or hi is None:
        out = out.join(images.groupBy(*keys).agg(F.min("value").alias("vmin"), F.max("value").alias("vmax")), keys)
    low = F.col("vmin") if lo is None else F.lit(lo)
    high = F.col("vmax") if hi is None else F.lit(hi)
    return out.withColumn("gray", to_gray(F.col("value"), low.cast("double"), high.cast("double"))).drop("vmin", "vmax")


def settings_table(spark, settings: dict[str, dict]) -> DataFrame:
    """Display settings (a handful of channels) as rows; disabled channels are left out."""
    rows = []
    for order, (channel, s) in enumerate(settings.items()):
        if not s.get("enabled", True):
            continue
        lo, hi = check_percentile_range(s.get("contrast_range") or DEFAULT_PERCENTILES)
        color = s.get("color", DEFAULT_COLOR).lstrip("#")
        rgb = [int(color[i : i + 2], 16) / 255.0 for i in (0, 2, 4)]
        rows.append(
            (channel, order, bool(s.get("auto_contrast", True)), lo / 100, hi / 100, s.get("min_value"),
             s.get("max_value"), float(s.get("opacity", DEFAULT_OPACITY)), *rgb)
        )
    return spark.createDataFrame(
        rows,
        "channel string, ord int, auto boolean, q_lo double, q_hi double, min_value double, max_value double, "
        "opacity double, red double, green double, blue double",
    )


def enhanced(mips: DataFrame, settings: DataFrame, keys: list[str]) -> DataFrame:
    """Grey level of each pixel under its channel's settings (percentile or manual range).

    The settings table is a literal of a few rows, so Catalyst broadcasts it by size.
    """
    hist = mips.groupBy(*keys, "channel", "value").agg(F.count(F.lit(1)).alias("n"))
    per_image = hist.join(F.broadcast(settings), "channel").groupBy(*keys, "channel")
    # The quantile argument must be constant per aggregate, so one aggregate per distinct setting.
    quantiles = sorted({q for r in settings.select("q_lo", "q_hi").collect() for q in r})
    aggs = [F.percentile("value", F.lit(q), F.col("n")) for q in quantiles]
    named = [(F.lit(q), a) for q, a in zip(quantiles, aggs)]
    ranges = per_image.agg(
        F.map_from_arrays(F.array(*[q for q, _ in named]), F.array(*[a for _, a in named])).alias("q"),
        F.min("value").cast("double").alias("vmin"),
        F.max("value").cast("double").alias("vmax"),
    )
    joined = mips.join(ranges, [*keys, "channel"]).join(F.broadcast(settings), "channel")
    auto = F.col("auto")
    lo = F.when(auto, F.col("q")[F.col("q_lo")]).otherwise(F.coalesce("min_value", "vmin"))
    hi = F.when(auto, F.col("q")[F.col("q_hi")]).otherwise(F.coalesce("max_value", "vmax"))
    return joined.withColumn("gray", to_gray(F.col("value"), lo, hi))


def composite(mips: DataFrame, settings: DataFrame, keys: list[str] = ("label",)) -> DataFrame:
    """Additive RGB composite: sum of grey/255 * colour * opacity, clipped, to 0..255."""
    keys = list(keys)
    lit_up = enhanced(mips, settings, keys)
    level = F.col("gray") / F.lit(255.0) * F.col("opacity")
    sums = [F.round(F.sum(level * F.col(c)), 9).alias(c) for c in ("red", "green", "blue")]
    out = lit_up.groupBy(*keys, "y", "x").agg(*sums)
    for c in ("red", "green", "blue"):
        out = out.withColumn(c, F.floor(F.round(F.least(F.col(c), F.lit(1.0)) * 255, 6)).cast("bigint"))
    return out


def tint_layers(mips: DataFrame, settings: DataFrame, keys: list[str] = ("label",)) -> DataFrame:
    """Multiply-tint each visible layer by its colour, then source-over in settings order."""
    keys = list(keys)
    layers = enhanced(mips, settings, keys).groupBy(*keys, "y", "x").agg(
        F.sort_array(F.collect_list(F.struct("ord", "gray", "red", "green", "blue", "opacity"))).alias("layers")
    )

    def blended(channel: str) -> Column:
        return F.aggregate(
            "layers",
            F.lit(0.0),
            lambda acc, l: l["gray"] * l[channel] * l["opacity"] + acc * (F.lit(1.0) - l["opacity"]),
        )

    return layers.select(*keys, "y", "x", *[blended(c).alias(c) for c in ("red", "green", "blue")])


def nucleus_summary(nuclei: DataFrame, mips: DataFrame) -> DataFrame:
    """Objects with whether a projection is stored, its channels and its shape."""
    index = mips.groupBy("label").agg(
        F.array_join(F.array_sort(F.collect_set("channel")), ",").alias("available_channels"),
        (F.max("y") - F.min("y") + 1).alias("mip_h"),
        (F.max("x") - F.min("x") + 1).alias("mip_w"),
    )
    return nuclei.join(index, "label", "left").withColumn(
        "has_cached_mip", F.col("available_channels").isNotNull()
    )


def missing_mips(nuclei: DataFrame, channels: list[str], existing: DataFrame) -> DataFrame:
    """(label, channel) pairs that still have to be projected."""
    wanted = nuclei.select("label", F.explode(F.array(*[F.lit(c) for c in channels])).alias("channel"))
    return wanted.join(existing.select("label", "channel").distinct(), ["label", "channel"], "left_anti")


def batch_outcome(requested: DataFrame, nuclei: DataFrame) -> DataFrame:
    """Processed and failed counts of a batch request (unknown labels fail)."""
    known = nuclei.select("label", F.lit(1).alias("hit"))
    return (
        requested.distinct()
        .join(known, "label", "left")
        .agg(F.count("hit").alias("processed_nuclei"), (F.count(F.lit(1)) - F.count("hit")).alias("failed_nuclei"))
    )
