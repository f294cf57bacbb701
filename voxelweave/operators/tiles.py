"""Overlapping tiles: placement, pairwise links, robust statistics, normalisation and blending.

Tile table: ``tile, ox, oy, oz`` (offset in pixels) and ``dz, dy, dx`` (extent); a channel
column is optional everywhere and makes each channel an independent mosaic in the same job.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from voxelweave.functions.columns import clip_uint16, f32, f32_divide, half_even, truncate
from voxelweave.functions.histograms import dense_histogram, percentiles
from voxelweave.functions.ranking import global_rank
from voxelweave.functions.sizing import parts_for, settled
from voxelweave.model import AXES, UINT16_MAX

BLEND_METHODS = ("weighted_average", "max", "overwrite")
# Fixed values of the robust tile statistics.
LOW_PERCENTILE, HIGH_PERCENTILE = 1.0, 99.9
EPSILON = 1e-6
NOISY_SNR = 2.0
NOMINAL_TILE_WIDTH = 2048
#: Tiles up to which the pairs of a cell are one task's work.
SHARE_TILES = 1000


def tile_offsets(manifest: DataFrame, overlap: float = 0.05) -> DataFrame:
    """Offsets from stage positions ``tile, x, y, z``.

    Positions are shifted to start at 0; x and y then advance by ``(1 - overlap) * 2048`` per
    distinct position. Only the distinct coordinates (grid columns and rows) are ranked, range by range,
    so a stage whose every tile has a position of its own is no single task's work.
    """
    step = (1 - overlap) * NOMINAL_TILE_WIDTH
    out = manifest
    for axis in ("x", "y"):
        ranks = global_rank(manifest.select(axis).distinct(), axis, "rank").withColumn("rank", F.col("rank") - 1)
        first = manifest.agg(F.min(axis)).scalar()
        out = out.join(ranks, axis).withColumn(f"o{axis}", F.col(axis) - first + F.col("rank") * step).drop("rank")
    return out.withColumn("oz", F.col("z") - manifest.agg(F.min("z")).scalar()).select("tile", "ox", "oy", "oz")


def overlap_pairs(tiles: DataFrame, min_overlap: int = 5) -> DataFrame:
    """Pairs ``tile_a < tile_b`` sharing at least ``min_overlap`` pixels on every axis.

    Tiles are hashed to the grid cells they touch (cell = largest tile), joined on the cell
    and kept only in the cell of the overlap's low corner, so each pair appears once. One side of a cell is
    dealt into shares and the other copied to them, more of them the more tiles there are, so that crowded cells are many tasks' work.
    """
    *cell, n_tiles = tiles.agg(*[F.max(f"d{a}") for a in AXES], F.count(F.lit(1))).first()
    shares = max(1, math.ceil(math.sqrt(n_tiles / SHARE_TILES)))
    parts = shares * parts_for(tiles.sparkSession, 0)
    if cell[0] is None:
        cell = (1, 1, 1)
    size = dict(zip(AXES, cell))
    keyed = tiles
    for a in AXES:
        lo, hi = F.col(f"o{a}"), F.col(f"o{a}") + F.col(f"d{a}") - 1
        n = F.lit(float(size[a]))
        keyed = keyed.withColumn(
            f"c{a}", F.explode(F.sequence(F.floor(lo / n).cast("bigint"), F.floor(hi / n).cast("bigint")))
        )
    cols = ["tile", *[f"{p}{a}" for p in "od" for a in AXES]]

    def side(name: str, share: Column) -> DataFrame:
        rows = keyed.select(*[f"c{a}" for a in AXES], share.alias("share"), *[F.col(c).alias(f"{c}_{name}") for c in cols])
        return rows.repartition(parts, *on)

    on = [*[f"c{a}" for a in AXES], "share"]
    own, copies = F.pmod(F.xxhash64("tile"), F.lit(shares)).cast("int"), F.explode(F.sequence(F.lit(0), F.lit(shares - 1)))
    joined = side("a", own).join(side("b", copies), on).filter("tile_a < tile_b")
    for a in AXES:
        lo = F.greatest(f"o{a}_a", f"o{a}_b")
        hi = F.least(F.col(f"o{a}_a") + F.col(f"d{a}_a"), F.col(f"o{a}_b") + F.col(f"d{a}_b"))
        joined = joined.withColumns({f"lo_{a}": lo, f"n_{a}": hi - lo}).filter(
            (F.col(f"n_{a}") >= min_overlap) & (F.col(f"c{a}") == F.floor(lo / F.lit(float(size[a]))).cast("bigint"))
        )
    keep = [f"{p}_{a}" for p in ("lo", "n") for a in AXES]
    return joined.select("tile_a", "tile_b", *keep, *[f"o{a}_{s}" for a in AXES for s in "ab"])


def filter_links(
    links: DataFrame, min_r: float = 0.0, max_r: float = 1.0, max_shift=(0, 0, 0), max_displacement: float = 0.0
) -> DataFrame:
    """Keep links with correlation in range and bounded shift (0 = unlimited)."""
    cond = F.col("r").between(min_r, max_r)
    for a, bound in zip(AXES, max_shift):
        if bound:
            cond = cond & (F.abs(f"s{a}") <= bound)
    if max_displacement:
        norm = F.sqrt(sum((F.col(f"s{a}") * F.col(f"s{a}") for a in AXES), F.lit(0.0)))
        cond = cond & (norm <= max_displacement)
    return links.filter(cond)


def link_residuals(positions: DataFrame, links: DataFrame) -> DataFrame:
    """Distance between measured and solved displacement of every link.

    ``positions``: tile, pz, py, px. ``links``: tile_a, tile_b and measured displacement mz, my, mx.
    """

    def side(name: str) -> DataFrame:
        return positions.select(F.col("tile").alias(f"tile_{name}"), *[F.col(f"p{a}").alias(f"p{a}_{name}") for a in AXES])

    joined = links.join(side("a"), "tile_a").join(side("b"), "tile_b")
    squares = [F.pow(F.col(f"p{a}_b") - F.col(f"p{a}_a") - F.col(f"m{a}"), 2) for a in AXES]
    return joined.select(*links.columns, F.sqrt(sum(squares, F.lit(0.0))).alias("residual"))


def _keys(voxels: DataFrame) -> list[str]:
    return ["channel", "tile"] if "channel" in voxels.columns else ["tile"]


def per_channel(tiles: DataFrame, channels: list[str]) -> DataFrame:
    """The tile table repeated for each channel name (an array explode, not a join)."""
    return tiles.withColumn("channel", F.explode(F.array(*[F.lit(c) for c in channels])))


def tile_stats(voxels: DataFrame, tiles: DataFrame) -> DataFrame:
    """p1, p_hi (99.9th), clipped mean/std and SNR of each dense tile, from its histogram."""
    keys = _keys(voxels)
    size = (F.col("dz") * F.col("dy") * F.col("dx")).cast("bigint")
    return stats_from_histogram(dense_histogram(voxels, keys, tiles.select(*keys, size.alias("dense_size"))), keys)


def stats_from_histogram(hist: DataFrame, keys: list[str]) -> DataFrame:
    """The statistics of :func:`tile_stats` from ``keys, value, n`` rows."""
    ranges = percentiles(hist, keys, {"p1": LOW_PERCENTILE, "p_hi": HIGH_PERCENTILE})
    value = F.greatest(F.least(F.col("value").cast("double"), F.col("p_hi")), F.col("p1"))
    weight = F.sum("n")
    moments = (
        hist.join(ranges, keys)
        .withColumn("c", value - F.col("p1"))
        .groupBy(*keys, "p1", "p_hi")
        .agg((F.sum(F.col("n") * F.col("c")) / weight).alias("m"), (F.sum(F.col("n") * F.col("c") * F.col("c")) / weight).alias("m2"))
    )
    std = F.sqrt(F.greatest(F.col("m2") - F.col("m") * F.col("m"), F.lit(0.0)))
    snr = F.when(F.col("std") > 0, F.col("m") / (F.col("std") + EPSILON)).otherwise(F.lit(0.0))
    return (
        moments.withColumn("std", std)
        .withColumn("snr", snr)
        .select(*keys, "p1", "p_hi", (F.col("m") + F.col("p1")).alias("mean"), "std", "snr")
    )


def global_reference(stats: DataFrame) -> DataFrame:
    """Median of ``p_hi`` over tiles (per channel when there is one); 1.0 without tiles."""
    by = ["channel"] if "channel" in stats.columns else []
    return stats.groupBy(*by).agg(F.coalesce(F.percentile("p_hi", F.lit(0.5)), F.lit(1.0)).alias("ref"))


def tile_quality(stats: DataFrame, noise_threshold: float = 0.1) -> DataFrame:
    """Statistics plus signal flags and the blending weight of each tile."""
    stats = settled(stats)
    ref = global_reference(stats)
    out = stats.join(ref, "channel") if "channel" in stats.columns else stats.withColumn("ref", ref.scalar())
    ratio = F.col("p_hi") / (F.col("ref") + EPSILON)

    def unit(x: Column) -> Column:
        return F.greatest(F.lit(0.1), F.least(F.lit(1.0), x))

    return out.withColumns(
        {
            "low_signal": ratio < noise_threshold,
            "noisy": F.col("snr") < NOISY_SNR,
            "weight": unit(ratio) * unit(F.col("snr") / 5.0),
        }
    )


def _normalized(value: Column) -> Column:
    p1, spread = F.col("p1"), F.col("p_hi") - F.col("p1")
    base = f32(value) - f32(p1)
    target = F.least(F.lit(float(UINT16_MAX)), spread * 0.3)
    gentle = f32_divide(base, f32(F.greatest(F.lit(1.0), spread))) * f32(target)
    full = f32_divide(base, f32(spread)) * f32(float(UINT16_MAX))
    return (
        F.when(spread <= 0, value)
        .when(F.col("low_signal") & F.col("noisy"), value)
        .when(F.col("low_signal"), truncate(clip_uint16(gentle)))
        .otherwise(truncate(clip_uint16(full)))
    )


def normalize_tiles(voxels: DataFrame, quality: DataFrame) -> DataFrame:
    """Percentile normalisation chosen per tile quality; values truncate to integers."""
    keys = _keys(voxels)
    rows = voxels.join(quality, keys)
    return rows.withColumn("value", _normalized(F.col("value")).cast("bigint")).select(*voxels.columns)


def mosaic_extent(tiles: DataFrame) -> DataFrame:
    """One row: origin and size of the composite."""
    aggs = []
    for a in AXES:
        lo = F.min(f"o{a}")
        aggs += [lo.cast("double").alias(f"min_{a}")]
        aggs += [F.ceil(F.max(F.col(f"o{a}") + F.col(f"d{a}")) - lo).cast("bigint").alias(f"n{a}")]
    return tiles.agg(*aggs)


def place_tiles(tiles: DataFrame) -> DataFrame:
    """Tiles with their integer start in the composite (half-even rounding)."""
    starts = {f"start_{a}": half_even((F.col(f"o{a}") - tiles.agg(F.min(f"o{a}")).scalar()).cast("double")) for a in AXES}
    return tiles.withColumns(starts)


def dense_size(tiles: DataFrame) -> int:
    """Voxel positions of all tiles."""
    return int(tiles.agg(F.sum((F.col("dz") * F.col("dy") * F.col("dx")).cast("double"))).first()[0] or 0)


def tile_grid(tiles: DataFrame, parts: int) -> DataFrame:
    """Every voxel position of tiles of the extent ``ez, ey, ex``, beside their other columns; lines are spread over ``parts``
    before the widest expansion."""
    out = tiles
    for a in AXES:
        if a == AXES[-1]:
            out = out.repartition(parts, *[c for c in ("channel", "tile") if c in tiles.columns], "z", "y")
        out = out.withColumn(a, F.explode(F.sequence(F.lit(0).cast("bigint"), F.col(f"e{a}").cast("bigint") - 1)))
    return out.drop(*[f"e{a}" for a in AXES])


def feather(pad: int) -> Column:
    """Separable edge ramp; 0 on the tile border, 1 from ``pad`` voxels inwards."""
    ramp = F.lit(1.0)
    for a in AXES:
        inside = F.least(F.col(a), F.col(f"d{a}") - 1 - F.col(a)) / F.lit(float(max(1, pad)))
        ramp = ramp * F.greatest(F.least(inside, F.lit(1.0)), F.lit(0.0))
    return ramp


def blend(
    voxels: DataFrame, tiles: DataFrame, method: str = "weighted_average", normalize: bool = True,
    noise_threshold: float = 0.1, feather_pad: int = 16, flip_axes: tuple[str, ...] = (), dense: bool = False,
) -> DataFrame:
    """Composite volume of placed tiles: ``[channel,] z, y, x, value``.

    One row of scalars per tile is shared; every voxel is then projected to composite
    coordinates and combined by one shuffle on the position, which is never hot; its parts
    grow in number with the tiles, not in size. ``dense`` says that background rows are already present; otherwise they are
    added to the same aggregation where the method needs them (weights of empty voxels,
    zeros of a later tile).
    """
    if method not in BLEND_METHODS:
        raise ValueError(f"unknown blend method {method!r}; expected one of {BLEND_METHODS}")
    keys = _keys(voxels)
    placed = place_tiles(tiles)
    if normalize or method == "weighted_average":
        placed = placed.join(tile_quality(tile_stats(voxels, tiles), noise_threshold), keys)
    parts = parts_for(voxels.sparkSession, dense_size(tiles))
    rows = voxels.join(placed, keys).withColumn("present", F.lit(1))
    if not dense and method != "max":
        # Tiles meet their scalars before they are expanded, so background rows need no join.
        extents = tiles.select(*keys, *[F.col(f"d{a}").alias(f"e{a}") for a in AXES])
        background = extents.join(placed, keys).withColumns({"value": F.lit(0).cast("bigint"), "present": F.lit(0)})
        rows = rows.unionByName(tile_grid(background, parts).select(rows.columns))
    if normalize:
        rows = rows.withColumn("value", _normalized(F.col("value")).cast("bigint"))
    if flip_axes:
        rows = rows.withColumns({a: F.col(f"d{a}") - 1 - F.col(a) for a in flip_axes})
    if method == "weighted_average":
        rows = rows.withColumn("w", feather(feather_pad) * F.col("weight"))
    rows = rows.withColumns({a: F.col(a) + F.col(f"start_{a}") for a in AXES})
    place = [*keys[:-1], *AXES]
    if method == "max":
        return rows.groupBy(*place).agg(F.max("value").alias("value"))
    if method == "overwrite":
        # Dealt by position in as many parts as there are voxels for; the aggregation reuses the exchange.
        dealt = rows.select(*place, "value", "tile", "present").repartition(parts, *place)
        return dealt.groupBy(*place).agg(F.max_by("value", F.struct("tile", "present")).alias("value"))
    # Background rows carry the weight, stored rows the weighted value, unless rows are dense.
    counted = F.lit(True) if dense else F.col("present") == 0
    dealt = rows.select(*place, (F.col("w") * F.col("value")).alias("wv"), F.when(counted, F.col("w")).alias("w")).repartition(parts, *place)
    mixed = dealt.groupBy(*place).agg(F.sum("wv").alias("wv"), F.sum("w").alias("w"))
    mean = F.coalesce(F.try_divide("wv", "w"), F.lit(0.0))
    value = half_even(F.round(F.greatest(F.least(mean, F.lit(float(UINT16_MAX))), F.lit(0.0)), 6))
    return mixed.select(*keys[:-1], *AXES, value.alias("value"))


def blend_by_channel(voxels: DataFrame, tiles: DataFrame, voxel_size=(1.0, 1.0, 1.0), **options) -> DataFrame:
    """All channels' composites in one job; ``tiles`` offsets are physical, ``voxel_size`` is x, y, z."""
    pixels = tiles.withColumns({f"o{a}": F.col(f"o{a}") / F.lit(float(s)) for a, s in zip("xyz", voxel_size)})
    return blend(voxels, pixels, **options)
