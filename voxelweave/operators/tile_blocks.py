"""Stitching in block form: tile blocks are cut to composite blocks and combined there.

Tile blocks are dense blocks whose ``round`` holds the tile number. Statistics come from
per-block value counts; a voxel travels once, as part of a cropped block.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from voxelweave.functions.columns import DECIMALS
from voxelweave.functions.kernels import block_range, decode, encode
from voxelweave.functions.sizing import written
from voxelweave.model import AXES, BLOCK_KEY, BLOCK_SCHEMA, UINT16_MAX, Shape
from voxelweave.operators import tiles as tl
from voxelweave.operators.block_objects import map_blocks
from voxelweave.operators.blocks import _columns, by_group

_PART_SCHEMA = BLOCK_SCHEMA + ", tile bigint, weight double, lz bigint, ly bigint, lx bigint, dz bigint, dy bigint, dx bigint"


def dense_blocks(blocks: DataFrame, tiles: DataFrame, tile_block: Shape) -> DataFrame:
    """``blocks`` and a block of zeros for each one that was left out as background.

    ``tile_block`` is the block shape of the tiles; ``tiles`` has their extents. Zero blocks are built
    by expressions from the tile table, so only block keys are compared.
    """
    channels = [r[0] for r in blocks.select("channel").distinct().collect()]  # one name per channel
    if not channels:
        return blocks
    grid = tl.per_channel(tiles.select(F.col("tile").cast("string").alias("round"), *[f"d{a}" for a in AXES]), channels)
    for a, size in zip(AXES, tile_block):
        last = F.ceil(F.col(f"d{a}") / size).cast("int") - 1
        grid = grid.withColumn(f"b{a}", F.explode(F.sequence(F.lit(0), last)))
        grid = grid.withColumn(f"{a}0", (F.col(f"b{a}") * size).cast("bigint"))
        grid = grid.withColumn(f"n{a}", F.least(F.lit(size), F.col(f"d{a}") - F.col(f"{a}0")).cast("int"))
    kinds = dict(blocks.dtypes)
    zeros = grid.withColumn("dtype", F.lit("uint16")).withColumn("data", F.expr("unhex(repeat('0000', nz * ny * nx))"))
    zeros = zeros.select(*[F.col(c).cast(kinds[c]).alias(c) for c in blocks.columns])
    return blocks.unionByName(zeros.join(blocks, ["round", "channel", *BLOCK_KEY], "left_anti"))


def tile_stats(blocks: DataFrame) -> DataFrame:
    """Robust statistics per channel and tile of dense blocks; one row per distinct value and block is shuffled."""

    def count(row, array):
        values, n = np.unique(array, return_counts=True)
        return {
            "channel": pa.repeat(pa.scalar(row.channel), len(values)),
            "tile": pa.repeat(pa.scalar(int(row.round)), len(values)), "value": pa.array(values.astype(np.int64)),
            "n": pa.array(n.astype(np.int64)),
        }

    parts = map_blocks(blocks, count, "channel string, tile bigint, value bigint, n bigint")
    keys = ["channel", "tile"]
    return tl.stats_from_histogram(parts.groupBy(*keys, "value").agg(F.sum("n").alias("n")), keys)


def _normalize(array: np.ndarray, row) -> np.ndarray:
    spread = row.p_hi - row.p1
    if spread <= 0 or (row.low_signal and row.noisy):
        return array
    base = array.astype(np.float32) - np.float32(row.p1)
    if row.low_signal:
        out = base / np.float32(max(1.0, spread)) * np.float32(min(float(UINT16_MAX), spread * 0.3))
    else:
        out = base / np.float32(spread) * np.float32(UINT16_MAX)
    return np.clip(out, np.float32(0), np.float32(UINT16_MAX)).astype(np.uint16)


def blend(
    blocks: DataFrame, tiles: DataFrame, block: Shape, tile_block: Shape, method: str = "weighted_average",
    normalize: bool = True, noise_threshold: float = 0.1, feather_pad: int = 16,
) -> DataFrame:
    """Composite blocks of every channel; methods as in the voxel form. Blocks of ``tile_block`` left out count as zeros."""
    if method not in tl.BLEND_METHODS:
        raise ValueError(f"unknown blend method {method!r}; expected one of {tl.BLEND_METHODS}")
    placed = tl.place_tiles(tiles).select("tile", *[f"start_{a}" for a in AXES], *[F.col(f"d{a}").alias(f"d{a}") for a in AXES])
    # Written: channels, zeros, statistics and parts all start from the blocks.
    blocks = written(dense_blocks(written(blocks, "tile-blocks"), tiles, tile_block), "dense-tile-blocks")
    placed = placed.join(tl.tile_quality(tile_stats(blocks), noise_threshold), "tile")
    extent = tl.mosaic_extent(tiles).first()
    shape = Shape(*(int(extent[f"n{a}"]) for a in AXES))
    rows = blocks.withColumn("tile", F.col("round").cast("bigint")).join(placed, ["channel", "tile"])

    def project(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for row in batch.itertuples(index=False):
                array = decode(row)
                array = _normalize(array, row) if normalize else array
                origin = (row.start_z, row.start_y, row.start_x)
                lo = [s + p for s, p in zip(origin, (row.z0, row.y0, row.x0))]
                hi = [o + n for o, n in zip(lo, array.shape)]
                spans = [block_range(a, b, s, n, 0) for a, b, s, n in zip(lo, hi, block, shape)]
                for key in ((i, j, k) for i in spans[0] for j in spans[1] for k in spans[2]):
                    start = [max(o, k * s) for o, k, s in zip(lo, key, block)]
                    stop = [min(e, (k + 1) * s) for e, k, s in zip(hi, key, block)]
                    part = array[tuple(slice(a - o, b - o) for a, b, o in zip(start, stop, lo))].astype(np.uint16)
                    local = [a - o for a, o in zip(start, origin)]
                    out.append(("mosaic", row.channel, *key, *start, *part.shape, "uint16", encode(part), row.tile, row.weight,
                                *local, row.dz, row.dy, row.dx))
            if out:
                yield pd.DataFrame(out, columns=_columns(_PART_SCHEMA))

    def combine(key: tuple, parts: list) -> list[tuple]:
        lo = [k * b for k, b in zip(key[1:], block)]
        size = [min(b, n - o) for b, n, o in zip(block, shape, lo)]
        total, weights = np.zeros(size), np.zeros(size)
        for part in sorted(parts, key=lambda p: p.tile):
            array = decode(part)
            at = tuple(slice(p - o, p - o + n) for p, o, n in zip((part.z0, part.y0, part.x0), lo, array.shape))
            if method == "max":
                total[at] = np.maximum(total[at], array)
            elif method == "overwrite":
                total[at] = array
            else:
                w = np.full((1, 1, 1), part.weight)
                for axis, (l, d, n) in enumerate(zip((part.lz, part.ly, part.lx), (part.dz, part.dy, part.dx), array.shape)):
                    i = np.arange(l, l + n)
                    ramp = np.clip(np.minimum(i, d - 1 - i) / max(1, feather_pad), 0.0, 1.0)
                    w = w * ramp.reshape([-1 if a == axis else 1 for a in range(3)])
                total[at] += w * array
                weights[at] += w
        if method == "weighted_average":
            mean = np.divide(total, weights, out=np.zeros(size), where=weights > 0)
            total = np.rint(np.round(np.clip(mean, 0, UINT16_MAX), DECIMALS))
        return [("mosaic", key[0], *key[1:], *lo, *size, "uint16", encode(total.astype(np.uint16)))]

    return by_group(rows.mapInPandas(project, _PART_SCHEMA), ["channel", *BLOCK_KEY], combine, BLOCK_SCHEMA)
