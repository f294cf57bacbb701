"""Block-form paths of the voxel operators, for volumes too large for one row per voxel.

Each block is reduced inside its task (objects, projections, statistics, ranges, coarse voxels) and
only those partial results are shuffled; they are finished by ordinary aggregates. Results equal
the voxel form.
"""

from __future__ import annotations

from collections.abc import Iterator
from types import SimpleNamespace

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from voxelweave.functions.columns import half_up
from voxelweave.functions.kernels import decode, encode
from voxelweave.model import AXES, BLOCK_KEY, BLOCK_SCHEMA, UINT16_MAX, Shape
from voxelweave.operators.blocks import VOLUME, by_group
from voxelweave.operators.pixel import MERGE_STRATEGIES
from voxelweave.operators.resample import align_corner_steps


def map_blocks(blocks: DataFrame, kernel, schema: str) -> DataFrame:
    """``kernel(row, array) -> dict of columns`` for every block, as an Arrow map without a shuffle."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for fields in batch.to_pylist():
                row = SimpleNamespace(**fields)
                columns = kernel(row, decode(row))
                if columns is not None:
                    yield pa.RecordBatch.from_pydict(columns)

    return blocks.mapInArrow(run, schema)


def _per_label(inverse: np.ndarray, n: int, values: np.ndarray, fold) -> np.ndarray:
    """Fold ``values`` over equal ``inverse`` codes 0..n-1."""
    order = np.argsort(inverse, kind="stable")
    starts = np.searchsorted(inverse[order], np.arange(n))
    return fold.reduceat(values[order], starts)


def region_props(labels: DataFrame, min_object_size: int = 1) -> DataFrame:
    """Area, half-open box and centroid per label from label blocks; one partial row per label and block."""
    names = ["label", "n", *[f"{p}_{a}" for a in AXES for p in ("lo", "hi", "sum")]]

    def partial(row, array):
        where = np.nonzero(array > 0)
        if not len(where[0]):
            return None
        found, inverse = np.unique(array[where], return_inverse=True)
        out = {"label": found.astype(np.int64), "n": np.bincount(inverse).astype(np.int64)}
        for a, at in zip(AXES, where):
            at = at.astype(np.int64) + getattr(row, f"{a}0")
            out[f"lo_{a}"] = _per_label(inverse, len(found), at, np.minimum)
            out[f"hi_{a}"] = _per_label(inverse, len(found), at, np.maximum)
            out[f"sum_{a}"] = _per_label(inverse, len(found), at, np.add)
        return {k: pa.array(v) for k, v in out.items()}

    parts = map_blocks(labels, partial, ", ".join(f"{n} bigint" for n in names))
    area = F.sum("n")
    aggs = [area.alias("area")]
    aggs += [F.min(f"lo_{a}").alias(f"min_{a}") for a in AXES]
    aggs += [(F.max(f"hi_{a}") + 1).alias(f"max_{a}") for a in AXES]
    aggs += [(F.sum(f"sum_{a}") / area).alias(f"c{a}") for a in AXES]
    return parts.groupBy("label").agg(*aggs).filter(F.col("area") >= min_object_size)


def _masked(labels: DataFrame, channels: DataFrame, kernel, schema: str) -> DataFrame:
    """Group the label block with the channel blocks of the same position (one round)."""
    tagged = labels.withColumn("channel", F.lit(None).cast("string")).unionByName(channels)

    def run(key: tuple, rows: list):
        masks = [r for r in rows if r.channel is None]
        if not masks:
            return []
        array = decode(masks[0])
        where = np.nonzero(array > 0)
        if not len(where[0]):
            return []
        frames = [kernel(masks[0], array[where], where, r.channel, decode(r)[where]) for r in rows if r.channel is not None]
        frames = [f for f in frames if f is not None]
        return pd.concat(frames) if frames else []

    return by_group(tagged, list(BLOCK_KEY), run, schema)


def nucleus_mip(labels: DataFrame, channels: DataFrame, crops: DataFrame | None = None) -> DataFrame:
    """Per-object maximum over z, ``label, channel, y, x, value``; ``crops`` fills the padded boxes."""

    def project(block, ids, where, channel, values):
        found, inverse = np.unique(ids, return_inverse=True)
        code = (inverse * block.ny + where[1]) * block.nx + where[2]
        pixels, inverse = np.unique(code, return_inverse=True)
        top = _per_label(inverse, len(pixels), values.astype(np.int64), np.maximum)
        return pd.DataFrame({
            "label": found[pixels // (block.ny * block.nx)].astype(np.int64), "channel": channel,
            "y": pixels // block.nx % block.ny + block.y0, "x": pixels % block.nx + block.x0, "value": top,
        })

    parts = _masked(labels, channels, project, "label bigint, channel string, y bigint, x bigint, value bigint")
    if crops is not None:
        parts = parts.unionByName(crops)
    return parts.groupBy("label", "channel", "y", "x").agg(F.max("value").alias("value"))


def channel_stats(labels: DataFrame, channels: DataFrame, nuclei: DataFrame, names: list[str]) -> DataFrame:
    """min, max, mean, population std and count of masked voxels > 0 for the wanted objects."""

    def measure(block, ids, where, channel, values):
        seen = values > 0
        if not seen.any():
            return None
        found, inverse = np.unique(ids[seen], return_inverse=True)
        v = values[seen].astype(np.float64)
        n = len(found)
        return pd.DataFrame({
            "label": found.astype(np.int64), "channel": channel, "n": np.bincount(inverse).astype(np.int64),
            "lo": _per_label(inverse, n, v, np.minimum), "hi": _per_label(inverse, n, v, np.maximum),
            "s": _per_label(inverse, n, v, np.add), "ss": _per_label(inverse, n, v * v, np.add),
        })

    schema = "label bigint, channel string, n bigint, lo double, hi double, s double, ss double"
    parts = _masked(labels, channels, measure, schema).join(nuclei.select("label"), "label", "left_semi")
    nothing = F.lit(None).cast("double")
    wanted = nuclei.select(
        "label", F.explode(F.array(*[F.lit(c) for c in names])).alias("channel"), F.lit(0).cast("bigint").alias("n"),
        *[nothing.alias(c) for c in ("lo", "hi", "s", "ss")],
    )
    totals = parts.unionByName(wanted).groupBy("label", "channel").agg(
        F.sum("n").alias("nonzero_voxels"), F.min("lo").alias("min"), F.max("hi").alias("max"),
        (F.sum("s") / F.nullif(F.sum("n"), F.lit(0))).alias("mean"), (F.sum("ss") / F.nullif(F.sum("n"), F.lit(0))).alias("m2"),
    )
    spread = F.sqrt(F.greatest(F.col("m2") - F.col("mean") * F.col("mean"), F.lit(0.0)))
    return totals.withColumn("std", spread).drop("m2").na.fill(0.0, ["min", "max", "mean", "std"])


def _with_range(blocks: DataFrame, shape: Shape) -> DataFrame:
    """Blocks with their volume's global minimum and maximum (missing blocks are background)."""

    def extremes(row, array):
        return {
            "round": [row.round], "channel": [row.channel], "lo": [float(array.min())], "hi": [float(array.max())], "n": [array.size]
        }

    parts = map_blocks(blocks, extremes, "round string, channel string, lo double, hi double, n bigint")
    partial = F.sum("n") < shape.size
    zero = F.lit(0.0)
    ranges = parts.groupBy(*VOLUME).agg(
        F.when(partial, F.least(F.min("lo"), zero)).otherwise(F.min("lo")).alias("lo"),
        F.when(partial, F.greatest(F.max("hi"), zero)).otherwise(F.max("hi")).alias("hi"),
    )
    return blocks.join(ranges, VOLUME)


def _stretch(array: np.ndarray, lo: float, hi: float, half_up_rounding: bool) -> np.ndarray:
    if hi <= lo:
        return np.zeros(array.shape, dtype=np.uint16)
    out = (array.astype(np.float32) - np.float32(lo)) * np.float32(UINT16_MAX / (hi - lo))
    if not half_up_rounding:
        out = np.rint(out)
    out = np.clip(out, np.float32(0), np.float32(UINT16_MAX))
    return (out + np.float32(0.5) if half_up_rounding else out).astype(np.uint16)


def scale_to_uint16(blocks: DataFrame, shape: Shape) -> DataFrame:
    """Stretch every volume to 0..65535: one small aggregate, then a map."""

    def scaled(row, array):
        values = {**vars(row), "dtype": "uint16", "data": encode(_stretch(array, row.lo, row.hi, True))}
        names = [part.split()[0] for part in BLOCK_SCHEMA.split(", ")]
        kinds = {"bz": pa.int32(), "by": pa.int32(), "bx": pa.int32(), "nz": pa.int32(), "ny": pa.int32(), "nx": pa.int32()}
        return {n: pa.array([values[n]], kinds.get(n)) for n in names}

    return map_blocks(_with_range(blocks, shape), scaled, BLOCK_SCHEMA)


def merge_channels(blocks: DataFrame, a: str, b: str, shape: Shape, strategy: str = "mean", output: str = "merged") -> DataFrame:
    """Scale two channels and merge them block by block (``mean`` or ``max``); same block grid."""
    if strategy not in MERGE_STRATEGIES[:2]:
        raise ValueError(f"unknown block merge strategy {strategy!r}")

    def merge(key: tuple, rows: list) -> list[tuple]:
        first = rows[0]
        arrays = [_stretch(decode(r), r.lo, r.hi, False) for r in rows]
        if len(arrays) == 1:
            arrays.append(np.zeros_like(arrays[0]))
        if strategy == "max":
            out = np.maximum(*arrays)
        else:
            out = np.rint((arrays[0].astype(np.float32) + arrays[1].astype(np.float32)) * np.float32(0.5)).astype(np.uint16)
        return [(key[0], output, *key[1:], first.z0, first.y0, first.x0, *out.shape, "uint16", encode(out))]

    pair = _with_range(blocks.filter(F.col("channel").isin(a, b)), shape)
    return by_group(pair, ["round", *BLOCK_KEY], merge, BLOCK_SCHEMA)


def downsample(blocks: DataFrame, shape: Shape, factors) -> DataFrame:
    """Linear zoom of blocks to coarse voxels; each block contributes partial sums of its outputs."""
    out = shape.scaled_down(factors)
    steps = align_corner_steps(shape, out)

    def weights(start: int, size: int, m: int, step: float):
        source = np.arange(start, start + size)
        if m == 1 or step == 0:
            targets = np.arange(m)
        else:
            targets = np.arange(max(0, int(np.ceil((start - 1) / step))), min(m - 1, int(np.floor((start + size) / step))) + 1)
        return targets, np.clip(1.0 - np.abs(targets[:, None] * step - source[None, :]), 0.0, None)

    def shrink(row, array):
        values, spans = array.astype(np.float64), []
        for axis, (m, step) in enumerate(zip(out, steps)):
            targets, w = weights((row.z0, row.y0, row.x0)[axis], array.shape[axis], m, step)
            values = np.moveaxis(np.tensordot(w, values, axes=(1, axis)), 0, axis)
            spans.append(targets)
        where = np.nonzero(values)
        if not len(where[0]):
            return None
        columns = {c: pa.repeat(pa.scalar(getattr(row, c)), len(where[0])) for c in VOLUME}
        columns.update({a: pa.array(t[i].astype(np.int64)) for a, t, i in zip(AXES, spans, where)})
        return {**columns, "v": pa.array(values[where])}

    parts = map_blocks(blocks, shrink, "round string, channel string, z bigint, y bigint, x bigint, v double")
    summed = parts.groupBy(*VOLUME, *AXES).agg(half_up(F.sum("v")).alias("value"))
    return summed.filter("value > 0")
