"""Block form: conversions, re-chunking, halo exchange and per-block neighbourhood kernels.

Every regrouping is one shuffle keyed by (volume, block). A group is one block plus its halo,
so its size is fixed by the block shape and never by the data.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from types import SimpleNamespace

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from voxelweave.functions.kernels import block_range, decode, encode, gaussian_weights, smooth
from voxelweave.functions.sizing import spread
from voxelweave.model import AXES, BLOCK_KEY, BLOCK_SCHEMA, VOXEL_SCHEMA, Shape

VOLUME = ["round", "channel"]
KEY = [*VOLUME, *BLOCK_KEY]
DEFAULT_BLOCK = Shape(64, 64, 64)
# Fixed value: memory cap per chunk of the chunk-shape rule.
CHUNK_MEMORY_MB = 512


def safe_chunk_shape(shape: Shape, itemsize: int, depth: int, max_memory_mb: int = CHUNK_MEMORY_MB) -> Shape:
    """As many z-slices as fit the memory cap (at least one), full in y and x."""
    fitting = (max_memory_mb * 1024 * 1024) // (shape.ny * shape.nx * itemsize)
    return Shape(min(max(1, min(depth, fitting)), shape.nz), shape.ny, shape.nx)


def block_count(shape: Shape, block: Shape) -> Shape:
    return Shape(*(-(-n // b) for n, b in zip(shape, block)))


#: Rows, and bytes of blocks, that a task holds before it hands them on.
_OUT_ROWS, _OUT_BYTES = 1_000, 8 << 20


def _groups(df: DataFrame, keys: list[str], kernel: Callable, schema: str) -> DataFrame:
    """Run ``kernel(key, rows)`` once per group and collect its row tuples (or a pandas frame).

    Rows meet their group by one shuffle and a sort, and a task walks along the runs of equal keys: an Arrow stream per
    group would cost more than the work on a small block. A task holds one batch and the group that it ends in.
    """
    arrow = to_arrow_schema(T.DataType.fromDDL(schema))

    def finished(key: tuple, parts: list[pa.RecordBatch], ready: list[tuple]) -> Iterator[pa.RecordBatch]:
        out = kernel(key, parts[0] if len(parts) == 1 else pa.concat_batches(parts))
        if isinstance(out, pd.DataFrame):
            yield pa.RecordBatch.from_pandas(out, schema=arrow, preserve_index=False)
            return
        ready += out
        longest = max((len(v) for row in out for v in row if isinstance(v, bytes)), default=0)
        if len(ready) >= _OUT_ROWS or longest * len(ready) > _OUT_BYTES:
            yield from handed_on(ready)

    def handed_on(ready: list[tuple]) -> Iterator[pa.RecordBatch]:
        if ready:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*ready), arrow)], schema=arrow)
            ready.clear()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, last, ready = [], None, []  # the group that may go on in the next batch, its key, rows to hand on
        for batch in batches:
            if not batch.num_rows:
                continue
            fresh = np.zeros(batch.num_rows, bool)
            fresh[0] = True
            for k in keys:  # by codes, in which a null is a value as any other
                codes = batch.column(k).dictionary_encode("encode").indices.to_numpy()
                fresh[1:] |= codes[1:] != codes[:-1]
            starts = np.flatnonzero(fresh)
            names = list(zip(*(batch.column(k).take(pa.array(starts)).to_pylist() for k in keys)))
            for key, at, end in zip(names, starts.tolist(), [*starts[1:].tolist(), batch.num_rows]):
                if held and key != last:
                    yield from finished(last, held, ready)
                    held = []
                held.append(batch.slice(at, end - at))
                last = key
        if held:
            yield from finished(last, held, ready)
        yield from handed_on(ready)

    return spread(df, *keys).sortWithinPartitions(*keys).mapInArrow(run, schema)


def by_group(df: DataFrame, keys: list[str], kernel: Callable, schema: str) -> DataFrame:
    """Run ``kernel(key, rows)`` once per group and collect its row tuples (or a pandas frame).

    A group is a handful of block rows, so turning them into plain objects costs less than a pandas frame per block.
    """
    return _groups(df, keys, lambda key, rows: kernel(key, [SimpleNamespace(**r) for r in rows.to_pylist()]), schema)


def with_block_key(voxels: DataFrame, block: Shape) -> DataFrame:
    return voxels.withColumns(
        {k: F.floor(F.col(a) / b).cast("int") for k, a, b in zip(BLOCK_KEY, AXES, block)}
    )


def to_blocks(voxels: DataFrame, shape: Shape, block: Shape = DEFAULT_BLOCK, dtype: str = "uint16") -> DataFrame:
    """Sparse voxels -> dense blocks; blocks without any stored voxel are omitted (background)."""

    def scatter(key: tuple, rows: pa.RecordBatch) -> list[tuple]:
        origin = [k * b for k, b in zip(key[2:], block)]
        extent = [min(b, n - o) for b, n, o in zip(block, shape, origin)]
        array = np.zeros(extent, dtype=dtype)
        at = [rows[a].to_numpy(zero_copy_only=False) - o for a, o in zip(AXES, origin)]
        array[tuple(at)] = rows["value"].to_numpy(zero_copy_only=False)
        return [(*key, *origin, *extent, dtype, encode(array))]

    keyed = with_block_key(voxels, block).select(*KEY, *AXES, "value")
    return _groups(keyed, KEY, scatter, BLOCK_SCHEMA)


def _expand(blocks: DataFrame, dense: bool) -> DataFrame:
    """Blocks -> voxel rows by an Arrow map: one record batch per block, no per-row Python."""
    value_type = pa.float64() if dense else pa.int64()

    def expand(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                array = decode(SimpleNamespace(**row)).reshape(-1)
                at = np.arange(array.size) if dense else np.flatnonzero(array)
                index = np.unravel_index(at, (row["nz"], row["ny"], row["nx"]))
                columns = [pa.repeat(pa.scalar(row[c]), len(at)) for c in VOLUME]
                columns += [pa.array(i.astype(np.int64) + row[f"{a}0"]) for a, i in zip(AXES, index)]
                columns.append(pa.array(array[at].astype(value_type.to_pandas_dtype())))
                yield pa.RecordBatch.from_arrays(columns, names=[*VOLUME, *AXES, "value"])

    return blocks.mapInArrow(expand, VOXEL_SCHEMA.replace("value bigint", "value double") if dense else VOXEL_SCHEMA)


def to_voxels(blocks: DataFrame) -> DataFrame:
    """Dense blocks -> non-zero voxels; a map over rows without any shuffle."""
    return _expand(blocks, dense=False)


def _columns(schema: str) -> list[str]:
    return [part.strip().split(" ")[0] for part in schema.split(",")]


def _pieces(blocks: DataFrame, shape: Shape, block: Shape, halo: Shape) -> DataFrame:
    """Cut every block into the parts needed by each target block widened by ``halo``."""

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for row in batch.itertuples(index=False):
                array = decode(row)
                lo = (row.z0, row.y0, row.x0)
                hi = [o + n for o, n in zip(lo, array.shape)]
                spans = [block_range(a, b, s, n, h) for a, b, s, n, h in zip(lo, hi, block, shape, halo)]
                for key in ((i, j, k) for i in spans[0] for j in spans[1] for k in spans[2]):
                    start = [max(o, k * s - h) for o, k, s, h in zip(lo, key, block, halo)]
                    stop = [min(e, (k + 1) * s + h) for e, k, s, h in zip(hi, key, block, halo)]
                    part = array[tuple(slice(a - o, b - o) for a, b, o in zip(start, stop, lo))]
                    out.append((row.round, row.channel, *key, *start, *part.shape, row.dtype, encode(part)))
            if out:
                yield pd.DataFrame(out, columns=_columns(BLOCK_SCHEMA))

    return blocks.mapInPandas(cut, BLOCK_SCHEMA)


def _assemble(key, rows: list, shape: Shape, block: Shape, halo: Shape):
    """One target block with its halo, clipped to the volume: ``(origin, array)``."""
    origin = [max(0, int(k) * s - h) for k, s, h in zip(key, block, halo)]
    stop = [min(n, (int(k) + 1) * s + h) for k, s, n, h in zip(key, block, shape, halo)]
    array = np.zeros([b - a for a, b in zip(origin, stop)], dtype=rows[0].dtype)
    for row in rows:
        part, at = decode(row), (row.z0, row.y0, row.x0)
        lo = [max(p, o) for p, o in zip(at, origin)]
        hi = [min(p + n, e) for p, n, e in zip(at, part.shape, stop)]
        if all(h > l for l, h in zip(lo, hi)):
            inside = part[tuple(slice(l - p, h - p) for l, h, p in zip(lo, hi, at))]
            array[tuple(slice(l - o, h - o) for l, h, o in zip(lo, hi, origin))] = inside
    return origin, array


def reblock(blocks: DataFrame, shape: Shape, block: Shape) -> DataFrame:
    """Change the block shape in one shuffle."""
    return halo_blocks(blocks, shape, block, Shape(0, 0, 0))


def halo_blocks(blocks: DataFrame, shape: Shape, block: Shape, halo: Shape) -> DataFrame:
    """Blocks widened by ``halo`` voxels on each side (clipped at the volume border).

    ``z0, y0, x0`` is the widened origin; the core origin is ``key * block``.
    """

    def join_parts(key: tuple, rows: list) -> list[tuple]:
        origin, array = _assemble(key[2:], rows, shape, block, halo)
        return [(*key, *origin, *array.shape, rows[0].dtype, encode(array))]

    return by_group(_pieces(blocks, shape, block, halo), KEY, join_parts, BLOCK_SCHEMA)


def neighbourhood(
    blocks: DataFrame, shape: Shape, block: Shape, halo: Shape,
    kernel: Callable[[tuple, np.ndarray, list[int]], list[tuple] | pd.DataFrame], schema: str,
) -> DataFrame:
    """Run ``kernel(key, array, core_origin)`` on every block.

    ``array`` has exactly ``halo`` extra voxels per side; beyond the volume they mirror the
    inside (edge voxel repeated), so kernels need no border cases.
    """

    def run(key: tuple, rows: list):
        origin, array = _assemble(key[2:], rows, shape, block, halo)
        core = [int(k) * s for k, s in zip(key[2:], block)]
        extent = [min(s, n - c) for s, n, c in zip(block, shape, core)]
        before = [h - (c - o) for h, c, o in zip(halo, core, origin)]
        after = [h + c + e - o - n for h, c, e, o, n in zip(halo, core, extent, origin, array.shape)]
        return kernel(key, np.pad(array, list(zip(before, after)), mode="symmetric"), core)

    return by_group(_pieces(blocks, shape, block, halo), KEY, run, schema)


def gaussian_smooth(blocks: DataFrame, shape: Shape, block: Shape, sigma: float = 2.0) -> DataFrame:
    """Gaussian filter (four-sigma support, mirrored border) as float64 blocks."""
    radius = len(gaussian_weights(sigma)) // 2

    def kernel(key, array, core):
        out = smooth(array, sigma)
        return [(*key, *core, *out.shape, "float64", encode(out))]

    return neighbourhood(blocks, shape, block, Shape(radius, radius, radius), kernel, BLOCK_SCHEMA)


def block_values(blocks: DataFrame) -> DataFrame:
    """Every voxel of dense blocks, zeros included: ``round, channel, z, y, x, value double``."""
    return _expand(blocks, dense=True)
