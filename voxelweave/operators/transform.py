"""Applying affine matrices and displacement fields; registration quality.

Points are physical (index * spacing). A transform list acts on the output point from the last
entry to the first, then the moving volume is sampled linearly; outside it is 0.

* voxel form: any mix of matrices and fields; joins on integer corner positions;
* block form: one matrix after an optional field, kernels on bounded source boxes -- the path for
  large volumes, giving the same values.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from voxelweave.functions.columns import DECIMALS, axis_columns, half_up
from voxelweave.functions.kernels import decode, encode
from voxelweave.functions.sizing import parts_for, settled
from voxelweave.model import AXES, BLOCK_KEY, BLOCK_SCHEMA, Shape
from voxelweave.operators.blocks import _columns, block_count, by_group

FIELD = ("dz", "dy", "dx")
OUT = ("oz", "oy", "ox")
_EPS = 1e-9


def full_matrix(matrix) -> np.ndarray:
    """4x4 float matrix from a 3x4 or 4x4 one."""
    m = np.eye(4)
    given = np.asarray(matrix, dtype=float)
    if given.shape not in ((3, 4), (4, 4)):
        raise ValueError("an affine matrix must be 3x4 or 4x4")
    m[: given.shape[0]] = given
    return m


def grid_points(spark: SparkSession, shape: Shape, spacing) -> DataFrame:
    """Every output voxel with its physical position ``pz, py, px``."""
    cols = axis_columns(F.col("id"), shape)
    grid = spark.range(shape.size).select(*[cols[a].alias(o) for a, o in zip(AXES, OUT)])
    return grid.withColumns({f"p{a}": F.col(o) * F.lit(float(s)) for a, o, s in zip(AXES, OUT, spacing)})


def map_affine(points: DataFrame, matrix) -> DataFrame:
    m = full_matrix(matrix)
    p = [F.col(f"p{a}") for a in AXES]
    return points.withColumns(
        {
            f"p{a}": sum((p[j] * F.lit(float(m[i, j])) for j in range(3) if m[i, j]), F.lit(float(m[i, 3])))
            for i, a in enumerate(AXES)
        }
    )


def _corners(points: DataFrame, spacing, shape: Shape | None) -> DataFrame:
    """Up to eight ``(cz, cy, cx, w)`` rows per point; corners outside ``shape`` are dropped."""
    out = points.withColumn("w", F.lit(1.0))
    for a, s, n in zip(AXES, spacing, shape or (None,) * 3):
        # Rounding keeps points that should fall on voxel centres there.
        q = F.round(F.col(f"p{a}") / F.lit(float(s)), 9)
        low = F.floor(q).cast("bigint")
        frac = q - low
        pair = F.array(F.struct(low.alias("i"), (F.lit(1.0) - frac).alias("f")), F.struct((low + 1).alias("i"), frac.alias("f")))
        out = out.withColumn("c", F.explode(F.filter(pair, lambda t: t["f"] > _EPS)))
        if n is not None:
            out = out.filter((F.col("c.i") >= 0) & (F.col("c.i") < n))
        out = out.withColumns({f"c{a}": F.col("c.i"), "w": F.col("w") * F.col("c.f")}).drop("c")
    return out


def map_field(points: DataFrame, field: DataFrame, spacing, on_grid: bool) -> DataFrame:
    """Add the displacement at each point: an equi-join on the grid, a gather elsewhere."""
    if on_grid:
        rows = field.select(*[F.col(a).alias(o) for a, o in zip(AXES, OUT)], *FIELD)
        joined = points.join(rows, list(OUT), "left")
    else:
        corners = _corners(points, spacing, None)
        rows = field.select(*[F.col(a).alias(f"c{a}") for a in AXES], *FIELD)
        found = corners.join(rows, [f"c{a}" for a in AXES])
        shifts = found.groupBy(*OUT).agg(*[F.sum(F.col("w") * F.col(d)).alias(d) for d in FIELD])
        joined = points.join(shifts, list(OUT), "left")
    zero = F.lit(0.0)
    return joined.withColumns({f"p{a}": F.col(f"p{a}") + F.coalesce(d, zero) for a, d in zip(AXES, FIELD)}).drop(*FIELD)


def map_points(points: DataFrame, transforms: list, spacing) -> DataFrame:
    """Run points through a transform list, last entry first."""
    on_grid = True
    for t in reversed(transforms):
        if isinstance(t, DataFrame):
            points = map_field(points, t, spacing, on_grid)
        else:
            points = map_affine(points, t)
        on_grid = False
    return points


def apply_transforms(
    moving: DataFrame, transforms: list, shape: Shape, spacing=(1.0, 1.0, 1.0), moving_shape: Shape | None = None
) -> DataFrame:
    """Resample every (round, channel) of ``moving`` onto the output grid in one job.

    The corner table depends on the points only, so all channels share one join with it. Both the join and the
    sums are dealt in parts that grow in number with the grid, not in size.
    """
    points = map_points(grid_points(moving.sparkSession, shape, spacing), transforms, spacing)
    corners = _corners(points, spacing, moving_shape or shape).select(*OUT, *[f"c{a}" for a in AXES], "w")
    rows = moving.select("round", "channel", *[F.col(a).alias(f"c{a}") for a in AXES], "value")
    parts, at = parts_for(moving.sparkSession, 8 * shape.size), [f"c{a}" for a in AXES]
    met = corners.repartition(parts, *at).join(rows.repartition(parts, *at), at)
    weighted = met.select("round", "channel", *OUT, (F.col("w") * F.col("value")).alias("v"))
    dealt = weighted.repartition(parts, "round", "channel", *OUT)
    summed = dealt.groupBy("round", "channel", *OUT).agg(F.sum("v").alias("v"))
    return summed.select(
        "round", "channel", *[F.col(o).alias(a) for a, o in zip(AXES, OUT)], half_up(F.col("v")).alias("value")
    ).filter("value > 0")


def apply_affine(moving: DataFrame, matrix, shape: Shape, spacing=(1.0, 1.0, 1.0), moving_shape=None) -> DataFrame:
    return apply_transforms(moving, [matrix], shape, spacing, moving_shape)


def apply_field(moving: DataFrame, field: DataFrame, shape: Shape, spacing=(1.0, 1.0, 1.0), moving_shape=None) -> DataFrame:
    return apply_transforms(moving, [field], shape, spacing, moving_shape)


# ---------------------------------------------------------------- block form


def index_matrix(matrix, spacing) -> np.ndarray:
    """Physical matrix expressed between voxel indices."""
    m, s = full_matrix(matrix), np.asarray(spacing, dtype=float)
    out = m.copy()
    out[:3, :3] = m[:3, :3] * s[None, :] / s[:, None]
    out[:3, 3] = m[:3, 3] / s
    return out


def _source_box(lo, hi, m: np.ndarray, reach: np.ndarray, shape: Shape):
    """Source voxels that output box ``[lo, hi]`` may touch, clipped to the moving volume."""
    ends = np.array([np.asarray(lo) - reach, np.asarray(hi) + reach])
    corners = np.array([[ends[i][0], ends[j][1], ends[k][2], 1.0] for i in (0, 1) for j in (0, 1) for k in (0, 1)])
    mapped = corners @ m[:3].T
    start = np.maximum(np.floor(mapped.min(axis=0) - 1e-6), 0).astype(int)
    stop = np.minimum(np.floor(mapped.max(axis=0) + 1e-6) + 2, tuple(shape)).astype(int)
    return start, stop


def _sample(array: np.ndarray, origin, coords: np.ndarray, shape: Shape) -> np.ndarray:
    """Linear samples of ``array`` (a box of the volume at ``origin``) at index ``coords`` (3, n)."""
    coords = np.round(coords, 9)
    low = np.floor(coords).astype(np.int64)
    frac = coords - low
    total = np.zeros(coords.shape[1])
    for corner in np.ndindex(2, 2, 2):
        at = low + np.array(corner)[:, None]
        weight = np.prod(np.where(np.array(corner)[:, None] == 1, frac, 1.0 - frac), axis=0)
        local = at - np.asarray(origin)[:, None]
        ok = (weight > _EPS) & np.all((at >= 0) & (at < np.array(tuple(shape))[:, None]), axis=0)
        ok &= np.all((local >= 0) & (local < np.array(array.shape)[:, None]), axis=0)
        total[ok] += weight[ok] * array[tuple(local[:, ok])]
    return total


def field_reach(field_blocks: DataFrame, spacing) -> tuple[float, ...]:
    """Largest displacement per axis in voxels: three numbers, from one pass over the blocks."""

    def largest(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield pd.DataFrame(
                [(r.channel, float(np.abs(decode(r)).max(initial=0.0))) for r in batch.itertuples(index=False)],
                columns=["channel", "reach"],
            )

    rows = field_blocks.mapInPandas(largest, "channel string, reach double").groupBy("channel").agg(F.max("reach")).collect()
    found = {r[0]: r[1] for r in rows}
    return tuple(found.get(d, 0.0) / s for d, s in zip(FIELD, spacing))


def apply_transforms_blocks(
    moving: DataFrame, matrix, shape: Shape, block: Shape, moving_shape: Shape,
    spacing=(1.0, 1.0, 1.0), field_blocks: DataFrame | None = None,
) -> DataFrame:
    """``[matrix, field]`` applied block by block; output blocks of every (round, channel).

    Every moving block finds the output blocks that may read it (its box mapped back, widened by
    the largest displacement) and sends each of them only the crop it needs: a map and one
    shuffle, no join. ``field_blocks`` has channels dz, dy, dx on the output block grid; the
    moving blocks may have any shape.
    """
    m = index_matrix(np.eye(4) if matrix is None else matrix, spacing)
    reach = np.array(field_reach(field_blocks, spacing) if field_blocks is not None else (0.0,) * 3)
    grid = block_count(shape, block)

    def boxes(key):
        lo = [k * b for k, b in zip(key, block)]
        hi = [min(o + b, n) - 1 for o, b, n in zip(lo, block, shape)]
        return lo, hi, *_source_box(lo, hi, m, reach, moving_shape)

    def targets(lo, hi) -> Iterator[tuple[int, int, int]]:
        """Output blocks that may read source voxels ``lo..hi``: the box mapped back, widened."""
        spans = [range(n) for n in grid]
        if abs(np.linalg.det(m[:3, :3])) > 1e-9:
            ends = np.array([np.asarray(lo) - 2.0, np.asarray(hi) + 2.0])
            corners = np.array([[ends[i][0], ends[j][1], ends[k][2], 1.0] for i in (0, 1) for j in (0, 1) for k in (0, 1)])
            back = corners @ np.linalg.inv(m)[:3].T
            start = np.floor(back.min(axis=0) - reach - 1.0)
            stop = np.ceil(back.max(axis=0) + reach + 1.0)
            spans = [range(max(0, int(a // b)), min(n, int(e // b) + 1)) for a, e, b, n in zip(start, stop, block, grid)]
        return ((z, y, x) for z in spans[0] for y in spans[1] for x in spans[2])

    def crop(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for row in batch.itertuples(index=False):
                array, o = decode(row), np.array([row.z0, row.y0, row.x0])
                for key in targets(o, o + array.shape):
                    _, _, start, stop = boxes(key)
                    a, e = np.maximum(start, o), np.minimum(stop, o + array.shape)
                    if np.all(e > a):
                        part = array[tuple(slice(i, j) for i, j in zip(a - o, e - o))]
                        out.append((row.round, row.channel, *key, *a, *part.shape, row.dtype, encode(part)))
            if out:
                yield pd.DataFrame(out, columns=_columns(BLOCK_SCHEMA))

    crops = moving.mapInPandas(crop, BLOCK_SCHEMA).withColumn("kind", F.lit("src"))
    parts = crops
    if field_blocks is not None:
        rounds = [r[0] for r in moving.select("round").distinct().collect()]
        per_round = field_blocks.drop("round").withColumn("round", F.explode(F.array(*[F.lit(r) for r in rounds])))
        parts = crops.unionByName(per_round.withColumn("kind", F.lit("field")))

    def resample(key: tuple, rows: list) -> list[tuple]:
        target = [int(k) for k in key[1:]]
        lo, hi, start, stop = boxes(target)
        extent = [h - o + 1 for o, h in zip(lo, hi)]
        coords = np.indices(extent).reshape(3, -1).astype(float) + np.array(lo, dtype=float)[:, None]
        for row in (r for r in rows if r.kind == "field"):
            axis = FIELD.index(row.channel)
            coords[axis] += decode(row).reshape(-1) / spacing[axis]
        coords = m[:3, :3] @ coords + m[:3, 3:]
        out = []
        sources = [r for r in rows if r.kind == "src"]
        for channel in sorted({r.channel for r in sources}):
            pieces = [r for r in sources if r.channel == channel]
            dtype = pieces[0].dtype
            box = np.zeros(np.maximum(stop - start, 0), dtype=dtype)
            for row in pieces:
                at = tuple(slice(p - s, p - s + n) for p, s, n in zip((row.z0, row.y0, row.x0), start, (row.nz, row.ny, row.nx)))
                box[at] = decode(row)
            values = np.floor(np.round(_sample(box, start, coords, moving_shape), DECIMALS) + 0.5).astype(dtype)
            out.append((key[0], channel, *target, *lo, *extent, dtype, encode(values.reshape(extent))))
        return out

    return by_group(parts, ["round", *BLOCK_KEY], resample, BLOCK_SCHEMA)


# ---------------------------------------------------------------- quality


def paired_values(fixed: DataFrame, moving: DataFrame) -> DataFrame:
    """``z, y, x, f, m`` of two single volumes; one shuffle, absent voxels are 0."""
    zero = F.lit(0).cast("bigint")
    both = fixed.select(*AXES, F.col("value").alias("f"), zero.alias("m")).unionByName(
        moving.select(*AXES, zero.alias("f"), F.col("value").alias("m"))
    )
    return both.groupBy(*AXES).agg(F.max("f").alias("f"), F.max("m").alias("m"))


def normalized_correlation(pairs: DataFrame, size: int, keys: list[str] = ()) -> DataFrame:
    """Pearson correlation over ``size`` dense voxels from sparse pairs (sums only)."""
    f, m = F.col("f").cast("double"), F.col("m").cast("double")
    sums = pairs.groupBy(*keys).agg(
        F.sum(f).alias("sf"), F.sum(m).alias("sm"), F.sum(f * f).alias("sff"), F.sum(m * m).alias("smm"), F.sum(f * m).alias("sfm")
    )
    n = F.lit(float(size))
    top = n * F.col("sfm") - F.col("sf") * F.col("sm")
    bottom = F.sqrt((n * F.col("sff") - F.col("sf") * F.col("sf")) * (n * F.col("smm") - F.col("sm") * F.col("sm")))
    return sums.select(*keys, F.coalesce(F.try_divide(top, bottom), F.lit(0.0)).alias("ncc"))


def bin_of(column: str, bins: int = 32, top: int = 65536) -> Column:
    return F.least(F.floor(F.col(column) * bins / F.lit(float(top))).cast("int"), F.lit(bins - 1))


def mutual_information(
    pairs: DataFrame, size: int, bins: int = 32, top: int = 65536, keys: list[str] = ()
) -> DataFrame:
    """Mutual information of the joint histogram; positions absent on both sides count as (0, 0).

    The histogram has at most ``bins * bins`` rows per key, whatever the volume size; it is
    computed once and the marginals are taken from it.
    """
    keys = list(keys)
    binned = [bin_of("f", bins, top).alias("bf"), bin_of("m", bins, top).alias("bm")]
    return histogram_information(settled(pairs.groupBy(*keys, *binned).agg(F.count(F.lit(1)).alias("n"))), size, keys)


def histogram_information(joint: DataFrame, size: int, keys: list[str] = ()) -> DataFrame:
    """Mutual information of a stored histogram ``bf, bm, n`` per key; what lacks of ``size`` counts as (0, 0)."""
    absent = joint.groupBy(*keys).agg((F.lit(size) - F.sum("n")).alias("n"))
    absent = absent.select(*keys, F.lit(0).alias("bf"), F.lit(0).alias("bm"), "n")
    joint = joint.unionByName(absent).groupBy(*keys, "bf", "bm").agg(F.sum("n").alias("n")).filter("n > 0")
    row = joint.groupBy(*keys, "bf").agg(F.sum("n").alias("nf"))
    col = joint.groupBy(*keys, "bm").agg(F.sum("n").alias("nm"))
    p = F.col("n") / F.lit(float(size))
    term = p * F.log(F.col("n") * F.lit(float(size)) / (F.col("nf").cast("double") * F.col("nm")))
    return joint.join(row, [*keys, "bf"]).join(col, [*keys, "bm"]).groupBy(*keys).agg(F.sum(term).alias("mi"))


def registration_quality(fixed: DataFrame, before: DataFrame, after: DataFrame, shape: Shape) -> DataFrame:
    """Correlation and mutual information against the fixed volume, before and after alignment."""
    stages = paired_values(fixed, before).withColumn("stage", F.lit("before")).unionByName(
        paired_values(fixed, after).withColumn("stage", F.lit("after"))
    )
    ncc = normalized_correlation(stages, shape.size, ["stage"])
    return ncc.join(mutual_information(stages, shape.size, keys=["stage"]), "stage")
