"""Resampling of volumes, label masks and displacement fields.

All operators are driven from the source: each stored voxel emits the few output positions it
contributes to together with its weight, computed by arithmetic (no weight tables, no join); the
spline, with two dozen neighbours an axis, gathers lines instead.
Sums are combined per task before the single shuffle on the output position; background
voxels contribute 0 and are never visited. Coordinates are global, so results do not depend on
how the volume is cut into blocks.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from voxelweave.functions.columns import DECIMALS, half_up
from voxelweave.functions.sizing import parts_for, spread
from voxelweave.model import AXES, Shape

FIELD = ("dz", "dy", "dx")
LINEAR, BSPLINE, CUBIC = "linear", "bspline", "cubic"
# Fixed values of the cubic B-spline prefilter: pole, gain and support of the cardinal spline.
POLE = math.sqrt(3.0) - 2.0
GAIN = math.sqrt(3.0)
SPLINE_REACH = 12
SPACING_CELL = 16  # voxels an axis that are brought together ahead of a change of spacing
SPLINE_CHUNK, SPLINE_GROUP = 256, 65_536  # outputs along a line, and in all, of one group


def _sequence(lo: str, hi: str) -> str:
    return f"if({lo} <= {hi}, sequence({lo}, {hi}), cast(array() as array<bigint>))"


def _taps(axis: str, n: int, m: int, step: float, edge: bool) -> Column:
    """Array of ``(o, w)``: outputs whose linear kernel covers source index ``axis``.

    Output ``o`` samples source coordinate ``o * step``. With ``edge`` the last voxel extends
    half a voxel beyond its centre; positions further out are outside.
    """
    if step == 0:
        lo, hi = "0L", f"{m - 1}L"
    else:
        lo = f"greatest(0L, cast(ceil(({axis} - 1) / {step!r}D) as bigint))"
        hi = f"least({m - 1}L, cast(floor(({axis} + 1.5D) / {step!r}D) as bigint))"
    inside = f"o * {step!r}D < {n - 0.5!r}D" if edge else "true"
    weight = f"if({inside}, 1D - abs(least(o * {step!r}D, {float(n - 1)!r}D) - {axis}), 0D)"
    return F.expr(f"filter(transform({_sequence(lo, hi)}, o -> named_struct('o', o, 'w', {weight})), t -> t.w > 1e-9D)")


def _spread(rows: DataFrame, taps: dict[str, Column]) -> DataFrame:
    """Explode the taps axis by axis; ``w`` is the product weight, z/y/x become output positions."""
    out = rows.withColumn("w", F.lit(1.0))
    for axis, column in taps.items():
        out = out.withColumn("t", F.explode(column)).withColumns({axis: F.col("t.o"), "w": F.col("w") * F.col("t.w")}).drop("t")
    return out


def align_corner_steps(shape: Shape, out: Shape) -> tuple[float, ...]:
    return tuple((n - 1) / (m - 1) if m > 1 else 0.0 for n, m in zip(shape, out))


def downsample(voxels: DataFrame, shape: Shape, factors, out: Shape | None = None) -> DataFrame:
    """Linear zoom by ``1/factor`` with aligned corners; size ``int(dim / factor)``, half-up rounding."""
    if len(factors) != 3 or any(f <= 0 for f in factors):
        raise ValueError("factors must be three positive numbers")
    out = out or shape.scaled_down(factors)
    steps = align_corner_steps(shape, out)
    # A single output plane samples source index 0 only.
    rows = voxels
    for axis, m in zip(AXES, out):
        if m == 1:
            rows = rows.filter(F.col(axis) == 0)
    taps = {a: _taps(a, n, m, s, edge=False) for a, n, m, s in zip(AXES, shape, out, steps)}
    summed = _spread(rows, taps).groupBy("round", "channel", *AXES).agg(F.sum(F.col("w") * F.col("value")).alias("v"))
    return summed.withColumn("value", half_up(F.col("v"))).filter("value > 0").drop("v")


def upsample_labels(labels: DataFrame, shape: Shape, factors=None, target: Shape | None = None) -> DataFrame:
    """Nearest-neighbour enlargement of a label mask; labels never enter arithmetic.

    ``target`` overrides ``factors``. A pure map: every source voxel emits the outputs whose
    rounded source index is its own.
    """
    if target is None:
        if factors is None:
            raise ValueError("give factors or a target shape")
        target = shape.scaled_up(factors)
    out = labels
    for axis, n, m, step in zip(AXES, shape, target, align_corner_steps(shape, target)):
        if step == 0:
            hits = f"if({axis} = 0, {_sequence('0L', f'{m - 1}L')}, cast(array() as array<bigint>))"
        else:
            lo = f"greatest(0L, cast(floor(({axis} - 0.5D) / {step!r}D) as bigint) - 1)"
            hi = f"least({m - 1}L, cast(ceil(({axis} + 0.5D) / {step!r}D) as bigint) + 1)"
            hits = f"filter({_sequence(lo, hi)}, o -> floor(o * {step!r}D + 0.5D) = {axis})"
        out = out.withColumn(axis, F.explode(F.expr(hits)))
    return out


def spacing_shape(shape: Shape, original, target) -> Shape:
    """Size after a change of voxel spacing; spacings are in x, y, z order."""
    sizes = [round(n * a / b) for n, a, b in zip(reversed(tuple(shape)), original, target)]
    return Shape(*reversed(sizes))


def resample_spacing(voxels: DataFrame, shape: Shape, original, target) -> DataFrame:
    """Linear resampling from one physical spacing to another (x, y, z order), same origin.

    Positions more than half a voxel outside give 0; results are truncated to integers.
    """
    out = spacing_shape(shape, original, target)
    steps = [b / a for a, b in zip(reversed(original), reversed(target))]
    taps = {a: _taps(a, n, m, float(s), edge=True) for a, n, m, s in zip(AXES, shape, out, steps)}
    # Neighbours meet first, so most of an output's parts are added up before they travel; several volumes share the parts.
    parts, near = parts_for(voxels.sparkSession, 8 * out.size), [f"near_{a}" for a in AXES]
    cells = voxels.withColumns({k: F.floor(F.col(a) / SPACING_CELL) for k, a in zip(near, AXES)})
    added = _spread(cells.repartition(parts, "round", "channel", *near), taps)
    added = added.groupBy("round", "channel", *near, *AXES).agg(F.sum(F.col("w") * F.col("value")).alias("v"))
    dealt = added.select("round", "channel", *AXES, "v").repartition(parts, "round", "channel", *AXES)
    summed = dealt.groupBy("round", "channel", *AXES).agg(F.sum("v").alias("v"))
    return summed.withColumn("value", F.floor(F.round("v", DECIMALS)).cast("bigint")).filter("value > 0").drop("v")


def _spline(t: np.ndarray) -> np.ndarray:
    """Cardinal cubic spline at ``t``: prefilter response times B-spline, four terms."""
    total = np.zeros(t.shape)
    for j in (-1, 0, 1, 2):
        k = np.floor(t) + j
        d = np.abs(t - k)
        basis = np.where(d < 1, 2 / 3 - d * d + d * d * d / 2, np.where(d < 2, (2 - d) ** 3 / 6, 0.0))
        total += GAIN * np.power(POLE, np.abs(k)) * basis
    return total


def _images(at: np.ndarray, n: int) -> np.ndarray:
    """Places of the sources ``at`` and of their mirror images, a column each; a repeated one is NaN."""
    period = 2 * (n - 1)
    images = at[None] if n == 1 else np.stack([s * at + period * j for j in range(-2, 3) for s in (1, -1)])
    images = np.sort(images, axis=0).astype(np.float64)
    images[1:][images[1:] == images[:-1]] = np.nan
    images[(images < -SPLINE_REACH) | (images > n - 1 + SPLINE_REACH)] = np.nan
    return images


def _spline_weights(outputs: np.ndarray, at: np.ndarray, n: int, step: float) -> tuple[np.ndarray, np.ndarray]:
    """Weight of each source of each output, and whether it is within reach at all."""
    weights, within = np.zeros((len(outputs), len(at))), np.zeros((len(outputs), len(at)), bool)
    for places in _images(at, n):
        with np.errstate(invalid="ignore"):
            met = (outputs[:, None] >= np.ceil((places - SPLINE_REACH) / step)) & (outputs[:, None] <= np.floor((places + SPLINE_REACH) / step))
        used = met.any(0)
        if used.any():
            offset = outputs[:, None] * step - np.where(np.isnan(places[used]), 0.0, places[used])
            weights[:, used] += np.where(met[:, used], _spline(offset), 0.0)
            within |= met
    return weights, within


def _spline_chunks(rows: DataFrame, axis: str, n: int, m: int, step: float) -> DataFrame:
    """Each row once per run of ``SPLINE_CHUNK`` outputs along ``axis`` that it or a mirror image reaches.

    ``chunk`` and the places ``lane_*`` on the other axes name groups of bounded size. Runs are far longer than the spline's reach, so few
    rows lie in two.
    """
    period = 2 * (n - 1)
    images = f"array({axis})" if n == 1 else (
        "array_distinct(flatten(transform(sequence(-2, 2), j -> "
        f"array({axis} + {period}L * j, {period}L * j - {axis}))))"
    )
    last = min(m - 1, math.ceil((n - 0.5) / step))
    while last >= 0 and last * step >= n - 0.5:
        last -= 1
    lo = f"greatest(0L, cast(ceil((p - {SPLINE_REACH}) / {step!r}D) as bigint))"
    hi = f"least({last}L, cast(floor((p + {SPLINE_REACH}) / {step!r}D) as bigint))"
    runs = f"if({lo} <= {hi}, sequence({lo} div {SPLINE_CHUNK}, {hi} div {SPLINE_CHUNK}), cast(array() as array<bigint>))"
    near = f"filter({images}, p -> p >= {-SPLINE_REACH} and p <= {n - 1 + SPLINE_REACH})"
    edge = math.isqrt(SPLINE_GROUP // max(1, min(m, SPLINE_CHUNK)))
    lanes = [F.floor(F.col(a) / edge).alias(f"lane_{a}") for a in AXES if a != axis]
    chunk = F.explode(F.expr(f"array_distinct(flatten(transform({near}, p -> {runs})))")).alias("chunk")
    places = [F.col(a).cast("bigint").alias(a) for a in AXES]
    return rows.dropna(subset=list(AXES)).select(*places, *[F.col(c).cast("double").alias(c) for c in FIELD], *lanes, chunk)


def _spline_axis(rows: DataFrame, axis: str, n: int, m: int, step: float) -> DataFrame:
    """Spline interpolation along one axis: lines of the other two meet in groups and are weighed by one matrix product each."""
    others = [a for a in AXES if a != axis]
    names = [*AXES, *FIELD]

    def weigh(key: tuple[pa.Scalar, ...], part: pa.Table) -> pa.Table:
        first = key[0].as_py() * SPLINE_CHUNK
        outputs = np.arange(first, min(first + SPLINE_CHUNK, m))
        outputs = outputs[outputs * step < n - 0.5]
        at, row = np.unique(part[axis].to_numpy(), return_inverse=True)
        lines, line = np.unique(np.stack([part[a].to_numpy() for a in others]), axis=1, return_inverse=True)
        weights, within = _spline_weights(outputs, at, n, step)

        def table(values: np.ndarray) -> np.ndarray:
            out = np.zeros((len(at), lines.shape[1]))
            np.add.at(out, (row, line.reshape(-1)), values)
            return out

        reach = within.astype(np.float64)
        where = np.nonzero(reach @ table(np.ones(part.num_rows)) > 0)
        found = {axis: outputs[where[0]], **{a: lines[i][where[1]] for i, a in enumerate(others)}}
        columns = [pa.array(found[a].astype(np.int64)) for a in AXES]
        for c in FIELD:
            known = part[c].is_valid().to_numpy()
            values = table(part[c].fill_null(0.0).to_numpy())
            if np.isfinite(values).all():
                total = weights @ values
            else:  # a value that is not finite stays within its reach
                total = np.stack([np.where(within, weights * v, 0.0).sum(1) for v in values.T], axis=1)
            unknown = None if known.all() else (reach @ table(known) == 0)[where]
            columns.append(pa.array(total[where], mask=unknown))
        return pa.Table.from_arrays(columns, names=names)

    keys = ["chunk", *[f"lane_{a}" for a in others]]
    schema = ", ".join([f"{a} bigint" for a in AXES] + [f"{c} double" for c in FIELD])
    return spread(_spline_chunks(rows, axis, n, m, step), *keys).groupBy(*keys).applyInArrow(weigh, schema)


def upsample_field(field: DataFrame, shape: Shape, target: Shape, factors, method: str = LINEAR) -> DataFrame:
    """Displacement field ``z, y, x, dz, dy, dx`` on a grid coarser by ``factors`` -> full grid.

    Vectors are physical and not rescaled; positions outside the coarse grid give 0 (no row).
    ``bspline`` and ``cubic`` are the same cubic B-spline interpolation, done axis by axis so each
    pass touches ``2 * reach`` neighbours instead of their cube; rows travel once per pass, not once per neighbour. Unknown
    methods mean bspline.
    """
    steps = [1.0 / f for f in factors]
    if method == LINEAR:
        sums = [F.sum(F.col("w") * F.col(c)).alias(c) for c in FIELD]
        taps = {a: _taps(a, n, m, s, edge=True) for a, n, m, s in zip(AXES, shape, target, steps)}
        return _spread(field, taps).groupBy(*AXES).agg(*sums)
    out = field
    for axis, n, m, step in zip(AXES, shape, target, steps):
        out = _spline_axis(out, axis, n, m, step)
    return out


def chunk_interpolation(method: str) -> str:
    """Method used by chunk alignment: unknown names fall back to linear."""
    return method if method in (LINEAR, BSPLINE, CUBIC) else LINEAR
