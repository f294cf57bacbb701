"""Estimating and applying the alignment of a moving volume to a fixed one."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from voxelweave.functions.kernels import decode, encode
from voxelweave.functions.sizing import settled, written
from voxelweave.model import AXES, BLOCK_KEY, BLOCK_SCHEMA, Shape
from voxelweave.operators import matching as mt
from voxelweave.operators import resample as rs
from voxelweave.operators import transform as tf
from voxelweave.operators.blocks import _assemble, _pieces, block_count, block_values, by_group, to_blocks
from voxelweave.operators.pixel import imaging_channels, registration_channel

FIELD = ("dz", "dy", "dx")
# Default step list and parameters of the affine estimation.
DEFAULT_STEPS = (
    ("ransac", {"blob_sizes": (2, 100)}),
    ("affine", {"shrink_factors": (4, 2, 1), "iterations": 900}),
)
DEFAULT_OVERLAP = 0.3


# ---------------------------------------------------------------- affine refinement


SCORE_BLOCK = Shape(64, 64, 64)


def binned_blocks(volume: DataFrame, shape: Shape) -> DataFrame:
    """Written blocks of the histogram bins of a volume; what lies outside ``shape`` is left out."""
    inside = [(F.col(a) >= 0) & (F.col(a) < n) for a, n in zip(AXES, shape)]
    filled = volume.filter(inside[0] & inside[1] & inside[2]).withColumn("value", F.coalesce("value", F.lit(0)))
    names = [F.lit("").alias(c) for c in ("round", "channel")]
    return written(to_blocks(filled.select(*names, *AXES, tf.bin_of("value").alias("value")), shape, SCORE_BLOCK, "int32"), "bins")


def _near(m: np.ndarray, points) -> list[np.ndarray]:
    """Nearest voxels of index points (z, y, x) under a 3x4 matrix."""
    z, y, x = points
    return [np.floor(m[r, 3] + m[r, 0] * z + m[r, 1] * y + m[r, 2] * x + 0.5).astype(np.int64) for r in range(3)]


def _box_corners(lo, hi) -> np.ndarray:
    ends = np.array([lo, hi], dtype=float)
    return np.array([[ends[i][0], ends[j][1], ends[k][2]] for i, j, k in np.ndindex(2, 2, 2)]).T


def score_candidates(fixed: DataFrame, moving: DataFrame, shape: Shape, spacing, matrices: list[np.ndarray]) -> DataFrame:
    """Mutual information of every candidate matrix, ``candidate, mi``, in one job; volumes as :func:`binned_blocks`.

    A moving block sends each fixed block the crop that any of the candidates reads there, once for all of them; the
    nearest moving voxel of every fixed one is looked up inside the task, which gives out joint histograms only.
    """
    maps, block = [tf.index_matrix(m, spacing)[:3] for m in matrices], SCORE_BLOCK
    grid = block_count(shape, block)

    def extent(key) -> tuple[list[int], list[int]]:
        lo = [k * b for k, b in zip(key, block)]
        return lo, [min(o + b, n) for o, b, n in zip(lo, block, shape)]

    def source(key) -> tuple[np.ndarray, np.ndarray]:
        """Moving voxels that any candidate reads for the block."""
        lo, hi = extent(key)
        ends = np.array([_near(m, _box_corners(lo, np.array(hi) - 1)) for m in maps])
        start = np.maximum(ends.min(axis=(0, 2)) - 1, 0)
        return start, np.maximum(np.minimum(ends.max(axis=(0, 2)) + 2, tuple(shape)), start)

    def readers(lo, hi) -> set[tuple[int, ...]]:
        """Fixed blocks that may read moving voxels ``lo..hi`` under any candidate."""
        found = set()
        for m in maps:
            spans = [range(n) for n in grid]
            if abs(np.linalg.det(m[:, :3])) > 1e-9:
                back = np.linalg.inv(m[:, :3]) @ (_box_corners(np.asarray(lo) - 1.0, np.asarray(hi) + 1.0) - m[:, 3:])
                ends = zip(np.floor(back.min(axis=1)) - 1, np.ceil(back.max(axis=1)) + 1, block, grid)
                spans = [range(max(0, int(a // b)), min(n, int(e // b) + 1)) for a, e, b, n in ends]
            found.update((z, y, x) for z in spans[0] for y in spans[1] for x in spans[2])
        return found

    def crop(batches):
        for batch in batches:
            out = []
            for row in batch.itertuples(index=False):
                array, o = decode(row), np.array([row.z0, row.y0, row.x0])
                for key in sorted(readers(o, o + array.shape)):
                    start, stop = source(key)
                    a, e = np.maximum(start, o), np.minimum(stop, o + array.shape)
                    part = array[tuple(slice(i, max(i, j)) for i, j in zip(a - o, e - o))] if np.all(e > a) else array[:0]
                    if part.any():
                        out.append((row.round, row.channel, *key, *a.tolist(), *part.shape, row.dtype, encode(part)))
            if out:
                yield pd.DataFrame(out, columns=[f.split()[0] for f in BLOCK_SCHEMA.split(",")])

    def tally(key: tuple, rows: list) -> list[tuple]:
        (lo, hi), (start, stop) = extent(key), source(key)
        f, box = np.zeros([h - l for l, h in zip(lo, hi)], np.int32), np.zeros(stop - start, np.int32)
        for row in rows:
            if row.kind == "fixed":
                f = decode(row)
            else:
                at = [int(p - s) for p, s in zip((row.z0, row.y0, row.x0), start)]
                box[tuple(slice(p, p + n) for p, n in zip(at, (row.nz, row.ny, row.nx)))] = decode(row)
        of_f, f = np.unique(f, return_inverse=True)
        of_m, m = np.unique(np.append(box.reshape(-1), 0), return_inverse=True)  # the last one stands for what is outside
        f, m = f.reshape(-1), m.reshape(-1)
        points = np.indices([h - l for l, h in zip(lo, hi)]).reshape(3, -1) + np.array(lo)[:, None].astype(float)
        out = []
        for i, matrix in enumerate(maps):
            at = [n - s for n, s in zip(_near(matrix, points), start.tolist())]
            inside = np.logical_and.reduce([(n >= 0) & (n < s) for n, s in zip(at, box.shape)])
            index = np.where(inside, (at[0] * box.shape[1] + at[1]) * box.shape[2] + at[2], box.size)
            counts = np.bincount(f * len(of_m) + m[index], minlength=len(of_f) * len(of_m))
            hit = np.flatnonzero(counts)
            out += zip([i] * len(hit), of_f[hit // len(of_m)].tolist(), of_m[hit % len(of_m)].tolist(), counts[hit].tolist())
        return out

    parts = fixed.withColumn("kind", F.lit("fixed")).unionByName(moving.mapInPandas(crop, BLOCK_SCHEMA).withColumn("kind", F.lit("moving")))
    schema = "candidate int, bf int, bm int, n bigint"
    counted = by_group(parts, list(BLOCK_KEY), tally, schema)
    # Candidates without any block are all background.
    none = fixed.sparkSession.createDataFrame([(i, 0, 0, 0) for i in range(len(maps))], schema)
    joint = counted.unionByName(none).groupBy("candidate", "bf", "bm").agg(F.sum("n").alias("n"))
    return tf.histogram_information(settled(joint), shape.size, ["candidate"])


class NotConverged(RuntimeError):
    """An iterative estimate used up its budget before its steps became small."""


def refine_affine(
    fixed: DataFrame, moving: DataFrame, shape: Shape, spacing, start=None, shrink_factors=(4, 2, 1),
    iterations: int = 900, generations: int | None = None, linear_step: float = 0.02, halvings: int = 2,
) -> np.ndarray:
    """Coarse-to-fine search of the matrix with the highest mutual information.

    Each generation scores the current matrix and both directions of all twelve parameters in
    one job, moves to the best, and halves the steps when nothing improves. A level is done when
    nothing improves after ``halvings`` halvings; where ``iterations`` matrices do not bring all
    levels there, :class:`NotConverged` is raised. ``generations`` asks for that many jobs per
    level at least; it never ends a level that still improves. What a coarse level has moved away
    from is scored again on each finer one: ``start`` is among the first matrices of every level and wins ties.
    """
    best = first = tf.full_matrix(np.eye(4) if start is None else start)
    scored = 0
    for shrink in shrink_factors:
        factors = [min(shrink, n) for n in shape]
        small = shape.scaled_down(factors) if shrink > 1 else shape
        f, m = (binned_blocks(rs.downsample(v, shape, factors) if shrink > 1 else v, small) for v in (fixed, moving))
        level = [s * (n - 1) / (k - 1) if k > 1 else s for s, n, k in zip(spacing, shape, small)]
        shift, linear = np.array(level, dtype=float), linear_step * shrink
        done = halved = 0
        while halved <= halvings or done < (generations or 0):
            trials = [best]
            for r in range(3):
                for c in range(4):
                    for sign in (1.0, -1.0):
                        trial = best.copy()
                        trial[r, c] += sign * (shift[r] if c == 3 else linear)
                        trials.append(trial)
            if done == 0 and not np.array_equal(best, first):
                trials.append(first)
            if scored + len(trials) > iterations:
                raise NotConverged(f"{scored} matrices scored, the level of factor {shrink} still improves")
            scored += len(trials)
            scores = {r["candidate"]: round(r["mi"], 9) for r in score_candidates(f, m, small, level, trials).collect()}
            winner = max(scores, key=lambda i: (scores[i], trials[i] is first, -i))
            if winner == 0:
                shift, linear, halved = shift / 2, linear / 2, halved + 1
            best, done = trials[winner], done + 1
    return best


def register_affine(
    fixed: DataFrame, moving: DataFrame, shape: Shape, spacing=(1.0, 1.0, 1.0), factors=(4, 7, 7), steps=None,
    block: Shape = Shape(64, 64, 64),
) -> np.ndarray:
    """4x4 matrix mapping fixed physical points to moving ones.

    Both volumes are downsampled (spacing grows accordingly), then the steps run in order:
    ``ransac`` (blobs, descriptor matches, robust fit) and ``affine`` (mutual-information search).
    """
    small = shape.scaled_down(factors)
    level = [s * (n - 1) / (m - 1) if m > 1 else s * f for s, n, m, f in zip(spacing, shape, small, factors)]
    f, m = (written(rs.downsample(v, shape, factors), "registration-level") for v in (fixed, moving))
    matrix = np.eye(4)
    for name, options in steps or DEFAULT_STEPS:
        options = dict(options)
        if name == "ransac":
            matrix = _ransac_step(f, m, small, level, block, options)
        elif name == "affine":
            options.setdefault("shrink_factors", (4, 2, 1))
            matrix = refine_affine(f, m, small, level, matrix, **options)
        else:
            raise ValueError(f"unknown alignment step {name!r}")
    return matrix


def _ransac_step(fixed: DataFrame, moving: DataFrame, shape: Shape, spacing, block: Shape, options: dict) -> np.ndarray:
    sizes = options.get("blob_sizes", (2, 100))
    points = []
    for volume in (fixed, moving):
        blobs = mt.detect_blobs(
            to_blocks(volume, shape, block), shape, block, sizes, options.get("threshold", 0.0), options.get("patch", 2)
        )
        index = (F.col("z") * shape.ny + F.col("y")) * shape.nx + F.col("x")
        points.append(written(blobs.select(index.alias("id"), *AXES, F.col("patch").alias("vec")), "blobs"))
    pairs = mt.match_features(points[0], points[1], options.get("radius"))
    matches = pairs
    for side, names, rows in (("id_a", mt.P, points[0]), ("id_b", mt.Q, points[1])):
        physical = [(F.col(a) * F.lit(float(s))).alias(n) for a, s, n in zip(AXES, spacing, names)]
        matches = matches.join(rows.select(F.col("id").alias(side), *physical), side)
    matches = written(matches, "matches")
    tolerance = options.get("tolerance", 2.0 * max(spacing))
    return mt.ransac_affine(matches, options.get("n_iter", 500), tolerance, options.get("seed", 0))[0]


# ---------------------------------------------------------------- piecewise deformation


LEAST_NCC = 0.3  # correlation below which two windows do not count as the same structure
KEPT = 8  # displacements handed down from the coarsest level; half as many from each further one, two at least


def _ncc(f: np.ndarray, m: np.ndarray) -> float:
    """Correlation of two windows; -2 without signal."""
    u, v = f - f.mean(), m - m.mean()
    scale = np.sqrt((u * u).sum() * (v * v).sum())
    return round(float((u * v).sum() / scale), 6) if scale > 1e-9 else -2.0


def _pooled(array: np.ndarray, factors: tuple[int, ...]) -> np.ndarray:
    """Means of whole cells; what does not fill one is left out."""
    n = [s // f for s, f in zip(array.shape, factors)]
    cells = array[tuple(slice(0, k * f) for k, f in zip(n, factors))]
    return cells.reshape(n[0], factors[0], n[1], factors[1], n[2], factors[2]).mean(axis=(1, 3, 5))


def _ranked(f: np.ndarray, m: np.ndarray, zero, offsets, inside) -> list[tuple[float, tuple[int, ...]]]:
    """Displacements by correlation, shorter ones first on ties; those without signal are left out.

    Only the part of the displaced window in ``inside``, ranges of ``m``, is compared; it has to be half of the window.
    """
    found = []
    for d in offsets:
        at = [z + i for z, i in zip(zero, d)]
        lo = [max(a, i) for a, (i, _) in zip(at, inside)]
        hi = [min(a + n, i) for a, n, (_, i) in zip(at, f.shape, inside)]
        size = np.prod([max(0, h - l) for l, h in zip(lo, hi)])
        if 2 * size >= f.size:
            own = f[tuple(slice(l - a, h - a) for l, h, a in zip(lo, hi, at))]
            found.append((_ncc(own, m[tuple(map(slice, lo, hi))]), tuple(d)))
    return sorted((x for x in found if x[0] > -2.0), key=lambda x: (-x[0], sum(i * i for i in x[1]), x[1]))


def _reach(shape: Shape, block: Shape) -> tuple[list[int], list[int]]:
    """Largest displacement looked at per axis, a voxel more than a third of the block, and the halvings of the axis."""
    reach = [min(-(-b // 3) + 1, n - 1) for b, n in zip(block, shape)]
    halvings = [max(k for k in range(8) if k == 0 or (b >> k >= 6 and r >> k >= 1)) for b, r in zip(block, reach)]
    return reach, halvings


def _descend(f: np.ndarray, m: np.ndarray, zero, reach, halvings, inside) -> tuple[float, tuple[int, ...]] | None:
    """Best displacement from the coarsest level down; ``m`` holds ``f`` displaced by nothing at ``zero``.

    ``inside`` are the ranges of ``m`` that the volume fills.
    """
    kept: list[tuple[int, ...]] = []
    for level in range(max(halvings), -1, -1):
        factors = tuple(1 << min(level, h) for h in halvings)
        small_f, small_m = _pooled(f, factors), _pooled(m, factors)
        start = [z // q for z, q in zip(zero, factors)]
        if not kept:
            spans = [range(-n, n + 1) for n in (-(-r // q) for r, q in zip(reach, factors))]
            offsets = [(i, j, k) for i in spans[0] for j in spans[1] for k in spans[2]]
        else:
            grown = [2 if level < h else 1 for h in halvings]
            offsets = sorted({tuple(c * g + i - 1 for c, g, i in zip(d, grown, step)) for d in kept for step in np.ndindex(3, 3, 3)})
        filled = [(-(-lo // q), hi // q) for (lo, hi), q in zip(inside, factors)]
        ranked = _ranked(small_f, small_m, start, offsets, filled)
        if not ranked:
            return None
        kept = [d for _, d in ranked[: max(2, KEPT >> (max(halvings) - level))]]
    return ranked[0]


def block_shifts(
    fixed: DataFrame, moving: DataFrame, shape: Shape, block: Shape, overlap: float = DEFAULT_OVERLAP,
    search=None, min_ncc: float = LEAST_NCC,
) -> DataFrame:
    """Displacement of every overlapping block, ``bz, by, bx, dz, dy, dx, ncc`` (voxels).

    Every block has a pyramid of its fixed window and of the moving one, which is wider by a third of the
    block. On the coarsest level all displacements are correlated; the best are handed down, doubled, and
    corrected by a voxel on each level. A winner on the edge of what was looked at may be the flank of a
    better one beyond: it gives no row, nor do windows without signal or below ``min_ncc``. What lies outside
    the moving volume is not compared.

    ``search`` asks for all whole-voxel displacements within a given window instead, background beyond the
    volume; the highest correlation wins, edge or not (shortest displacement on ties).
    """
    halo = Shape(*(int(overlap * b) for b in block))
    reach, halvings = (list(search), [0, 0, 0]) if search else _reach(shape, block)
    # The moving window begins whole cells before the fixed one on every level.
    before = [-(-r // (1 << h)) * (1 << h) for r, h in zip(reach, halvings)]
    wide = Shape(*(h + b for h, b in zip(halo, before)))
    tagged = fixed.withColumn("channel", F.lit("fixed")).unionByName(moving.withColumn("channel", F.lit("moving")))
    window = [d for d in np.ndindex(*(2 * r + 1 for r in reach))] if search else []
    window = [tuple(i - r for i, r in zip(d, reach)) for d in window]

    def best(key: tuple, rows: list) -> list[tuple]:
        parts = {c: [r for r in rows if r.channel == c] for c in ("fixed", "moving")}
        if not all(parts.values()):
            return []
        at, f = _assemble(key, parts["fixed"], shape, block, halo)
        origin, m = _assemble(key, parts["moving"], shape, block, wide)
        f = f.astype(np.float64)
        pad = [
            (max(0, o - (a - b)), max(0, (a + n + b) - (o + k)))
            for o, a, b, n, k in zip(origin, at, before, f.shape, m.shape)
        ]
        inside = [(p, p + n) for (p, _), n in zip(pad, m.shape)]
        m = np.pad(m.astype(np.float64), pad)
        if search:
            found = next(iter(_ranked(f, m, before, window, [(0, n) for n in m.shape])), None)
        else:
            found = _descend(f, m, before, reach, halvings, inside)
            if found and any(abs(d) >= r for d, r in zip(found[1], reach) if r):
                return []
        if found is None or found[0] < min_ncc:
            return []
        return [(*key, *map(float, found[1]), found[0])]

    schema = "bz int, by int, bx int, dz double, dy double, dx double, ncc double"
    return by_group(_pieces(tagged, shape, block, wide), list(BLOCK_KEY), best, schema)


def field_blocks(shifts: DataFrame, shape: Shape, block: Shape, spacing=(1.0, 1.0, 1.0)) -> DataFrame:
    """Smooth displacement field (physical units) as blocks with channels dz, dy, dx.

    Each voxel blends the block centres around it with linear ramps; weights are normalised over
    the blocks that have a displacement, which rebalances missing neighbours. Only control
    vectors are shuffled: a block gathers at most 27 of them.
    """
    grid = block_count(shape, block)
    near = shifts.select(F.col("bz").alias("cz"), F.col("by").alias("cy"), F.col("bx").alias("cx"), *FIELD)
    for a, n in zip(AXES, grid):
        reach = F.sequence(F.greatest(F.col(f"c{a}") - 1, F.lit(0)), F.least(F.col(f"c{a}") + 1, F.lit(n - 1)))
        near = near.withColumn(f"b{a}", F.explode(reach))

    def blend(key: tuple, rows: list) -> list[tuple]:
        target = [int(k) for k in key]
        lo = [k * b for k, b in zip(target, block)]
        extent = [min(b, n - o) for b, n, o in zip(block, shape, lo)]
        total, sums = np.zeros(extent), [np.zeros(extent) for _ in FIELD]
        for row in rows:
            ramps = []
            for c, b, o, e in zip((row.cz, row.cy, row.cx), block, lo, extent):
                position = (np.arange(o, o + e) - (b - 1) / 2.0) / b
                ramps.append(np.clip(1.0 - np.abs(position - c), 0.0, None))
            weight = ramps[0][:, None, None] * ramps[1][None, :, None] * ramps[2][None, None, :]
            total += weight
            for s, d in zip(sums, (row.dz, row.dy, row.dx)):
                s += weight * d
        out = []
        for name, s, unit in zip(FIELD, sums, spacing):
            values = np.divide(s, total, out=np.zeros(extent), where=total > 0) * unit
            out.append(("field", name, *target, *lo, *extent, "float64", encode(values)))
        return out

    return by_group(near, list(BLOCK_KEY), blend, BLOCK_SCHEMA)


def field_rows(blocks: DataFrame) -> DataFrame:
    """Field blocks as ``z, y, x, dz, dy, dx`` rows; zero vectors are left out."""
    values = block_values(blocks).filter("value <> 0")
    comps = [F.coalesce(F.max(F.when(F.col("channel") == d, F.col("value"))), F.lit(0.0)).alias(d) for d in FIELD]
    return values.groupBy(*AXES).agg(*comps)


def piecewise_field(
    fixed: DataFrame, moving: DataFrame, shape: Shape, block: Shape, spacing=(1.0, 1.0, 1.0),
    overlap: float = DEFAULT_OVERLAP, search=None, min_ncc: float = LEAST_NCC,
) -> DataFrame:
    """Displacement field (blocks) aligning ``moving`` to ``fixed``: block shifts, then the blend."""
    shifts = settled(block_shifts(fixed, moving, shape, block, overlap, search, min_ncc))
    return field_blocks(shifts, shape, block, spacing)


def register_deformation(
    fixed: DataFrame, moving: DataFrame, shape: Shape, block: Shape, spacing=(1.0, 1.0, 1.0), matrix=None,
    initial_field: DataFrame | None = None, use_chunk_alignment: bool = False, **options,
) -> tuple[DataFrame, DataFrame]:
    """Initial transform, dense field, final volume; returns ``(field blocks, aligned blocks)``.

    The initial transform is the affine matrix, or the chunk-wise field when
    ``use_chunk_alignment`` is set. Intermediate volumes are written tables.
    """
    if use_chunk_alignment:
        if initial_field is None:
            raise ValueError("initial_field is required when use_chunk_alignment is set")
        first = tf.apply_transforms_blocks(moving, None, shape, block, shape, spacing, initial_field)
    else:
        first = tf.apply_transforms_blocks(moving, matrix, shape, block, shape, spacing)
    first = written(first, "initial-aligned")
    field = written(piecewise_field(fixed, first, shape, block, spacing, **options), "deformation-field")
    return field, tf.apply_transforms_blocks(first, None, shape, block, shape, spacing, field)


def check_factors(factors) -> tuple[int, ...]:
    if len(factors) != 3 or any(f < 1 for f in factors):
        raise ValueError("downsample factors must be three positive integers")
    return tuple(factors)


def chunk_alignment(
    fixed: DataFrame, moving: DataFrame, shape: Shape, block: Shape, spacing=(1.0, 1.0, 1.0), factors=(1, 3, 3),
    method: str = "linear", overlap: float = DEFAULT_OVERLAP, **options,
) -> DataFrame:
    """Initial displacement field for non-linear deformation: ``z, y, x, dz, dy, dx`` at full size.

    Works on downsampled voxels; the coarse field is enlarged without changing its vectors.
    """
    factors = check_factors(factors)
    small = shape.scaled_down(factors)
    level = [s * f for s, f in zip(spacing, factors)]
    pair = [to_blocks(rs.downsample(v, shape, factors), small, block) for v in (fixed, moving)]
    coarse = piecewise_field(*pair, small, block, level, overlap, **options)
    return rs.upsample_field(field_rows(coarse), small, shape, factors, rs.chunk_interpolation(method))


def field_to_blocks(field: DataFrame, shape: Shape, block: Shape) -> DataFrame:
    """Field rows -> blocks with channels dz, dy, dx."""
    pairs = [v for d in FIELD for v in (F.lit(d), F.col(d))]
    long = field.select(F.lit("field").alias("round"), *AXES, F.explode(F.create_map(*pairs)).alias("channel", "value"))
    return to_blocks(long, shape, block, "float64")


def initial_global_alignment(
    fixed: DataFrame, moving: DataFrame, channels: list[str], shape: Shape, spacing=(1.0, 1.0, 1.0),
    strategy: str = "mean", factors=(4, 7, 7), steps=None, block: Shape = Shape(64, 64, 64),
) -> tuple[DataFrame, DataFrame, np.ndarray]:
    """Registration channels of both rounds and the affine between them."""
    pair = [written(registration_channel(v, channels, shape, strategy), "registration-channel") for v in (fixed, moving)]
    return *pair, register_affine(*pair, shape, spacing, factors, steps, block)


def run_registration(
    fixed: DataFrame, moving: DataFrame, channels: list[str], shape: Shape, block: Shape, spacing=(1.0, 1.0, 1.0),
    strategy: str = "mean", factors=(4, 7, 7), steps=None, use_chunk_alignment: bool = False, chunk: dict | None = None,
    **options,
) -> dict:
    """Both stages for one pair of rounds: matrix, optional initial field, field and aligned volume."""
    initial = None
    if use_chunk_alignment:
        f, m = (written(registration_channel(v, channels, shape, strategy), "registration-channel") for v in (fixed, moving))
        initial = written(field_to_blocks(chunk_alignment(f, m, shape, block, spacing, **(chunk or {})), shape, block), "initial-field")
        matrix = np.eye(4)
    else:
        f, m, matrix = initial_global_alignment(fixed, moving, channels, shape, spacing, strategy, factors, steps, block)
    blocks = [to_blocks(v, shape, block) for v in (f, m)]
    field, aligned = register_deformation(*blocks, shape, block, spacing, matrix, initial, use_chunk_alignment, **options)
    return {
        "method": "chunk_alignment" if use_chunk_alignment else "global_alignment",
        "matrix": matrix, "initial_field": initial, "field": field, "aligned": aligned, "fixed": f,
    }


def align_channels(
    moving: DataFrame, result: dict, shape: Shape, block: Shape, spacing=(1.0, 1.0, 1.0)
) -> DataFrame:
    """Apply a registration to every imaging channel of a round in one job; keyed by channel name."""
    volume = to_blocks(imaging_channels(moving), shape, block)
    if result["initial_field"] is None:
        return tf.apply_transforms_blocks(volume, result["matrix"], shape, block, shape, spacing, result["field"])
    # The final field acts on the point first, then the initial one at the moved point.
    fields = [field_rows(result["initial_field"]), field_rows(result["field"])]
    return to_blocks(tf.apply_transforms(imaging_channels(moving), fields, shape, spacing), shape, block)
