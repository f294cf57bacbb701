"""Tile registration: pairwise shifts by phase correlation and global placement."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import product

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from voxelweave.functions.sizing import settled, spread
from voxelweave.model import AXES
from voxelweave.operators.components import connected_components
from voxelweave.operators.tiles import link_residuals

PEAKS = 75
WINDOW = 32
SHARE, FAN_IN = 8, 128  # windows summed in one task, spectra merged in one
PAIR_VOXELS = 32**3  # voxels of an overlap up to which a pair is a part of one task's work
RUN_ROWS, BATCH_CELLS = 1 << 18, 1 << 20  # voxel rows gathered, and padded cells of the pairs worked on, at once
# Error limits of the global placement.
RELATIVE_ERROR, ABSOLUTE_ERROR = 2.5, 3.5


def _overlap_rows(pairs: DataFrame, voxels: DataFrame) -> DataFrame:
    """Voxels of both tiles inside each overlap, in overlap coordinates."""
    sides = []
    for side in ("a", "b"):
        box = {f"l{a}": F.col(f"lo_{a}") - F.col(f"o{a}_{side}") for a in AXES}
        sides.append(
            pairs.withColumns(box).select(
                "tile_a", "tile_b", F.lit(side).alias("side"), F.col(f"tile_{side}").alias("tile"),
                *[f"l{a}" for a in AXES], *[F.col(f"n_{a}").cast("int").alias(f"n{a}") for a in AXES],
            )
        )
    boxes = sides[0].unionByName(sides[1])
    inside = F.lit(True)
    for a in AXES:
        inside = inside & (F.col(a) >= F.col(f"l{a}")) & (F.col(a) < F.col(f"l{a}") + F.col(f"n{a}"))
    # Boxes grow with the pairs, and a table read back is sized by its compressed file: no broadcast.
    return voxels.join(boxes.hint("shuffle_hash"), "tile").filter(inside).select(
        "tile_a", "tile_b", "side", *[(F.col(a) - F.col(f"l{a}")).cast("int").alias(a) for a in AXES],
        *[f"n{a}" for a in AXES], F.col("value").cast("double").alias("value"),
    )


def _window_rows(rows: DataFrame, window: int) -> DataFrame:
    """Each voxel in the windows that cover it: two an axis at most, so eight copies whatever the overlap's size.

    Windows advance by half their size and the last one ends with the overlap; an axis no longer than a window has one.
    ``share`` numbers neighbouring windows that are summed in one task.
    """
    half, number, out = window // 2, F.lit(0).cast("bigint"), rows
    for a in AXES:
        n, at = F.col(f"n{a}"), F.col(a)
        last = F.greatest(F.ceil((n - window) / half), F.lit(0)).cast("int")
        place = F.floor(at / half).cast("int")

        def start(k):
            return F.greatest(F.least(k * half, n - window), F.lit(0))

        covers = F.filter(
            F.array_distinct(F.array(*[F.greatest(F.least(k, last), F.lit(0)) for k in (place - 1, place, last)])),
            lambda k: (start(k) <= at) & (at < start(k) + window),
        )
        out = out.withColumn(f"w{a}", F.explode(covers)).withColumn(a, at - start(F.col(f"w{a}")))
        number = number * (last + 1) + F.col(f"w{a}")
        out = out.withColumn(f"e{a}", F.least(n, F.lit(window)))
    out = out.withColumn("window", number)
    return out.select(
        "tile_a", "tile_b", "window", F.floor(F.col("window") / SHARE).alias("share"), "side", *AXES, *[f"e{a}" for a in AXES], "value"
    )


_SPECTRUM = "tile_a bigint, tile_b bigint, share bigint, ez int, ey int, ex int, spectrum binary"


def _spectra(key: tuple, part: pd.DataFrame) -> pd.DataFrame:
    """Sum of the cross-power spectra of the windows of a share."""
    extent = tuple(int(part[f"e{a}"].iloc[0]) for a in AXES)
    total = np.zeros((*extent[:2], extent[2] // 2 + 1), np.complex128)
    for _, inside in part.groupby("window"):
        spectra = []
        for side in ("a", "b"):
            image, mine = np.zeros(extent), inside[inside["side"] == side]
            image[tuple(mine[a].to_numpy() for a in AXES)] = mine["value"].to_numpy()
            spectra.append(np.fft.rfftn(image - image.mean()))
        total += spectra[0] * np.conj(spectra[1])
    return pd.DataFrame([(*key, *extent, total.tobytes())], columns=[c.split()[0] for c in _SPECTRUM.split(", ")])


def _merged(key: tuple, part: pd.DataFrame) -> pd.DataFrame:
    """Sum of partial spectra; whole numbers of shares go on to the next level."""
    total = sum(np.frombuffer(x, np.complex128) for x in part["spectrum"].sort_values())
    return part.iloc[:1].assign(share=key[2], spectrum=total.tobytes())


def _peaks(peaks: int):
    """Shifts of the highest places of the phase correlation surface of one pair, with their periods."""

    def task(key: tuple, part: pd.DataFrame) -> pd.DataFrame:
        found = []
        for r in part.itertuples():
            extent = (r.ez, r.ey, r.ex)
            total = np.frombuffer(r.spectrum, np.complex128).reshape(*extent[:2], extent[2] // 2 + 1)
            surface = np.fft.irfftn(total / np.maximum(np.abs(total), 1e-12), extent, (0, 1, 2))
            top = np.argsort(surface, axis=None)[::-1][:peaks]
            places = np.stack(np.unravel_index(top, extent), axis=1)
            found += [places - np.array(wrap) * extent for wrap in np.ndindex(2, 2, 2)]
        shifts = np.unique(np.concatenate(found), axis=0).astype(np.int32)
        return pd.DataFrame(shifts, columns=["sz", "sy", "sx"]).assign(tile_a=key[0], tile_b=key[1])[["tile_a", "tile_b", "sz", "sy", "sx"]]

    return task


def _box_sums(image: np.ndarray, first: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Sums of ``image`` over the boxes ``[first, end)``, from running sums along all axes."""
    total = np.pad(image, ((1, 0),) * 3).cumsum(0).cumsum(1).cumsum(2)
    return sum(
        (-1) ** (3 - sum(corner)) * total[tuple(np.where(c, end[:, i], first[:, i]) for i, c in enumerate(corner))]
        for corner in np.ndindex(2, 2, 2)
    )


def _sums_of_block(a: np.ndarray, b: np.ndarray, n, lo, hi, outer, move: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Which of the shifts ``move`` give the block ``lo..hi`` of side a a partner, and ``u, v, uu, vv, uv`` of those.

    ``b`` is the part of side b from ``outer`` on that such shifts can bring to the block.
    """
    first, end = np.maximum(lo, move), np.minimum(hi, np.array(n) + move)
    common = (first < end).all(1)
    move, first, end = move[common], first[common], end[common]
    in_a, in_b = (first - lo, end - lo), tuple(x - move - outer for x in (first, end))
    out = np.empty((len(move), 5))
    out[:, 0], out[:, 2] = (_box_sums(x, *in_a) for x in (a, a * a))
    out[:, 1], out[:, 3] = (_box_sums(x, *in_b) for x in (b, b * b))
    boxes = zip(*(x.tolist() for x in (*in_a, *in_b)))
    out[:, 4] = [
        float(np.einsum("zyx,zyx->", a[p:s, q:t, r:u], b[f:i, g:j, h:k])) for (p, q, r), (s, t, u), (f, g, h), (i, j, k) in boxes
    ]
    return common, out


def _correlations(rows: DataFrame, extents: DataFrame, shifts: DataFrame, window: int, min_overlap: int) -> DataFrame:
    """``r`` of each of ``shifts (tile_a, tile_b, sz, sy, sx)`` that is within reach, over all voxels of the overlap.

    Side ``a`` is cut into blocks of a window's size; side ``b`` goes to every block that a shift of at most half a window can
    bring it to (an axis of one block knows all shifts). Each block gives sums per shift, which Spark adds up.
    """
    half, names = window // 2, ["tile_a", "tile_b", "side", *[f"b{a}" for a in AXES], *AXES, *[f"n{a}" for a in AXES], "value"]
    trial = shifts.join(extents.hint("merge"), ["tile_a", "tile_b"])
    for a in AXES:
        n, s = F.col(f"n{a}"), F.abs(f"s{a}")
        trial = trial.filter((n - s >= F.least(F.lit(min_overlap), n)) & ((n <= window) | (s <= half)))
    wanted = trial.select("tile_a", "tile_b", F.lit("s").alias("side"), *[F.col(f"s{a}").alias(a) for a in AXES], *[f"n{a}" for a in AXES], F.lit(0.0).alias("value"))
    left, right = rows.filter("side = 'a'"), rows.filter("side = 'b'")
    for a in AXES:
        last = F.floor((F.col(f"n{a}") - 1) / window).cast("int")
        left = left.withColumn(f"b{a}", F.floor(F.col(a) / window).cast("int"))
        low, high = (F.greatest(F.least(F.floor((F.col(a) + d) / window).cast("int"), last), F.lit(0)) for d in (-half, half))
        right = right.withColumn(f"b{a}", F.explode(F.sequence(low, high)))
        wanted = wanted.withColumn(f"b{a}", F.explode(F.sequence(F.lit(0), last)))
    blocks = left.select(names).unionByName(right.select(names)).unionByName(wanted.select(names))
    sums = ["u", "v", "uu", "vv", "uv"]

    def block_sums(key: tuple, part: pd.DataFrame) -> pd.DataFrame:
        n = [int(part[f"n{a}"].iloc[0]) for a in AXES]
        lo = [k * window for k in key[2:]]
        hi = [min(m, l + window) for m, l in zip(n, lo)]
        outer = [(max(0, l - half), min(m, h + half)) for m, l, h in zip(n, lo, hi)]
        a, b = np.zeros([h - l for l, h in zip(lo, hi)]), np.zeros([h - l for l, h in outer])
        for image, side, corner in ((a, "a", lo), (b, "b", [l for l, _ in outer])):
            mine = part[part["side"] == side]
            image[tuple(mine[c].to_numpy() - o for c, o in zip(AXES, corner))] = mine["value"].to_numpy()
        move = part.loc[part["side"] == "s", list(AXES)].to_numpy()
        common, counted = _sums_of_block(a, b, n, lo, hi, [l for l, _ in outer], move)
        found = pd.DataFrame(move[common], columns=["sz", "sy", "sx"]).assign(tile_a=key[0], tile_b=key[1])
        found[sums] = counted
        return found[["tile_a", "tile_b", "sz", "sy", "sx", *sums]]

    keys = ["tile_a", "tile_b", *[f"b{a}" for a in AXES]]
    schema = "tile_a bigint, tile_b bigint, sz int, sy int, sx int, " + ", ".join(f"{c} double" for c in sums)
    found = spread(blocks, *keys).groupBy(*keys).applyInPandas(block_sums, schema)
    total = found.groupBy("tile_a", "tile_b", "sz", "sy", "sx").agg(*[F.sum(c).alias(c) for c in sums]).join(extents.hint("merge"), ["tile_a", "tile_b"])
    n = F.lit(1.0)
    for a in AXES:
        n = n * (F.col(f"n{a}") - F.abs(f"s{a}"))
    spread_u, spread_v = n * F.col("uu") - F.col("u") * F.col("u"), n * F.col("vv") - F.col("v") * F.col("v")
    r = F.when((spread_u > 0) & (spread_v > 0), (n * F.col("uv") - F.col("u") * F.col("v")) / F.sqrt(spread_u) / F.sqrt(spread_v))
    return total.select("tile_a", "tile_b", "sz", "sy", "sx", F.coalesce(r, F.lit(-1.0)).alias("r"))


def _good_length(n: int) -> int:
    """Smallest length from ``n`` on that has no prime factor above 5."""
    while True:
        left = n
        for factor in (2, 3, 5):
            while left % factor == 0:
                left //= factor
        if left == 1:
            return n
        n += 1


def _integral(images: np.ndarray) -> np.ndarray:
    """Running sums of every image along all axes, from a plane of zeros on."""
    return np.pad(images, ((0, 0), *((1, 0),) * 3)).cumsum(1).cumsum(2).cumsum(3)


def _of_boxes(total: np.ndarray, of: np.ndarray, first: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Sums over the boxes ``[first, end)`` of the images ``of``; see :func:`_box_sums`."""
    return sum(
        (-1) ** (3 - sum(corner)) * total[(of, *(np.where(c, end[:, i], first[:, i]) for i, c in enumerate(corner)))]
        for corner in np.ndindex(2, 2, 2)
    )


def _coefficient(n: np.ndarray, u, v, uu, vv, uv) -> tuple[np.ndarray, np.ndarray]:
    """Correlation from sums over ``n`` voxels and its scale; -1 and infinite where a side is constant or a sum missing (NaN)."""
    spread_u, spread_v = n * uu - u * u, n * vv - v * v
    varied = (spread_u > 0) & (spread_v > 0) & ~np.isnan(uv)
    roots = np.sqrt(np.where(varied, spread_u, 1.0)), np.sqrt(np.where(varied, spread_v, 1.0))
    return np.where(varied, (n * uv - u * v) / roots[0] / roots[1], -1.0), np.where(varied, roots[0] * roots[1], np.inf)


class _Overlaps:
    """Overlaps of pairs, all of one extent: ``images (pair, side, z, y, x)``. One step of arithmetic is for all of them."""

    def __init__(self, images: np.ndarray, min_overlap: int, peaks: int, window: int):
        self.images, self.min_overlap, self.peaks, self.window = images, min_overlap, peaks, window
        self.extent = images.shape[2:]
        self.n = np.array(self.extent)
        self.odd = np.isnan(images).any(axis=(1, 2, 3, 4))
        filled = np.where(self.odd[:, None, None, None, None], 0.0, images)  # pairs with null values are summed block by block
        self.sides = [filled[:, 0], filled[:, 1]]
        self.totals = [_integral(x) for side in self.sides for x in (side, side * side)]

    def surfaces(self) -> np.ndarray:
        """Phase correlation surfaces from the cross-power spectra of all windows, summed a share at a time."""
        half, size = self.window // 2, [min(n, self.window) for n in self.extent]
        starts = [
            [max(min(k * half, n - self.window), 0) for k in range(max(-(-(n - self.window) // half), 0) + 1)] for n in self.extent
        ]
        total = share = 0.0
        for i, corner in enumerate(product(*starts)):
            if i and i % SHARE == 0:
                total, share = total + share, 0.0
            part = np.ascontiguousarray(self.images[(..., *(slice(c, c + e) for c, e in zip(corner, size)))])
            mean = part.reshape(*part.shape[:2], -1).mean(-1)
            spectra = np.fft.rfftn(part - mean[:, :, None, None, None], axes=(2, 3, 4))
            share = share + spectra[:, 0] * np.conj(spectra[:, 1])
        total = total + share
        with np.errstate(invalid="ignore"):  # null values
            return np.fft.irfftn(total / np.maximum(np.abs(total), 1e-12), size, (1, 2, 3))

    def reached(self, shifts: np.ndarray) -> np.ndarray:
        far = np.abs(shifts)
        return ((self.n - far >= np.minimum(self.min_overlap, self.n)) & ((self.n <= self.window) | (far <= self.window // 2))).all(-1)

    def candidates(self) -> tuple[np.ndarray, np.ndarray]:
        """Pair and shift of the highest places of each surface, with their periods, as far as they are in reach."""
        surface = self.surfaces()
        size = surface.shape[1:]
        top = np.argsort(surface.reshape(len(surface), -1), axis=1)[:, ::-1][:, : self.peaks]
        places = np.stack(np.unravel_index(top, size), axis=-1)
        shifts = np.concatenate([places - np.array(wrap) * size for wrap in np.ndindex(2, 2, 2)], axis=1)
        of, at = np.nonzero(self.reached(shifts))
        return of, shifts[of, at]

    def sums(self, of: np.ndarray, shifts: np.ndarray) -> tuple[np.ndarray, ...]:
        """Voxels that the sides have in common, and ``u, v, uu, vv`` over them."""
        first, end = np.maximum(0, shifts), np.minimum(self.n, self.n + shifts)
        u, uu = (_of_boxes(t, of, first, end) for t in self.totals[:2])
        v, vv = (_of_boxes(t, of, first - shifts, end - shifts) for t in self.totals[2:])
        return (end - first).prod(1).astype(float), u, v, uu, vv

    def products(self, of: np.ndarray, shifts: np.ndarray) -> np.ndarray:
        """``uv``, summed voxel by voxel."""
        first, end = np.maximum(0, shifts), np.minimum(self.n, self.n + shifts)
        boxes = zip(of.tolist(), *(x.tolist() for x in (first, end, first - shifts, end - shifts)))
        a, b = self.sides
        return np.array([
            float(np.einsum("zyx,zyx->", a[m, p:s, q:t, r:u], b[m, f:i, g:j, h:k])) for m, (p, q, r), (s, t, u), (f, g, h), (i, j, k) in boxes
        ])

    def by_blocks(self, pair: int, shifts: np.ndarray) -> np.ndarray:
        """``r`` of shifts of one pair from sums per block, as :func:`_correlations` has them: those with null values do not count."""
        a, b, half, total = *self.images[pair], self.window // 2, np.full((len(shifts), 5), np.nan)
        for lo in product(*(range(0, n, self.window) for n in self.extent)):
            hi = [min(n, l + self.window) for n, l in zip(self.extent, lo)]
            outer = [(max(0, l - half), min(n, h + half)) for n, l, h in zip(self.extent, lo, hi)]
            parts = a[tuple(map(slice, lo, hi))], b[tuple(slice(*o) for o in outer)]
            common, found = _sums_of_block(*parts, self.extent, lo, hi, [l for l, _ in outer], shifts)
            sums = total[common]
            total[common] = np.where(np.isnan(sums) | np.isnan(found), np.fmax(sums, found), sums + found)
        return _coefficient((self.n - np.abs(shifts)).prod(1).astype(float), *total.T)[0]

    def exact(self, of: np.ndarray, shifts: np.ndarray) -> np.ndarray:
        r = _coefficient(*self.sums(of, shifts), self.products(of, shifts))[0] if len(of) else np.empty(0)
        for pair in np.unique(of[self.odd[of]]).tolist():
            r[of == pair] = self.by_blocks(pair, shifts[of == pair])
        return r

    def contenders(self) -> tuple[np.ndarray, np.ndarray]:
        """The candidates that may be the best of their pair: all products at once by FFT, within what that rounds off."""
        of, shifts = self.candidates()
        padded = [_good_length(2 * n - 1) for n in self.extent]
        spectra = [np.fft.rfftn(x, padded, (1, 2, 3)) for x in self.sides]
        uv = np.fft.irfftn(spectra[0] * np.conj(spectra[1]), padded, (1, 2, 3))[(of, *(shifts % padded).T)]
        n, *sums = self.sums(of, shifts)
        r, scale = _coefficient(n, *sums, uv)
        norms = np.sqrt(np.prod([np.square(x).sum((1, 2, 3)) for x in self.sides], axis=0))
        error = 1e-12 + 1e-13 * n * norms[of] / scale
        least = np.full(len(self.images), -np.inf)
        np.maximum.at(least, of, np.where(np.isinf(scale), -np.inf, r - error))
        near = (~np.isinf(scale) & (r + error >= least[of] - 2e-9)) | self.odd[of]
        return of[near], shifts[near]

    def best(self) -> np.ndarray:
        """``sz, sy, sx, r`` of every pair, with the parts of a voxel; shift 0 and ``r`` -1 without any correlation."""
        of, shifts = self.contenders()
        tops: dict[int, tuple] = {}
        for pair, shift, r in zip(of.tolist(), shifts.tolist(), self.exact(of, shifts).tolist()):
            if r > -1:
                rank = (round(r, 9), -sum(map(abs, shift)), shift, r)
                tops[pair] = max(tops.get(pair, rank), rank)
        out = np.zeros((len(self.images), 4))
        out[:, 3] = -1.0
        pairs = np.array(sorted(tops), dtype=np.int64)
        if not len(pairs):
            return out
        out[pairs, :3], out[pairs, 3] = [tops[p][2] for p in pairs.tolist()], [tops[p][3] for p in pairs.tolist()]
        steps = np.array([[s * (i == j) for j in range(3)] for i in range(3) for s in (-1, 1)])
        beside = out[pairs, None, :3].astype(np.int64) + steps
        inside = self.reached(beside)
        r = np.full(beside.shape[:2], -1.0)
        r[inside] = self.exact(np.repeat(pairs, 6).reshape(-1, 6)[inside], beside[inside])
        left, right = r[:, 0::2], r[:, 1::2]
        bend = left - 2 * out[pairs, 3:] + right
        usable = (left > -1) & (right > -1) & (bend < 0)
        part = np.clip(0.5 * (left - right) / np.where(usable, bend, 1.0), -0.5, 0.5)
        out[pairs, :3] += np.where(usable, part, 0.0)
        return out


_SHIFT = "tile_a bigint, tile_b bigint, sz double, sy double, sx double, r double"


def _pair_task(min_overlap: int, peaks: int, window: int):
    """Shifts of the pairs whose voxels lie in runs of rows ``tile_a, tile_b, size, cell, value``."""

    def solved(a, b, size, cell, value) -> pa.RecordBatch:
        begins = np.concatenate([[True], (a[1:] != a[:-1]) | (b[1:] != b[:-1]) | (size[1:] != size[:-1])])
        run, starts = np.cumsum(begins) - 1, np.flatnonzero(begins)
        out = np.empty((len(starts), 4))
        for code in np.unique(size[starts]).tolist():
            extent = (code >> 40, code >> 20 & 0xFFFFF, code & 0xFFFFF)
            runs = np.flatnonzero(size[starts] == code)
            step = max(1, BATCH_CELLS // (8 * int(np.prod(extent))))
            for some in (runs[i : i + step] for i in range(0, len(runs), step)):
                place = np.full(len(starts), -1)
                place[some] = np.arange(len(some))
                at = place[run]
                images = np.zeros((len(some), 2 * int(np.prod(extent))))
                images[at[at >= 0], cell[at >= 0]] = value[at >= 0]
                out[some] = _Overlaps(images.reshape(-1, 2, *extent), min_overlap, peaks, window).best()
        arrays = [pa.array(x) for x in (a[starts], b[starts], *out.T)]
        return pa.RecordBatch.from_arrays(arrays, names=[c.split()[0] for c in _SHIFT.split(", ")])

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, rows = [], 0
        for batch in batches:
            if batch.column(3).null_count:
                raise ValueError("a voxel lies beyond the whole voxels of its overlap")
            held.append([c.to_numpy(zero_copy_only=False) for c in batch.columns])
            rows += len(batch)
            if rows < RUN_ROWS:
                continue
            columns = [np.concatenate(c) for c in zip(*held)]
            same = np.logical_and.reduce([c == c[-1] for c in columns[:3]])
            cut = int(np.flatnonzero(~same)[-1]) + 1 if not same.all() else 0  # the last run may go on in the next batch
            if cut:
                yield solved(*(c[:cut] for c in columns))
            held, rows = [[c[cut:] for c in columns]], len(same) - cut
        if rows:
            yield solved(*(np.concatenate(c) for c in zip(*held)))

    return task


def _whole_pairs(pairs: DataFrame, voxels: DataFrame, min_overlap: int, peaks: int, window: int) -> DataFrame:
    """Shifts of ``pairs`` of at most ``PAIR_VOXELS`` voxels: a voxel travels once a pair, many pairs are worked on at a time."""
    rows = _overlap_rows(pairs, voxels)
    size, cell = (F.lit(0).cast("bigint") for _ in range(2))
    inside, whole = F.lit(True), F.lit(1).cast("bigint")
    for a in AXES:
        n = F.col(f"n{a}").cast("bigint")
        size, cell, whole, inside = size * (1 << 20) + n, cell * n + F.col(a), whole * n, inside & (F.col(a) < n)
    cell = F.when(inside, cell + F.when(F.col("side") == "b", whole).otherwise(F.lit(0)))
    ids = [F.col(c).cast("bigint").alias(c) for c in ("tile_a", "tile_b")]
    flat = spread(rows.select(*ids, size.alias("size"), cell.alias("cell"), "value"), "tile_a", "tile_b")
    return flat.sortWithinPartitions("tile_a", "tile_b", "size").mapInArrow(_pair_task(min_overlap, peaks, window), _SHIFT)


def phase_correlation(
    pairs: DataFrame, voxels: DataFrame, min_overlap: int = 5, peaks: int = PEAKS, window: int = WINDOW
) -> DataFrame:
    """Shift and correlation of every overlapping pair with voxels: ``tile_a, tile_b, sz, sy, sx, r``.

    ``pairs`` comes from the overlap join (one small row per pair); only the voxels inside an overlap travel and channels are
    averaged. The cross-power spectra of overlapping windows are summed into one per pair whose highest places are the candidate
    shifts; each is then correlated over all voxels of the overlap, and the best one gets its parts of a voxel from the parabola
    through its neighbours. An overlap of up to ``PAIR_VOXELS`` voxels is done in one task, many pairs at once; a larger one goes the
    same way by tables: windows summed in a tree of groups of bounded size, correlations by sums per block. An axis longer than
    ``window`` (even) finds shifts up to half of it, a shorter one all that leave ``min_overlap`` voxels. A pair without any
    correlation has shift 0 and ``r`` -1.
    """
    if window < 2 or window % 2:
        raise ValueError(f"window must be even, not {window}")
    if "channel" in voxels.columns:
        n_channels = voxels.select("channel").distinct().count()
        voxels = voxels.groupBy("tile", *AXES).agg((F.sum("value") / n_channels).alias("value"))
    pairs, size = settled(pairs), F.lit(1.0)
    for a in AXES:
        size = size * F.col(f"n_{a}").cast("int")
    found = _whole_pairs(pairs.filter(size <= PAIR_VOXELS), voxels, min_overlap, peaks, window)
    large = pairs.filter(size > PAIR_VOXELS)
    return found if large.isEmpty() else found.unionByName(_pairs_by_tables(large, voxels, min_overlap, peaks, window))


def _pairs_by_tables(pairs: DataFrame, voxels: DataFrame, min_overlap: int, peaks: int, window: int) -> DataFrame:
    """Shifts of ``pairs`` of any size, no more of one in a task than a share of windows, a spectrum or a block."""
    pair, half = ["tile_a", "tile_b"], window // 2
    rows = settled(_overlap_rows(pairs, voxels))
    extents = rows.select(*pair, *[f"n{a}" for a in AXES]).distinct()
    spectra = spread(_window_rows(rows, window), *pair, "share").groupBy(*pair, "share").applyInPandas(_spectra, _SPECTRUM)
    spectra = settled(spectra)
    most = F.lit(1.0)
    for a in AXES:
        most = most * (F.greatest(F.ceil((F.col(f"n{a}") - window) / half), F.lit(0)) + 1)
    shares = (extents.agg(F.max(most)).first()[0] or 0) / SHARE
    while shares > 1:
        level = spectra.withColumn("share", F.floor(F.col("share") / FAN_IN))
        spectra = settled(level.groupBy(*pair, "share").applyInPandas(_merged, _SPECTRUM))
        shares /= FAN_IN
    shifts = "tile_a bigint, tile_b bigint, sz int, sy int, sx int"
    # A pair at a time: a batch of many pairs would hold all their spectra and shifts at once.
    trial = settled(spread(spectra, *pair).groupBy(*pair).applyInPandas(_peaks(peaks), shifts))
    scored = _correlations(rows, extents, trial, window, min_overlap)
    near = -(F.abs("sz") + F.abs("sy") + F.abs("sx"))
    best = F.max(F.struct(F.round("r", 9).alias("s"), near.alias("near"), *[f"s{a}" for a in AXES], "r")).alias("m")
    tops = settled(scored.filter("r > -1").groupBy(*pair).agg(best).select(*pair, *[F.col(f"m.s{a}").alias(f"s{a}") for a in AXES], "m.r"))
    beside = None
    for a in AXES:
        for step in (-1, 1):
            one = tops.select(*pair, *[(F.col(f"s{c}") + (step if c == a else 0)).alias(f"s{c}") for c in AXES], F.lit(f"{a}{step}").alias("beside"))
            beside = one if beside is None else beside.unionByName(one)
    around = _correlations(rows, extents, beside.drop("beside"), window, min_overlap).join(beside.hint("merge"), [*pair, "sz", "sy", "sx"])
    around = around.groupBy(*pair).agg(*[F.max(F.when(F.col("beside") == f"{a}{s}", F.col("r"))).alias(f"{a}{s}") for a in AXES for s in (-1, 1)])
    found = extents.join(tops.hint("merge"), pair, "left").join(around.hint("merge"), pair, "left")
    out = []
    for a in AXES:
        left, right = F.col(f"{a}-1"), F.col(f"{a}1")
        bend = left - 2 * F.col("r") + right
        part = F.greatest(F.lit(-0.5), F.least(F.lit(0.5), 0.5 * (left - right) / bend))
        usable = (left > -1) & (right > -1) & (bend < 0)
        out.append((F.coalesce(f"s{a}", F.lit(0)) + F.when(usable, part).otherwise(0.0)).alias(f"s{a}"))
    return found.select(*pair, *out, F.coalesce("r", F.lit(-1.0)).alias("r"))


def measured_links(tiles: DataFrame, shifts: DataFrame) -> DataFrame:
    """Displacement of ``tile_b`` relative to ``tile_a``: offsets plus the measured shift."""
    def side(name: str) -> DataFrame:
        return tiles.select(F.col("tile").alias(f"tile_{name}"), *[F.col(f"o{a}").alias(f"o{a}_{name}") for a in AXES])

    joined = shifts.join(side("a"), "tile_a").join(side("b"), "tile_b")
    return joined.select(
        "tile_a", "tile_b", *[(F.col(f"o{a}_b") - F.col(f"o{a}_a") + F.col(f"s{a}")).alias(f"m{a}") for a in AXES]
    )


def _solve(tiles: DataFrame, links: DataFrame, tolerance: float = 1e-12) -> DataFrame:
    """Least-squares positions by conjugate gradients on the tile graph.

    Every product with the graph is one join of the (small) tile state with the links and one
    partially aggregated sum; three scalars per axis reach the driver. Steps start from the stage
    positions, so unlinked tiles and free components keep them. Stops when no axis has a squared
    residual above ``tolerance`` of what it started from, and raises where that is not reached in
    several times the steps that exact arithmetic needs.
    """
    both = links.select("tile_a", "tile_b", *[f"m{a}" for a in AXES]).unionByName(
        links.select(F.col("tile_b").alias("tile_a"), F.col("tile_a").alias("tile_b"), *[(-F.col(f"m{a}")).alias(f"m{a}") for a in AXES])
    )
    both = settled(both)

    def product(state: DataFrame, col: str, measured: bool) -> DataFrame:
        """Per tile: sum over its links of own - other (+ measured displacement)."""
        own = state.select(F.col("tile").alias("tile_a"), *[F.col(f"{col}{a}").alias(f"u{a}") for a in AXES])
        other = state.select(F.col("tile").alias("tile_b"), *[F.col(f"{col}{a}").alias(f"v{a}") for a in AXES])
        term = {a: F.col(f"u{a}") - F.col(f"v{a}") + (F.col(f"m{a}") if measured else F.lit(0.0)) for a in AXES}
        return (
            both.join(own, "tile_a").join(other, "tile_b").groupBy(F.col("tile_a").alias("tile"))
            .agg(*[F.sum(term[a]).alias(f"g{a}") for a in AXES])
        )

    state = settled(tiles.select("tile", *[F.col(f"o{a}").cast("double").alias(f"p{a}") for a in AXES]))
    zero = F.lit(0.0)
    start = state.join(product(state, "p", True), "tile", "left")
    state = settled(start.select("tile", *[f"p{a}" for a in AXES], *[c for a in AXES for c in (
        F.coalesce(-F.col(f"g{a}"), zero).alias(f"r{a}"), F.coalesce(-F.col(f"g{a}"), zero).alias(f"d{a}"))]))
    norm = state.agg(*[F.sum(F.col(f"r{a}") * F.col(f"r{a}")) for a in AXES]).first()
    norm = [n or 0.0 for n in norm]
    goal, turn, most = [tolerance * max(1.0, n) for n in norm], 0, 50 + 5 * tiles.count()
    while any(n > g for n, g in zip(norm, goal)):
        turn += 1
        if turn > most:
            raise RuntimeError(f"tile positions did not settle in {most} steps; squared residuals {norm}")
        step = settled(state.join(product(state, "d", False), "tile", "left").na.fill(0.0, [f"g{a}" for a in AXES]))
        curve = step.agg(*[F.sum(F.col(f"d{a}") * F.col(f"g{a}")) for a in AXES]).first()
        alpha = [n / c if c > 0 else 0.0 for n, c in zip(norm, curve)]
        moved = step.withColumns({
            **{f"p{a}": F.col(f"p{a}") + F.lit(k) * F.col(f"d{a}") for a, k in zip(AXES, alpha)},
            **{f"r{a}": F.col(f"r{a}") - F.lit(k) * F.col(f"g{a}") for a, k in zip(AXES, alpha)},
        })
        new = moved.agg(*[F.sum(F.col(f"r{a}") * F.col(f"r{a}")) for a in AXES]).first()
        beta = [b / n if n > 0 else 0.0 for b, n in zip(new, norm)]
        state = settled(moved.withColumns({f"d{a}": F.col(f"r{a}") + F.lit(k) * F.col(f"d{a}") for a, k in zip(AXES, beta)}).drop(*[f"g{a}" for a in AXES]))
        norm = new
    return state.select("tile", *[f"p{a}" for a in AXES])


def optimize_positions(
    tiles: DataFrame, links: DataFrame, relative: float = RELATIVE_ERROR, absolute: float = ABSOLUTE_ERROR,
    fixed_tile: int = 0,
) -> tuple[DataFrame, DataFrame]:
    """Globally consistent tile positions and the links kept.

    Least squares over all links; while the worst residual exceeds ``absolute`` and ``relative``
    times the mean, the worst link is dropped and the system solved again. The component of
    ``fixed_tile`` is moved back so that tile stays put; tiles of other components keep their
    mean stage position.
    """
    links = settled(links)
    positions = _solve(tiles, links)
    while True:
        scored = settled(link_residuals(positions, links))
        mean, worst = scored.agg(F.avg("residual"), F.max(F.struct("residual", "tile_a", "tile_b"))).first()
        if worst is None or worst[0] <= absolute or worst[0] <= relative * mean:
            break
        links = settled(links.filter(~((F.col("tile_a") == worst[1]) & (F.col("tile_b") == worst[2]))))
        positions = _solve(tiles, links)
    roots = connected_components(links.select(F.col("tile_a").alias("a"), F.col("tile_b").alias("b")))
    rows = positions.join(tiles.select("tile", *[f"o{a}" for a in AXES]), "tile")
    rows = rows.join(roots.withColumnRenamed("node", "tile"), "tile", "left").withColumn("root", F.coalesce("root", "tile"))
    anchor = rows.filter(F.col("tile") == fixed_tile).select("root", *[(F.col(f"o{a}") - F.col(f"p{a}")).alias(f"f{a}") for a in AXES])
    placed = rows.join(settled(anchor), "root", "left")
    moved = [(F.col(f"p{a}") + F.coalesce(f"f{a}", F.lit(0.0))).alias(f"p{a}") for a in AXES]
    return placed.select("tile", *moved), links
