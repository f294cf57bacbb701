"""Feature points: detection, descriptor matching, robust and least-squares affine fits."""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from voxelweave.functions.columns import DECIMALS
from voxelweave.functions.kernels import gaussian_weights, smooth
from voxelweave.functions.sizing import spread, written
from voxelweave.model import AXES, Shape
from voxelweave.operators.blocks import neighbourhood

CHUNK_ROWS = 2000
#: Pivots and rings around each of them at most; larger tables have larger cells.
PIVOTS, RINGS = 128, 16
#: Rows of either side that a task compares, about; neighbouring cells go to it together, larger ones are dealt in shares.
SHARE_ROWS = 16_384
#: Bounds or distances that a task holds at once.
_HELD = 1 << 20


def blob_sigmas(sizes) -> tuple[float, float]:
    """Gaussian widths whose difference responds to blobs of diameter ``sizes = (min, max)``."""
    return tuple(s / (2.0 * math.sqrt(3.0)) for s in sizes)


def detect_blobs(
    blocks: DataFrame, shape: Shape, block: Shape, sizes=(2, 100), threshold: float = 0.0, patch: int = 1
) -> DataFrame:
    """Local maxima of the difference of Gaussians of one volume, with a local patch descriptor.

    ``z, y, x, response, patch``: strict maximum over the 26 neighbours inside the volume and
    above ``threshold``. The halo covers the wider Gaussian, so blocks never miss a point.
    """
    narrow, wide = blob_sigmas(sizes)
    r1, r2 = (len(gaussian_weights(s)) // 2 for s in (narrow, wide))
    margin = max(1, patch)
    reach = r2 + margin

    def kernel(key, array, core):
        cut = r2 - r1
        inner = tuple(slice(cut, n - cut) for n in array.shape)
        low = smooth(array[inner], narrow)
        dog = np.round(low - smooth(array, wide), DECIMALS)
        for axis, (c, n) in enumerate(zip(core, shape)):
            at = np.arange(dog.shape[axis]) + c - margin
            outside = (at < 0) | (at >= n)
            dog[tuple(outside if a == axis else slice(None) for a in range(3))] = -np.inf
        extent = [n - 2 * margin for n in dog.shape]
        here = dog[tuple(slice(margin, margin + e) for e in extent)]
        top = here > threshold
        for shift in np.ndindex(3, 3, 3):
            if shift != (1, 1, 1):
                top &= here > dog[tuple(slice(margin - 1 + s, margin - 1 + s + e) for s, e in zip(shift, extent))]
        where = np.nonzero(top)
        patches = []
        for z, y, x in zip(*where):
            box = low[tuple(slice(i + margin - patch, i + margin + patch + 1) for i in (z, y, x))].reshape(-1)
            box = box - box.mean()
            norm = np.linalg.norm(box)
            patches.append(box / norm if norm > 0 else box)
        frame = {a: w.astype(np.int64) + c for a, w, c in zip(AXES, where, core)}
        return pd.DataFrame({**frame, "response": here[where], "patch": patches})

    schema = "z bigint, y bigint, x bigint, response double, patch array<double>"
    return neighbourhood(blocks, shape, block, Shape(reach, reach, reach), kernel, schema)


@dataclass
class Cells:
    """Rows by nearest pivot and ring of distance to it.

    ``pivots`` and the limits ``table`` (pivot, lowest and highest distance to it, rows of each cell) are at most ``PIVOTS`` vectors and
    ``PIVOTS * RINGS`` lines, whatever the number of rows; ``rows`` is the table ``id, vec, cell``.
    """

    pivots: np.ndarray
    table: np.ndarray
    rows: DataFrame


def _matrix(vectors: pd.Series) -> np.ndarray:
    return np.stack(vectors.to_numpy()).astype(np.float64)


def _gaps(vectors: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    """Distances to the pivots from differences, so that equal vectors are at exactly 0."""
    return np.stack([np.sqrt(((vectors - p) ** 2).sum(1)) for p in pivots], axis=1)


def metric_cells(rows: DataFrame, chunk_rows: int) -> Cells | None:
    """Cells of ``id, vec``; None without rows. Pivots are the rows of lowest hash."""
    n = rows.count()
    if n == 0:
        return None
    k = min(PIVOTS, -(-n // chunk_rows))
    first = rows.orderBy(F.xxhash64("id"), "id").limit(k).select("vec").collect()
    pivots = np.array([r[0] for r in first], dtype=np.float64)

    def place(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            if len(frame):
                gaps = _gaps(_matrix(frame["vec"]), pivots)
                near = gaps.argmin(1)
                yield frame.assign(pivot=near.astype(np.int32), gap=gaps[np.arange(len(near)), near])

    placed = written(rows.select("id", "vec").mapInPandas(place, "id bigint, vec array<double>, pivot int, gap double"), "pivot-rows")
    steps = [(i + 1) / RINGS for i in range(RINGS - 1)]
    edges = {}
    for pivot, count, marks in placed.groupBy("pivot").agg(F.count(F.lit(1)), F.percentile_approx("gap", steps, 1000)).collect():
        rings = min(RINGS, -(-count // chunk_rows))
        edges[pivot] = np.array([marks[i * RINGS // rings - 1] for i in range(1, rings)])

    @F.pandas_udf("int")
    def ring(pivot: pd.Series, gap: pd.Series) -> pd.Series:
        return pd.Series([p * RINGS + int(edges[p].searchsorted(g)) for p, g in zip(pivot, gap)], dtype="int32")

    ringed = written(placed.select("id", "vec", ring("pivot", "gap").alias("cell"), "gap"), "ring-rows")
    limits = ringed.groupBy("cell").agg(F.min("gap"), F.max("gap"), F.count(F.lit(1))).collect()
    table = np.array(sorted((c, lo, hi, m) for c, lo, hi, m in limits), dtype=np.float64)
    return Cells(pivots, table, ringed.select("id", "vec", "cell"))


def _least(vectors: np.ndarray, pivots: np.ndarray, table: np.ndarray) -> np.ndarray:
    """Lower bound of the distance of each vector to the rows of each cell.

    From the triangle inequality: over the ring's limits, and because a row of a cell is no farther from its pivot than from the
    pivot that is nearest to the vector.
    """
    gaps = _gaps(vectors, pivots)
    at = gaps[:, (table[:, 0] // RINGS).astype(int)]
    ring = np.maximum(table[:, 1] - at, at - table[:, 2])
    return np.maximum(np.maximum(ring, (at - gaps.min(1)[:, None]) / 2), 0.0)


def _bundles(cells: Cells) -> np.ndarray:
    """Number of the bundle of each line of the table: cells in order, as many as hold ``SHARE_ROWS`` rows together."""
    out, held = [], 0
    for n in cells.table[:, 3]:
        if out and held + n <= SHARE_ROWS:
            held += n
            out.append(out[-1])
        else:
            held = n
            out.append(out[-1] + 1 if out else 0)
    return np.array(out, dtype=np.int32)


def _visits(queries: DataFrame, cells: Cells) -> DataFrame:
    """``id, vec, bundle, cells``: as :func:`open_cells`, a row per bundle, so a vector is copied for bundles and not for cells."""
    bounded, pivots, table, bundles = "bound" in queries.columns, cells.pivots, cells.table, _bundles(cells)
    names = table[:, 0].astype(np.int32)
    spans = [(int(b), *np.searchsorted(bundles, [b, b + 1]).tolist()) for b in np.unique(bundles)]
    step = max(1, _HELD // len(table))

    def choose(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for whole in frames:
            for at in range(0, len(whole), step):
                frame = whole[at : at + step]
                vectors = _matrix(frame["vec"])
                least = _least(vectors, pivots, table)
                if bounded:
                    # Room for the rounding of distances that come from a matrix product.
                    bound = frame["bound"].to_numpy()
                    room = 1e-6 * (1.0 + 2.0 * np.sqrt((vectors * vectors).sum(1)) + bound)
                    chosen = least <= (bound + room)[:, None]
                else:
                    chosen = np.zeros(least.shape, bool)
                    chosen[np.arange(len(least)), least.argmin(1)] = True
                for bundle, start, end in spans:
                    part = chosen[:, start:end]
                    rows = part.any(1)
                    if rows.any():
                        yield frame.loc[rows, ["id", "vec"]].assign(bundle=np.int32(bundle), cells=[names[start:end][c] for c in part[rows]])

    return queries.mapInPandas(choose, "id bigint, vec array<double>, bundle int, cells array<int>")


def open_cells(queries: DataFrame, cells: Cells) -> DataFrame:
    """``id, vec, cell``: the cells that may hold a row as near as ``bound``; without that column the most promising one."""
    return _visits(queries, cells).select("id", "vec", F.explode("cells").alias("cell"))


def _nearest(u: np.ndarray, v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distance and place of the nearest of ``v`` to each of ``u``, the first one on ties."""
    square = (u * u).sum(1)[:, None] + (v * v).sum(1)[None, :]
    product = u @ v.T
    product *= 2.0
    square -= product
    low = square.min(1)
    if np.isnan(low).any():
        dist = np.sqrt(np.maximum(np.round(square, 12), 0.0))
        at = dist.argmin(1)
        return dist[np.arange(len(at)), at], at
    # Rounded distances can agree within this room only.
    row, col = np.nonzero(square <= (low + 1e-11 + 1e-14 * np.abs(low))[:, None])
    dist = np.sqrt(np.maximum(np.round(square[row, col], 12), 0.0))
    order = np.lexsort((col, dist, row))
    first = order[np.unique(row[order], return_index=True)[1]]
    return dist[first], col[first]


def _best_of_cells(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
    """Nearest row of the cells that each visitor names, ties to the smaller id."""
    if left.empty or right.empty:
        return pd.DataFrame(columns=["id", "other", "distance"])
    right = right.sort_values(["cell", "id"])
    u, v, ids, held = _matrix(left["vec"]), _matrix(right["vec"]), right["id"].to_numpy(), right["cell"].to_numpy()
    visited = np.concatenate(left["cells"].to_numpy())
    visitor = np.repeat(np.arange(len(left)), left["cells"].map(len))
    order = np.argsort(visited, kind="stable")
    visited, visitor = visited[order], visitor[order]
    met, other, distance = np.zeros(len(left), bool), np.zeros(len(left), np.int64), np.full(len(left), np.nan)
    starts = np.flatnonzero(np.concatenate([[True], held[1:] != held[:-1]]))
    for s, e in zip(starts, [*starts[1:], len(held)]):
        mine = visitor[slice(*np.searchsorted(visited, [held[s], held[s] + 1]))]
        step = max(1, _HELD // (e - s))
        for k in range(0, len(mine), step):
            rows = mine[k : k + step]
            gap, at = _nearest(u[rows], v[s:e])
            name, old = ids[s:e][at], distance[rows]
            alike = (gap == old) | (np.isnan(gap) & np.isnan(old))
            better = ~met[rows] | (gap < old) | (np.isnan(old) & ~np.isnan(gap)) | (alike & (name < other[rows]))
            met[rows], other[rows[better]], distance[rows[better]] = True, name[better], gap[better]
    return pd.DataFrame({"id": left["id"].to_numpy()[met], "other": other[met], "distance": distance[met]})


def _best_in_cells(visits: DataFrame, cells: Cells, whole: bool) -> DataFrame:
    """Nearest row of the visited cells, ``id, other, distance``; of one part of a cell beyond ``SHARE_ROWS`` unless ``whole``.

    Rows of a bundle and its visitors are both dealt by hash into shares of about ``SHARE_ROWS``; a pair of shares is compared cell by
    cell by matrix products, so no pair of rows is ever emitted and no group outgrows its share, however many rows are alike.
    """
    spark = visits.sparkSession
    visitors = dict(visits.groupBy("bundle").count().collect())
    bundles, sizes = _bundles(cells), []
    for bundle, n in enumerate(np.bincount(bundles, cells.table[:, 3]).astype(int).tolist()):
        parts = -(-n // SHARE_ROWS)
        sizes.append((bundle, parts, max(1, -(-visitors.get(bundle, 0) // (SHARE_ROWS * (1 if whole else parts))))))
    dealt = F.broadcast(spark.createDataFrame(sizes, "bundle int, parts int, shares int"))  # at most PIVOTS * RINGS rows
    lines = list(zip(cells.table[:, 0].astype(int).tolist(), bundles.tolist()))
    placed = F.broadcast(spark.createDataFrame(lines, "cell int, bundle int"))  # as many at most

    def copies(n: str) -> Column:
        return F.explode(F.sequence(F.lit(0), F.col(n) - 1))

    def own(n: str, salt: int) -> Column:
        return F.pmod(F.xxhash64("id", F.lit(salt)), F.col(n)).cast("int")

    part = copies("parts") if whole else own("parts", 2)
    left = visits.join(dealt, "bundle").select("id", "vec", "bundle", "cells", own("shares", 1).alias("share"), part.alias("part"))
    rows = cells.rows.join(placed, "cell").join(dealt, "bundle")
    right = rows.select("id", "vec", "cell", "bundle", own("parts", 3).alias("part"), copies("shares").alias("share"))
    keys = ("bundle", "part", "share")
    sides = [spread(side, *keys).groupBy(*keys) for side in (left, right)]
    found = sides[0].cogroup(sides[1]).applyInPandas(_best_of_cells, "id bigint, other bigint, distance double")
    return found.groupBy("id").agg(F.min(F.struct("distance", "other")).alias("m")).select("id", "m.other", "m.distance")


def nearest_rows(queries: DataFrame, rows: DataFrame, chunk_rows: int = CHUNK_ROWS) -> DataFrame:
    """The nearest of ``rows`` to each of ``queries`` (both ``id, vec``): ``id, other, distance``, ties to the smaller id. Exact.

    Each query first meets the most promising cell, which bounds its distance, then all cells that the bound leaves open. Without rows there is no result.
    """
    cells = metric_cells(rows, chunk_rows)
    if cells is None:
        return queries.sparkSession.createDataFrame([], "id bigint, other bigint, distance double")
    queries = queries.select(F.col("id").cast("bigint").alias("id"), F.col("vec").cast("array<double>").alias("vec"))
    # The part of the home cell that a query meets can be empty by chance; its bound is then open.
    first = _best_in_cells(written(_visits(queries, cells), "home-cells"), cells, whole=False)
    bound = F.coalesce("distance", F.lit(math.inf)).alias("bound")
    bounded = queries.join(first.select("id", "distance"), "id", "left").select("id", "vec", bound)
    return _best_in_cells(written(_visits(bounded, cells), "open-cells"), cells, whole=True)


def _shared(rows: DataFrame, own: DataFrame, other: DataFrame, keys: list[str], names: tuple[str, str], salt: int) -> DataFrame:
    """Rows of a cell dealt by hash into shares of its own size, each copied to every share of the other side."""
    joined = rows.join(own.withColumnRenamed("parts", "mine"), keys).join(other.withColumnRenamed("parts", "theirs"), keys)
    share = F.pmod(F.xxhash64("id", F.lit(salt)), F.col("mine")).alias(names[0])
    return joined.select(*rows.columns, share, F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("theirs") - 1)).alias(names[1]))


def _best_of(near: np.ndarray, u: np.ndarray, v: np.ndarray, ids: np.ndarray, others: np.ndarray, odd: np.ndarray, square: np.ndarray) -> pd.DataFrame:
    """Nearest other row of each row among the pairs ``near``, ties to the smaller id; an unknown distance comes before all."""
    unknown = near & odd
    lost = unknown.any(1)
    # Candidates by the matrix product, with room for its rounding; their distances again from differences.
    low = np.where(near, square, np.inf)
    room = 1e-9 + 1e-12 * ((u * u).sum(1) + (v * v).sum(1).max(initial=0.0))
    row, col = np.nonzero(near & ~lost[:, None] & ~(low > (low.min(1, initial=np.inf) + room)[:, None]))
    gap = u[row] - v[col]
    distance = np.sqrt(np.round((gap * gap).sum(1), 12))
    order = np.lexsort((others[col], distance, row))
    first = order[np.unique(row[order], return_index=True)[1]]
    where = np.flatnonzero(lost)
    blank = [others[unknown[i]].min() for i in where]
    return pd.DataFrame({
        "id": np.concatenate([ids[where], ids[row[first]]]), "other": np.concatenate([np.array(blank, np.int64), others[col[first]]]),
        "distance": np.concatenate([np.full(len(where), np.nan), distance[first]]), "unknown": np.arange(len(where) + len(first)) < len(where),
    })


def _nearest_in_radius(a: DataFrame, b: DataFrame, radius: float, chunk_rows: int) -> DataFrame:
    """Best partners within ``radius``, both ways: rows meet in grid cells of that size and their neighbours.

    The rows of a cell are dealt into shares of about ``chunk_rows`` on either side; a pair of shares is one matrix product and gives
    one row per point, so points that lie close together, or on one place, are never paired in rows.
    """
    keys = [f"k{x}" for x in AXES]
    cell = {k: F.floor(F.col(x) / F.lit(float(radius))).cast("bigint") for k, x in zip(keys, AXES)}
    whole = (F.col("vec").isNotNull() & F.forall("vec", lambda x: x.isNotNull())).alias("whole")
    columns = ["id", *[F.col(x).cast("double").alias(x) for x in AXES], F.col("vec").cast("array<double>").alias("vec"), whole]
    # Written, as both may come from one table and are each read twice.
    left, right = (written(side.select(*columns, *[c.alias(k) for k, c in cell.items()]), "radius-rows") for side in (a, b))
    for k in keys:
        left = left.withColumn(k, F.explode(F.sequence(F.col(k) - 1, F.col(k) + 1)))
    sizes = [side.groupBy(*keys).agg(F.ceil(F.count(F.lit(1)) / chunk_rows).alias("parts")) for side in (left, right)]

    def best(key: tuple, left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        empty = pd.DataFrame({"of_a": [], "id": [], "other": [], "distance": [], "unknown": []})
        if left.empty or right.empty:
            return empty
        p, q = left[list(AXES)].to_numpy(), right[list(AXES)].to_numpy()
        near = sum((p[:, None, i] - q[None, :, i]) ** 2 for i in range(3)) <= radius * radius
        lengths = [np.array([len(v) if w else -1 for v, w in zip(s["vec"], s["whole"])]) for s in (left, right)]
        odd = (lengths[0][:, None] != lengths[1][None, :]) | (lengths[0][:, None] < 0)
        width = max(int(max(n.max() for n in lengths)), 0)
        u, v = (
            np.array([np.pad(x, (0, width - n)) if n >= 0 else np.zeros(width) for x, n in zip(s["vec"], m)], np.float64).reshape(len(s), width)
            for s, m in zip((left, right), lengths)
        )
        ids = [s["id"].to_numpy() for s in (left, right)]
        with np.errstate(all="ignore"):
            square = (u * u).sum(1)[:, None] + (v * v).sum(1)[None, :] - 2.0 * (u @ v.T)
            square = np.where(np.isfinite(square), square, 0.0)  # decided by the differences
            found = [
                _best_of(near, u, v, *ids, odd, square).assign(of_a=True),
                _best_of(near.T, v, u, *ids[::-1], odd.T, square.T).assign(of_a=False),
            ]
        found = pd.concat([f for f in found if len(f)] or [empty])
        return found[["of_a", "id", "other", "distance", "unknown"]]

    group = [*keys, "share", "part"]
    dealt = [
        _shared(left, sizes[0], sizes[1], keys, ("share", "part"), 1),
        _shared(right, sizes[1], sizes[0], keys, ("part", "share"), 2),
    ]
    sides = [spread(side, *group).groupBy(*group) for side in dealt]
    found = sides[0].cogroup(sides[1]).applyInPandas(best, "of_a boolean, id bigint, other bigint, distance double, unknown boolean")
    return found.select(F.when(F.col("of_a"), "a").otherwise("b").alias("side"), "id", "other", F.when(~F.col("unknown"), F.coalesce("distance", F.lit(math.nan))).alias("distance"))


def match_features(a: DataFrame, b: DataFrame, radius: float | None = None, chunk_rows: int = CHUNK_ROWS) -> DataFrame:
    """Mutual nearest neighbours of descriptors ``id, vec`` (and z, y, x with ``radius``).

    ``id_a, id_b, distance``; the smallest id wins ties. Exact either way: ``radius`` limits
    partners by geometry, otherwise pivots leave out the cells that cannot hold the nearest row.
    """
    if radius:
        found = _nearest_in_radius(a, b, radius, chunk_rows)
    else:
        sides = {"a": (a, b), "b": (b, a)}
        near = [nearest_rows(*pair, chunk_rows).select(F.lit(side).alias("side"), "*") for side, pair in sides.items()]
        found = near[0].unionByName(near[1])
    best = found.groupBy("side", "id").agg(F.min(F.struct("distance", "other")).alias("m")).select("side", "id", "m.*")
    left = best.filter("side = 'a'").select(F.col("id").alias("id_a"), F.col("other").alias("id_b"), "distance")
    right = best.filter("side = 'b'").select(F.col("id").alias("id_b"), F.col("other").alias("id_a"))
    return left.join(right, ["id_a", "id_b"]).select("id_a", "id_b", "distance")


# ---------------------------------------------------------------- affine fits
# Matches: pz, py, px (fixed point) and qz, qy, qx (moving point).

P, Q = ("pz", "py", "px"), ("qz", "qy", "qx")


def normal_sums(matches: DataFrame) -> DataFrame:
    """The 10 + 12 sums of the least-squares normal equations, one row."""
    terms = [*P, None]
    aggs = []
    for i, a in enumerate(terms):
        ca = F.col(a) if a else F.lit(1.0)
        for j, b in enumerate(terms[i:], start=i):
            cb = F.col(b) if b else F.lit(1.0)
            aggs.append(F.sum(ca * cb).alias(f"a{i}{j}"))
        aggs += [F.sum(ca * F.col(q)).alias(f"b{i}{k}") for k, q in enumerate(Q)]
    return matches.agg(*aggs)


def solve_affine(sums) -> np.ndarray:
    """4x4 matrix from the one row of :func:`normal_sums`."""
    left = np.array([[sums[f"a{min(i, j)}{max(i, j)}"] for j in range(4)] for i in range(4)], dtype=float)
    right = np.array([[sums[f"b{i}{k}"] for k in range(3)] for i in range(4)], dtype=float)
    matrix = np.eye(4)
    matrix[:3] = np.linalg.lstsq(left, right, rcond=None)[0].T
    return matrix


def fit_affine_lsq(matches: DataFrame) -> np.ndarray:
    return solve_affine(normal_sums(matches).first())


def residual(matrix) -> Column:
    """Distance between the moving point and the mapped fixed point."""
    p = [F.col(c) for c in P]
    squares = []
    for i, q in enumerate(Q):
        mapped = sum((p[j] * F.lit(float(matrix[i][j])) for j in range(3)), F.lit(float(matrix[i][3])))
        squares.append(F.pow(F.col(q) - mapped, 2))
    return F.sqrt(sum(squares, F.lit(0.0)))


def ransac_affine(matches: DataFrame, n_iter: int = 500, tolerance: float = 2.0, seed: int = 0) -> tuple[np.ndarray, int]:
    """Affine with the most inliers among ``n_iter`` four-point hypotheses, refined on them.

    Hypotheses come from ``4 * n_iter`` matches drawn by hash, as many as they can use; their inliers
    are counted over all matches in one distributed pass. Returns the matrix and its inlier count.
    """
    draw = matches.orderBy(F.xxhash64(F.lit(seed), *P, *Q)).limit(4 * n_iter).select(*P, *Q)
    points = np.array(draw.collect(), dtype=float)
    if len(points) < 4:
        raise ValueError("at least four matches are needed")
    rng = np.random.default_rng(seed)
    models = []
    for _ in range(n_iter):
        chosen = points[rng.choice(len(points), 4, replace=False)]
        corner = np.hstack([chosen[:, :3], np.ones((4, 1))])
        if abs(np.linalg.det(corner)) > 1e-6:
            models.append(np.linalg.solve(corner, chosen[:, 3:]).T)
    if not models:
        raise ValueError("no non-degenerate sample of four matches")
    stack = np.array(models)

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            p = np.hstack([batch[list(P)].to_numpy(), np.ones((len(batch), 1))])
            gap = np.einsum("hij,nj->hni", stack, p) - batch[list(Q)].to_numpy()[None]
            hits = (np.sqrt((gap * gap).sum(2)) <= tolerance).sum(1)
            yield pd.DataFrame({"h": np.arange(len(stack)), "inliers": hits})

    totals = matches.select(*P, *Q).mapInPandas(count, "h int, inliers bigint").groupBy("h").agg(F.sum("inliers").alias("inliers"))
    best = totals.agg(F.max(F.struct("inliers", -F.col("h").alias("h"))).alias("b")).first()["b"]
    matrix = stack[-best[1]]
    inliers = matches.filter(residual(matrix) <= tolerance)
    return fit_affine_lsq(inliers), int(best[0])
