"""Whitening of vectors by a bidiagonal singular value solver.

Entries become integers, so sums and centring are exact. The centred rows are reduced to one triangle ``R`` by QR
decompositions of blocks, merged in groups of ``FAN`` until one is left. ``R`` (as wide as a vector, whatever the rows)
is made bidiagonal by Householder reflections; the differential quotient-difference algorithm with shifts finds its singular
values with high relative accuracy; twisted factorisations give the vectors, turned back to the directions of the data.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from voxelweave.llm.common import written

SCALE, SHIFT = 64, 1_000_000
COMPONENTS = 32
FAN = 32
BLOCK_ROWS = 4096
LIMIT = 1 << 62  # entries whose integer lies beyond count as this; such vectors cannot be told apart there
EPS = np.finfo(float).eps


# ---- singular values and vectors of a small triangle -------------------------------------------------------------


def bidiagonal(r: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Diagonal and superdiagonal of ``U' r V`` by Householder reflections, and ``V``."""
    a = np.array(r, float)
    n = a.shape[1]
    v = np.eye(n)

    def reflector(x: np.ndarray) -> tuple[np.ndarray, float]:
        norm = np.linalg.norm(x)
        w = x.copy()
        w[0] += math.copysign(norm, x[0])
        length = np.linalg.norm(w)
        return (w / length, -math.copysign(norm, x[0])) if length else (w, 0.0)

    for i in range(n):
        w, _ = reflector(a[i:, i])
        a[i:, i:] -= 2 * np.outer(w, w @ a[i:, i:])
        if i + 2 < n:
            w, _ = reflector(a[i, i + 1 :])
            a[:, i + 1 :] -= 2 * np.outer(a[:, i + 1 :] @ w, w)
            v[:, i + 1 :] -= 2 * np.outer(v[:, i + 1 :] @ w, w)
    return np.diag(a).copy(), np.diag(a, 1).copy(), v


def _sweep(q: list[float], e: list[float], shift: float) -> tuple[list[float], list[float], bool]:
    """One differential step with a shift; false if the shift was too large."""
    n, d = len(q), q[0] - shift
    new_q, new_e = [0.0] * n, [0.0] * (n - 1)
    for k in range(n - 1):
        if d < 0:
            return q, e, False
        total = d + e[k]
        new_q[k] = total
        if total == 0:
            d = q[k + 1] - shift
        else:
            ratio = q[k + 1] / total
            new_e[k] = e[k] * ratio
            d = d * ratio - shift
    new_q[-1] = d
    return new_q, new_e, d >= 0


def _lower_bound(q: list[float], e: list[float]) -> float:
    """A value below the least eigenvalue: one over the trace of the inverse."""
    total = column = 0.0
    for k, value in enumerate(q):
        if value <= 0:
            return 0.0
        column = (1 + e[k - 1] * column) / value if k else 1 / value
        total += column
        if not math.isfinite(total):
            return 0.0
    return (1 - 4 * EPS * len(q)) / total


def squared_singular_values(diagonal: np.ndarray, above: np.ndarray) -> np.ndarray:
    """Squares of the singular values of an upper bidiagonal matrix, rising, by shifted differential steps."""
    scale = max(np.abs(diagonal).max(initial=0.0), np.abs(above).max(initial=0.0))
    if scale == 0:
        return np.zeros(len(diagonal))
    found: list[float] = []
    todo = [(((diagonal / scale) ** 2).tolist(), ((above / scale) ** 2).tolist(), 0.0)]
    while todo:
        q, e, moved = todo.pop()
        steps = 0
        while len(q) > 1:
            cut = next((k for k in range(len(e) - 1, -1, -1) if e[k] <= EPS * EPS * (moved + min(q[k], q[k + 1])) or e[k] < 1e-300), None)
            if cut is not None:
                if cut < len(e) - 1:
                    todo.append((q[: cut + 1], e[:cut], moved))
                    q, e = q[cut + 1 :], e[cut + 1 :]
                    continue
                found.append(q[-1] + moved)
                q, e, steps = q[:-1], e[:-1], 0
                continue
            if q[0] < q[-1] / 2:  # small values belong at the end
                q, e = _turned(q, e)
            shift = _lower_bound(q, e)
            if shift <= 0.01 * EPS * moved:
                shift = 0.0
            new_q, new_e, fine = _sweep(q, e, shift)
            if not fine:
                shift = 0.0
                new_q, new_e, _ = _sweep(q, e, 0.0)
            q, e, moved, steps = new_q, new_e, moved + shift, steps + 1
            if steps > 200 * (len(q) + 10):
                raise ArithmeticError("singular values did not converge")
        found.append(q[0] + moved)
    return np.sort(np.array(found)) * scale * scale


def _turned(q: list[float], e: list[float]) -> tuple[list[float], list[float]]:
    """Quotients of the matrix read from its other end: the lower bidiagonal factor of the reversed one, made upper."""
    rev_q, rev_e = q[::-1], e[::-1]
    # The reversed matrix is lower bidiagonal; B B' of it is tridiagonal with these entries, factored anew from the top.
    out_q, out_e, d = [], [], rev_q[0]
    for k in range(len(rev_e)):
        total = d + rev_e[k]
        out_q.append(total)
        ratio = rev_q[k + 1] / total if total else 0.0
        out_e.append(rev_e[k] * ratio)
        d = d * ratio if total else rev_q[k + 1]
    out_q.append(d)
    return out_q, out_e


def _twisted(a: np.ndarray, b: np.ndarray, value: float) -> tuple[np.ndarray, ...]:
    """Factors of ``B'B - value`` for the bidiagonal ``B`` (diagonal ``a``, superdiagonal ``b``) from the top and from the bottom.

    Multipliers and pivots of both, and what is left at each twist. They come from the entries of ``B`` by
    differential steps, never from ``B'B`` itself, which would lose the small values of a graded matrix.
    """
    n = len(a)
    tiny = 1e-290
    above, below, p_top, p_bottom = np.zeros(n - 1), np.zeros(n - 1), np.empty(n), np.empty(n)
    s, p = np.empty(n), np.empty(n)
    s[0], p[-1] = -value, a[-1] * a[-1] - value
    for k in range(n):
        p_top[k] = a[k] * a[k] + s[k]
        if abs(p_top[k]) < tiny:
            p_top[k] = -tiny
        if k < n - 1:
            above[k] = a[k] * b[k] / p_top[k]
            s[k + 1] = b[k] * b[k] * (s[k] / p_top[k]) - value
    for k in range(n - 1, -1, -1):
        p_bottom[k] = p[k] if k == 0 else b[k - 1] * b[k - 1] + p[k]
        if abs(p_bottom[k]) < tiny:
            p_bottom[k] = -tiny
        if k:
            below[k - 1] = a[k - 1] * b[k - 1] / p_bottom[k]
            p[k - 1] = a[k - 1] * a[k - 1] * (p[k] / p_bottom[k]) - value
    return above, below, p_top, p_bottom, s + p + value


def _vector(a: np.ndarray, b: np.ndarray, value: float) -> np.ndarray:
    """Right singular vector by the factorisation with the twist where least is left."""
    n = len(a)
    above, below, _, _, left = _twisted(a, b, value)
    twist = int(np.abs(left).argmin())
    z = np.zeros(n)
    z[twist] = 1
    for k in range(twist - 1, -1, -1):
        z[k] = -above[k] * z[k + 1]
    for k in range(twist + 1, n):
        z[k] = -below[k - 1] * z[k - 1]
    return z / np.linalg.norm(z)


def _refined(a: np.ndarray, b: np.ndarray, value: float, others: np.ndarray, seed: int) -> np.ndarray:
    """A further vector of a cluster of values: inverse iteration through the twist, orthogonal to the ones found."""
    n = len(a)
    above, below, p_top, p_bottom, left = _twisted(a, b, value)
    twist = int(np.abs(left).argmin())
    scale = left[twist] if left[twist] else EPS * (abs(value) + 1e-290)
    z = np.random.default_rng(seed).standard_normal(n)
    for _ in range(6):
        z -= others.T @ (others @ z)
        z -= others.T @ (others @ z)
        z /= np.linalg.norm(z)
        y = z.copy()
        for k in range(twist):
            y[k + 1] -= above[k] * y[k]
        for k in range(n - 1, twist, -1):
            y[k - 1] -= below[k - 1] * y[k]
        y[:twist] /= p_top[:twist]
        y[twist + 1 :] /= p_bottom[twist + 1 :]
        y[twist] /= scale
        for k in range(twist - 1, -1, -1):
            y[k] -= above[k] * y[k + 1]
        for k in range(twist + 1, n):
            y[k] -= below[k - 1] * y[k - 1]
        z = y / np.abs(y).max()
    z -= others.T @ (others @ z)
    z -= others.T @ (others @ z)
    return z / np.linalg.norm(z)


def right_vectors(r: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Squared singular values of a square matrix, falling, and its right singular vectors as rows.

    Vectors of values that are close are made orthogonal to each other; equal values give some basis of their space.
    """
    n = r.shape[1]
    diagonal, above, v = bidiagonal(r)
    largest = max(np.abs(diagonal).max(initial=0.0), np.abs(above).max(initial=0.0))
    above[np.abs(above) <= EPS * largest / 16] = 0.0
    values, vectors = [], []
    cuts = [0, *(np.flatnonzero(above == 0) + 1).tolist(), n]
    for lo, hi in zip(cuts, cuts[1:]):  # parts without a link have vectors of their own
        a, b = diagonal[lo:hi], above[lo : hi - 1]
        squares = squared_singular_values(a, b)[::-1]
        scale = math.sqrt(squares[0]) if squares[0] else 1.0
        a, b = a / scale, b / scale
        own: list[np.ndarray] = []
        cluster = 0
        for i, value in enumerate(squares):
            if i and squares[i - 1] - value > 1e-3 * squares[i - 1]:
                cluster = i
            if hi - lo == 1:
                z = np.ones(1)
            else:
                z = _vector(a, b, value / scale**2)
            near = np.array(own[cluster:i]).reshape(-1, hi - lo)
            if len(near):
                rest = z - near.T @ (near @ z)
                if np.linalg.norm(rest) < 0.5:
                    z = _refined(a, b, value / scale**2, near, i)
                else:
                    rest -= near.T @ (near @ rest)
                    z = rest / np.linalg.norm(rest)
            own.append(z)
            whole = np.zeros(n)
            whole[lo:hi] = z
            values.append(value)
            vectors.append(whole)
    order = np.argsort(-np.array(values), kind="stable")
    return np.array(values)[order], np.array(vectors)[order] @ v.T


# ---- the rows ----------------------------------------------------------------------------------------------------


def _matrix(column: pa.Array) -> np.ndarray:
    return np.asarray(column.flatten()).reshape(len(column), -1) if len(column) else np.empty((0, 0))


def integer_vectors(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """``(vec_id, x array<long>)`` with ``x = floor(64 c) + 1000000`` of the rows that take part (see :func:`whiten`)."""
    wide = F.col(vector_col).cast("array<double>")
    rows = vectors.select(F.col(id_col).cast("long").alias("vec_id"), wide.alias("v")).where("v is not null and size(v) > 0")
    bad = F.exists("v", lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == float("inf")))
    low, high = F.lit(float(-LIMIT)), F.lit(float(LIMIT))
    whole = F.transform("v", lambda c: F.floor(F.least(high, F.greatest(low, c * SCALE))) + SHIFT)
    return rows.where(~bad).select("vec_id", whole.alias("x"))


def _sum_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        if batch.num_rows:
            x = _matrix(batch.column(1))
            # High and low halves are added apart, so that no sum of a batch overflows.
            high, low = (x >> 32).sum(0), (x & 0xFFFFFFFF).sum(0)
            at = pa.array(np.arange(x.shape[1], dtype=np.int32))
            yield pa.RecordBatch.from_arrays([at, pa.array(high), pa.array(low)], names=["at", "high", "low"])


class Centre:
    """Exact sums of the fit list, and what follows from them for a block of rows."""

    def __init__(self, n: int, sums: list[int]):
        self.n, self.sums = n, sums
        # x - S/n = (x - m) - r/n with whole m and 0 <= r < n.
        self.whole = [s // n for s in sums]
        self.part = [s - n * w for s, w in zip(sums, self.whole)]
        self._whole = np.array(self.whole, np.int64)
        self._part = np.array([r / n for r in self.part])

    def rows(self, x: np.ndarray) -> np.ndarray:
        """Centred rows in double precision; the difference of integers is taken before any rounding."""
        return (x - self._whole).astype(float) - self._part

    def deviations(self, x: np.ndarray) -> list[int | None]:
        """Exact sums of ``(n x - S)^2``; null where a long does not hold it."""
        gap = x - self._whole
        most = int(np.abs(gap).max(initial=0)) + 1
        if (self.n * most) ** 2 * x.shape[1] < 1 << 63:
            scaled = gap * self.n - np.array(self.part, np.int64)
            return (scaled * scaled).sum(1).tolist()
        sums = [sum((g * self.n - r) ** 2 for g, r in zip(row, self.part)) for row in gap.tolist()]
        return [s if s < 1 << 63 else None for s in sums]


def _triangle(a: np.ndarray) -> np.ndarray:
    """R of a QR decomposition, as wide as high."""
    r = np.linalg.qr(a, "r")
    return np.vstack([r, np.zeros((a.shape[1] - len(r), a.shape[1]))]) if len(r) < a.shape[1] else r


def _qr_task(centre: Centre):
    """One triangle of all rows of a task."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        r = None
        for batch in batches:
            for lo in range(0, batch.num_rows, BLOCK_ROWS):
                rows = centre.rows(_matrix(batch.column(1).slice(lo, BLOCK_ROWS)))
                r = _triangle(rows if r is None else np.vstack([r, rows]))
        if r is not None:
            yield pa.RecordBatch.from_arrays([pa.array([r.tobytes()], pa.binary())], names=["r"])

    return task


def _merge_group(table: pa.Table) -> pa.Table:
    r = None
    for value in table["r"]:
        flat = np.frombuffer(value.as_buffer(), float)
        own = flat.reshape(-1, math.isqrt(len(flat)))
        r = own if r is None else _triangle(np.vstack([r, own]))
    return pa.table({"r": pa.array([r.tobytes()], pa.binary())})


def _reduced(blocks: DataFrame, merge, name: str) -> bytes | None:
    """Merge stored pieces in groups of ``FAN`` until one is left; pieces are numbered by their content, so retries agree."""
    blocks = written(blocks, name)
    left = blocks.count()
    while left > 1:
        groups = -(-left // FAN)
        part = F.pmod(F.xxhash64(*blocks.columns), F.lit(groups)).alias("part")
        merged = blocks.select("*", part).groupBy("part").applyInArrow(merge, blocks.schema)
        blocks = written(merged, name)
        left = blocks.count()
    row = blocks.first()
    return row[0] if row else None


def _moments_task(centre: Centre, directions: np.ndarray):
    """Number, sums and centred products of the whitened rows of a task, merged batch by batch."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None
        for batch in batches:
            if batch.num_rows:
                w = centre.rows(_matrix(batch.column(1))) @ directions.T
                mean = w.mean(0)
                held = _moments_sum(held, (len(w), mean, (w - mean).T @ (w - mean)))
        if held:
            yield pa.RecordBatch.from_arrays([pa.array([_packed(held)], pa.binary())], names=["moments"])

    return task


def _moments_sum(a, b):
    if a is None:
        return b
    n = a[0] + b[0]
    step = b[1] - a[1]
    return n, a[1] + step * (b[0] / n), a[2] + b[2] + np.outer(step, step) * (a[0] * b[0] / n)


def _packed(m) -> bytes:
    return np.concatenate([[m[0]], m[1], m[2].ravel()]).astype(float).tobytes()


def _unpacked(data: bytes):
    flat = np.frombuffer(data, float)
    k = (math.isqrt(4 * len(flat) - 3) - 1) // 2
    return flat[0], flat[1 : k + 1], flat[k + 1 :].reshape(k, k)


def _moments_group(table: pa.Table) -> pa.Table:
    held = None
    for value in table["moments"].to_pylist():
        held = _moments_sum(held, _unpacked(value))
    return pa.table({"moments": pa.array([_packed(held)], pa.binary())})


def _out_task(centre: Centre, directions: np.ndarray, explained: np.ndarray, error: float):
    k = len(directions)

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo in range(0, batch.num_rows, BLOCK_ROWS):
                part = batch.slice(lo, BLOCK_ROWS)
                x = _matrix(part.column(1))
                rows = part.num_rows
                w = centre.rows(x) @ directions.T
                at = pa.array(np.repeat(np.arange(rows), k))
                arrays = [
                    part.column(0).take(at),
                    pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), rows)),
                    pa.array(np.full(rows * k, centre.n, np.int64)),
                    pa.array(centre.deviations(x), pa.int64()).take(at),
                    pa.array(w.ravel()),
                    pa.array(np.tile(explained, rows)),
                    pa.array(np.full(rows * k, error)),
                ]
                yield pa.RecordBatch.from_arrays(arrays, names=[c.split()[0] for c in SCHEMA.split(", ")])

    return task


SCHEMA = "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double"


def whiten(vectors: DataFrame, components: int = COMPONENTS, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """One row per vector and component: ``vec_id, component, n, deviation, whitened, explained, identity_error``.

    Vectors that are null or empty or hold null or non-finite entries take no part. An entry ``c`` counts as
    ``x = floor(64 c) + 1000000``. All other vectors are the fit list, repeated rows and rows without an id included: ``n``
    vectors with sums ``S``. Components are unit eigenvectors of the covariance (divisor ``n``), by falling eigenvalue ``e``, at
    most ``components``; directions without spread (eigenvalue zero but for rounding) have no whitening and are left out, so equal vectors
    alone give no rows. ``deviation`` is the exact sum of ``(n x - S)^2`` (null beyond a long); ``whitened`` the projection of
    ``x - S/n`` over ``sqrt(e)``; ``explained`` is ``e`` over all spread; ``identity_error`` the largest absolute entry of the whitened
    rows' covariance less the identity. Vectors must be of one length (else an error that names the lengths). An empty
    table gives an empty result; other columns are ignored.
    """
    rows = written(integer_vectors(vectors, id_col, vector_col), "integer-vectors")
    sizes = [(r["size"], r["n"]) for r in rows.groupBy(F.size("x").alias("size")).agg(F.count(F.lit(1)).alias("n")).take(3)]
    if not sizes:
        return rows.sparkSession.createDataFrame([], SCHEMA)
    if len(sizes) > 1:
        raise ValueError(f"vectors of different lengths: {sorted(s for s, _ in sizes)}")
    halves = rows.mapInArrow(_sum_task, "at int, high long, low long").groupBy("at")
    wide = "decimal(38,0)"
    totals = halves.agg(F.sum(F.col("high").cast(wide)).alias("high"), F.sum(F.col("low").cast(wide)).alias("low")).collect()
    sums = [(int(r["high"]) << 32) + int(r["low"]) for r in sorted(totals, key=lambda r: r["at"])]
    centre = Centre(sizes[0][1], sums)
    data = _reduced(rows.mapInArrow(_qr_task(centre), "r binary"), _merge_group, "triangles")
    width = len(sums)
    squares, directions = right_vectors(np.frombuffer(data, float).reshape(width, width))
    spread = int((squares > squares[0] * (EPS * max(centre.n, width)) ** 2 * 16).sum()) if squares[0] > 0 else 0
    kept = min(components, spread)
    if not kept:
        return rows.sparkSession.createDataFrame([], SCHEMA)
    scaled = directions[:kept] / np.sqrt(squares[:kept, None] / centre.n)
    moments = _reduced(rows.mapInArrow(_moments_task(centre, scaled), "moments binary"), _moments_group, "moments")
    n, _, products = _unpacked(moments)
    error = float(np.abs(products / n - np.eye(kept)).max())
    return rows.mapInArrow(_out_task(centre, scaled, squares[:kept] / squares.sum(), error), SCHEMA)
