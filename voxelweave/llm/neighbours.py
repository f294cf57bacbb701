"""Approximate nearest neighbours by learned partitions.

A bounded sample (``SAMPLE`` rows, by hash of the id) gives a neighbour graph; the graph is cut into balanced parts, few edges
crossing; a small network learns to tell from a vector in which parts its neighbours lie. The network then places every
row of the table in its most probable part and sends every query to its several most probable parts, where true distances
in double precision rank the candidates. The number of parts probed is fitted on held-out rows of the sample for
``TARGET`` recall.

Parts are dealt to tasks in blocks of bounded size by hash of the id, so a part that many equal vectors crowd is spread like
any other; queries of one part are dealt in blocks as well. Each block gives out its best ``k`` per query.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from voxelweave.llm.common import written

SAMPLE = 8_192
PART_ROWS = 2_000
MAX_PARTS = 128
HUGE = 1e150
GRAPH_DEGREE = 10
TARGET = 0.95
QUERY_BLOCK = 4_096
MIN_BLOCK, MAX_BLOCK = 256, 50_000


@dataclass
class Router:
    """Two-layer network over centred, scaled vectors; ``probes`` parts are searched."""

    centre: np.ndarray
    scale: float
    w1: np.ndarray
    b1: np.ndarray
    w2: np.ndarray
    b2: np.ndarray
    probes: int

    def scores(self, x: np.ndarray) -> np.ndarray:
        hidden = np.maximum(((x - self.centre) / self.scale) @ self.w1 + self.b1, 0)
        return hidden @ self.w2 + self.b2

    def order(self, x: np.ndarray) -> np.ndarray:
        return np.argsort(-self.scores(x), axis=1, kind="stable")


def _nearest(x: np.ndarray, y: np.ndarray, k: int, skip_self: bool) -> np.ndarray:
    """Indices of the ``k`` nearest rows of ``y`` for each row of ``x``, in blocks."""
    out, norms = [], (y * y).sum(1)
    for s in range(0, len(x), 512):
        d = norms - 2 * x[s : s + 512] @ y.T
        if skip_self:
            d[np.arange(len(d)), np.arange(s, s + len(d))] = np.inf
        out.append(np.argpartition(d, min(k, d.shape[1] - 1), axis=1)[:, :k])
    return np.concatenate(out)


def partition_graph(neighbours: np.ndarray, parts: int, rng: np.random.Generator, passes: int = 12) -> np.ndarray:
    """Balanced parts of the neighbour graph: grown from seeds, then improved by moves along edges under a size limit."""
    n = len(neighbours)
    limit = int(np.ceil(n / parts * 1.05))
    back: list[list[int]] = [[] for _ in range(n)]
    for i, row in enumerate(neighbours.tolist()):
        for j in row:
            back[j].append(i)
    around = [row + back[i] for i, row in enumerate(neighbours.tolist())]
    part = np.full(n, -1)
    sizes = [0] * parts
    fronts: list[list[int]] = [[s] for s in rng.choice(n, parts, replace=False).tolist()]
    spare = rng.permutation(n).tolist()
    left = n
    while left:
        p = min((q for q in range(parts)), key=lambda q: sizes[q])  # the smallest part grows
        at = None
        while fronts[p]:
            candidate = fronts[p].pop(0)
            if part[candidate] < 0:
                at = candidate
                break
        while at is None:  # nothing next to it is free: go on elsewhere
            candidate = spare.pop()
            if part[candidate] < 0:
                at = candidate
        part[at] = p
        sizes[p] += 1
        left -= 1
        fronts[p] += [j for j in around[at] if part[j] < 0]
    for _ in range(passes):
        moved = 0
        for i in rng.permutation(n).tolist():
            votes = np.bincount(part[around[i]], minlength=parts)
            best, own = int(votes.argmax()), int(part[i])
            if votes[best] > votes[own] and sizes[best] < limit:
                part[i] = best
                sizes[best] += 1
                sizes[own] -= 1
                moved += 1
        if not moved:
            break
    return part


def train_router(sample: np.ndarray, parts: int, k: int, seed: int = 0, hidden: int = 128, epochs: int = 40) -> Router:
    """Fit the router on the sample: the graph's parts, the network, and the number of probes."""
    rng = np.random.default_rng(seed)
    x = sample.astype(np.float32)
    centre = x.mean(0)
    scale = float(np.sqrt(((x - centre) ** 2).mean())) or 1.0
    dim = x.shape[1]
    if parts == 1:
        zero = np.zeros((dim, 1), np.float32)
        return Router(centre, scale, zero, np.zeros(1, np.float32), np.zeros((1, 1), np.float32), np.zeros(1, np.float32), 1)
    z = (x - centre) / scale
    near = _nearest(z, z, GRAPH_DEGREE, True)
    part = partition_graph(near, parts, rng)
    # Soft target: where a vector itself and its neighbours lie.
    target = np.zeros((len(z), parts), np.float32)
    np.add.at(target, (np.repeat(np.arange(len(z)), near.shape[1]), part[near].ravel()), 1.0)
    target[np.arange(len(z)), part] += 2.0
    target /= target.sum(1, keepdims=True)
    held = rng.permutation(len(z)) < min(500, len(z) // 8)
    learn = np.flatnonzero(~held)
    w = [
        rng.normal(0, np.sqrt(2 / dim), (dim, hidden)).astype(np.float32),
        np.zeros(hidden, np.float32),
        rng.normal(0, np.sqrt(1 / hidden), (hidden, parts)).astype(np.float32),
        np.zeros(parts, np.float32),
    ]
    first, second, step = [np.zeros_like(v) for v in w], [np.zeros_like(v) for v in w], 0
    for epoch in range(epochs):
        rate = 3e-3 * (1 - epoch / epochs)
        order = rng.permutation(learn)
        for s in range(0, len(order), 256):
            i = order[s : s + 256]
            h = np.maximum(z[i] @ w[0] + w[1], 0)
            o = h @ w[2] + w[3]
            o = np.exp(o - o.max(1, keepdims=True))
            d = (o / o.sum(1, keepdims=True) - target[i]) / len(i)
            dh = (d @ w[2].T) * (h > 0)
            step += 1
            for v, g, m1, m2 in zip(w, (z[i].T @ dh, dh.sum(0), h.T @ d, d.sum(0)), first, second):
                m1 += 0.1 * (g - m1)
                m2 += 0.001 * (g * g - m2)
                v -= rate * (m1 / (1 - 0.9**step)) / (np.sqrt(m2 / (1 - 0.999**step)) + 1e-8)
    router = Router(centre, scale, *w, parts)
    order = router.order(x)
    home, rank = order[:, 0], np.argsort(order, axis=1)
    tested = np.flatnonzero(held)
    truth = _nearest(z[tested], z, min(k + 1, len(z) - 1), False)
    needed = rank[tested[:, None], home[truth]]
    router.probes = next((p for p in range(1, parts + 1) if (needed < p).mean() >= TARGET), parts)
    return router


def valid_vectors(df: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """``(vec_id, vector)`` as doubles, without null ids and without vectors that are null, empty, zero, of another length
    than most, or that hold null or non-finite components."""
    rows = df.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vector_col).cast("array<double>").alias("vector"))
    finite = F.forall("vector", lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
    rows = rows.where(F.col("vec_id").isNotNull() & F.col("vector").isNotNull() & finite & F.exists("vector", lambda v: v != 0))
    sizes = rows.groupBy(F.size("vector").alias("d")).count().orderBy(F.desc("count"), F.desc("d")).first()
    return rows.where(F.size("vector") == (sizes["d"] if sizes else 0))


def _matrix(column: pa.ChunkedArray | pa.Array) -> np.ndarray:
    flat = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return np.asarray(flat.flatten()).reshape(len(flat), -1)


def _route(router: Router, sizes: list[int] | None, k: int):
    """Adds ``part``: the most probable one, or for queries (``sizes`` given) each of those to search."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not len(batch):
                continue
            order = router.order(_matrix(batch.column(1)).astype(np.float32))
            if sizes is None:
                rows, part = np.arange(len(order)), order[:, 0]
            else:
                # The fitted number of parts, more where these hold too few rows.
                held = np.cumsum(np.array(sizes)[order], axis=1)
                count = np.maximum(router.probes, (held <= k).sum(1) + 1).clip(max=order.shape[1])
                rows = np.repeat(np.arange(len(order)), count)
                part = np.concatenate([o[:c] for o, c in zip(order, count)])
            taken = batch.take(pa.array(rows))
            yield pa.RecordBatch.from_arrays(
                [taken.column(0), taken.column(1), pa.array(part.astype(np.int32))], names=["vec_id", "vector", "part"]
            )

    return task


def _distances(c: np.ndarray, q: np.ndarray) -> np.ndarray:
    """Euclidean distances; rows whose squares overflow are scaled first."""
    with np.errstate(over="ignore"):
        gap = c - q
        out = np.sqrt((gap**2).sum(1))
    at = np.flatnonzero(np.isinf(out))
    if len(at):
        most = np.abs(gap[at]).max(1)
        with np.errstate(invalid="ignore"):
            out[at] = most * np.sqrt(((gap[at] / most[:, None]) ** 2).sum(1))
        out[np.isnan(out)] = np.inf  # a difference beyond the largest double
    return out


def _rank_block(k: int):
    """Best ``k`` candidates of one block for each query of one query block."""

    def group(queries: pa.Table, candidates: pa.Table) -> pa.Table:
        found: list[tuple] = []
        if len(queries) and len(candidates):
            c, ids = _matrix(candidates["vector"]), candidates["vec_id"].to_numpy()
            with np.errstate(over="ignore"):
                norms = (c * c).sum(1)
            q_all, q_ids = _matrix(queries["vector"]), queries["vec_id"].to_numpy()
            safe = max(np.abs(c).max(), np.abs(q_all).max()) < HUGE  # else squares overflow: all are ranked exactly
            for q, q_id in zip(q_all, q_ids):
                keep = np.flatnonzero(ids != q_id)
                if safe:
                    rough = norms - 2 * (c @ q)
                    rough[ids == q_id] = np.inf
                    bound = np.partition(rough, k - 1)[k - 1] if len(rough) > k else np.inf
                    # Rounding of the shortcut is far below this margin; what it leaves is ranked exactly.
                    keep = np.flatnonzero((rough <= bound + 1e-9 * (norms.max() + q @ q)) & (ids != q_id))
                exact = _distances(c[keep], q)
                best = np.lexsort((ids[keep], exact))[:k]
                found += zip([int(q_id)] * len(best), ids[keep][best].tolist(), exact[best].tolist())
        columns = list(zip(*found)) if found else [()] * 3
        kinds = (pa.int64(), pa.int64(), pa.float64())
        return pa.table([pa.array(v, t) for v, t in zip(columns, kinds)], names=["query_id", "vec_id", "score"])

    return group


def search(
    vectors: DataFrame,
    is_query,
    k: int = 10,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    sample_rows: int = SAMPLE,
) -> DataFrame:
    """``query_id, rank, vec_id, score``: for each row where ``is_query`` (a condition on ``vec_id``) its ``k`` nearest found.

    ``score`` is the Euclidean distance of the original vectors in double precision; ties go to the smaller id; a row with the
    query's id is no candidate. Fewer candidates than ``k`` are all returned. Rows left out: see :func:`valid_vectors`. An
    id that repeats with different vectors counts as several candidates. An empty table gives an empty result.
    """
    rows = written(valid_vectors(vectors, id_col, vector_col), "vectors")
    total = rows.count()
    picked = rows.orderBy(F.xxhash64("vec_id")).limit(sample_rows).select("vector").toArrow()
    sample = _matrix(picked["vector"]) if len(picked) else np.zeros((1, 1))
    parts = max(1, min(MAX_PARTS, total // PART_ROWS, len(sample) // 16))
    router = train_router(sample, parts, k)
    schema = "vec_id long, vector array<double>, part int"
    placed = written(rows.mapInArrow(_route(router, None, k), schema), "placed-vectors")
    counts = {r["part"]: r["count"] for r in placed.groupBy("part").count().collect()}
    sizes = [counts.get(p, 0) for p in range(parts)]
    sent = written(rows.where(is_query).mapInArrow(_route(router, sizes, k), schema), "sent-queries")
    asked = {r["part"]: r["count"] for r in sent.groupBy("part").count().collect()}

    block_rows = max(MIN_BLOCK, min(MAX_BLOCK, total // 128))
    blocks = F.element_at(F.array(*(F.lit(max(1, -(-n // block_rows))) for n in sizes)), F.col("part") + 1)
    q_blocks = F.element_at(
        F.array(*(F.lit(max(1, -(-asked.get(p, 0) // QUERY_BLOCK))) for p in range(parts))), F.col("part") + 1
    )

    def dealt(df: DataFrame, own: str, own_blocks, other: str, other_blocks) -> DataFrame:
        mine = F.pmod(F.xxhash64("vec_id", F.lit(own)), own_blocks).cast("int").alias(own)
        every = F.explode(F.sequence(F.lit(0), other_blocks - 1)).alias(other)
        return df.select("vec_id", "vector", "part", mine, every)

    keys = ["part", "block", "q_block"]
    left = dealt(sent, "q_block", q_blocks, "block", blocks).groupBy(*keys)
    right = dealt(placed, "block", blocks, "q_block", q_blocks).groupBy(*keys)
    best = left.cogroup(right).applyInArrow(_rank_block(k), "query_id long, vec_id long, score double")
    nearest = Window.partitionBy("query_id").orderBy("score", "vec_id")
    ranked = best.withColumn("rank", F.row_number().over(nearest)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")
