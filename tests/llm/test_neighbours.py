"""Recall and exact scores against brute force."""

from __future__ import annotations

import numpy as np
from pyspark.sql import functions as F

from tests.llm.conftest import with_clashes
from voxelweave.llm import neighbours
from voxelweave.llm.queries import all_queries


def brute(rows, query, k):
    ids, x = np.array([r[0] for r in rows]), np.array([r[1] for r in rows], np.float64)
    d = np.sqrt(((x - x[ids == query][0]) ** 2).sum(1))
    keep = ids != query
    order = np.lexsort((ids[keep], d[keep]))[:k]
    return list(zip(ids[keep][order].tolist(), d[keep][order].tolist()))


def compare(rows, found, k):
    by, hits, total = {}, 0, 0
    for r in found:
        by.setdefault(r["query_id"], []).append(r)
    for query, got in by.items():
        got.sort(key=lambda r: r["rank"])
        assert [r["rank"] for r in got] == list(range(1, len(got) + 1))
        assert [(r["score"], r["vec_id"]) for r in got] == sorted((r["score"], r["vec_id"]) for r in got)
        want, exact = brute(rows, query, k), dict(brute(rows, query, len(rows)))
        assert len(got) == len(want)
        for r in got:
            assert np.isclose(r["score"], exact[r["vec_id"]], rtol=1e-12, atol=0)
        hits += len({r["vec_id"] for r in got} & {i for i, _ in want})
        total += len(want)
    return hits / total


def test_query(spark, sf_dir):
    rows = [(r["vec_id"], r["embedding"]) for r in spark.read.parquet(f"{sf_dir}/embeddings.parquet").collect()]
    found = all_queries()["op9_neighbours"](spark, sf_dir).collect()
    assert len({r["query_id"] for r in found}) == sum(i % 100 == 0 for i, _ in rows)
    assert compare(rows, found, 10) >= 0.9


def test_learned_parts_on_clusters(spark, monkeypatch):
    """Several parts, of which few are searched; a third of the rows are one vector."""
    monkeypatch.setattr(neighbours, "PART_ROWS", 250)
    rng = np.random.default_rng(7)
    centres = rng.normal(0, 4, (30, 16))
    x = centres[rng.integers(0, 30, 3000)] + rng.normal(0, 1, (3000, 16))
    x[rng.permutation(3000)[:1000]] = x[0]
    rows = [(i, v.tolist()) for i, v in enumerate(x)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    router = neighbours.train_router(x[:2000], 12, 10)
    assert router.probes < 12
    found = neighbours.search(df, F.col("vec_id") % 50 == 0, 10).collect()
    assert compare(rows, found, 10) >= 0.9


def test_balanced_parts():
    rng = np.random.default_rng(1)
    x = rng.normal(0, 1, (600, 8))
    near = neighbours._nearest(x, x, 10, True)
    part = neighbours.partition_graph(near, 6, rng)
    assert np.bincount(part, minlength=6).max() <= 600 / 6 * 1.05 + 1
    assert (part[near] == part[:, None]).mean() > 2 / 6


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 0.0]), (1, None), (2, []), (3, [0.0, 0.0]), (4, [nan, 1.0]), (5, [inf, 1.0]), (6, [1.0, None]), (7, [1.0, 0.0]), (8, [1.0, 0.0])]
    rows += [(9, [2.0, 0.0]), (None, [1.0, 1.0]), (10, [1.0, 2.0, 3.0]), (9, [2.0, 0.0])]
    df = with_clashes(spark.createDataFrame(rows, "vec_id long, embedding array<double>"))
    found = neighbours.search(df, F.col("vec_id") % 100 == 0, 10).orderBy("rank").collect()
    assert [(r["query_id"], r["vec_id"], r["score"]) for r in found] == [(0, 7, 0.0), (0, 8, 0.0), (0, 9, 1.0), (0, 9, 1.0)]
    assert neighbours.search(df.limit(0), F.col("vec_id") % 100 == 0).count() == 0


def test_huge_finite_vectors_lose_no_candidate():
    """Squares of such components overflow; every candidate is still ranked by its distance."""
    import pyarrow as pa

    vectors = {1: [1e200, 0.0], 2: [3e200, 0.0], 3: [1e200, 1e190], 4: [0.5, 0.25], 5: [-1e308, 1e308]}
    rows = pa.table({"vec_id": pa.array(list(vectors)), "vector": pa.array(list(vectors.values()), pa.list_(pa.float64()))})
    out = neighbours._rank_block(10)(rows.slice(0, 1), rows).to_pylist()
    assert [r["vec_id"] for r in sorted(out, key=lambda r: r["score"])] == [3, 4, 2, 5]
    assert {r["vec_id"]: r["score"] for r in out}[2] == 2e200
