"""Exact nearest rows by pivots and rings, against brute force; how many pairs are compared."""

from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from voxelweave.operators import matching as mt


def frame(spark, vectors, start=0):
    return spark.createDataFrame([(start + i, [float(c) for c in v]) for i, v in enumerate(vectors)], "id bigint, vec array<double>")


def brute(queries, rows):
    dist = np.sqrt(((queries[:, None, :] - rows[None, :, :]) ** 2).sum(2))
    return dist.argmin(1), dist.min(1)


def check(spark, queries, rows, chunk):
    found = {r["id"]: (r["other"], r["distance"]) for r in mt.nearest_rows(frame(spark, queries), frame(spark, rows), chunk).collect()}
    at, dist = brute(queries, rows)
    assert sorted(found) == list(range(len(queries)))
    assert [found[i][0] for i in range(len(queries))] == at.tolist()
    assert np.allclose([found[i][1] for i in range(len(queries))], dist, atol=1e-6)


@pytest.mark.parametrize("chunk", [1000, 40, 7])
def test_nearest_rows_equal_brute_force(spark, chunk):
    rng = np.random.default_rng(chunk)
    check(spark, rng.integers(0, 6, (60, 3)).astype(float), rng.integers(0, 6, (150, 3)).astype(float), chunk)  # many ties
    check(spark, rng.normal(size=(50, 8)) * 1000, rng.normal(size=(120, 8)) * 1000, chunk)


def test_copies_do_not_make_one_group(spark):
    """A third of the rows are one vector: its cell is dealt in shares, the smallest id wins."""
    rng = np.random.default_rng(5)
    rows = np.concatenate([np.ones((100, 4)), rng.normal(size=(200, 4))])
    check(spark, np.concatenate([np.ones((40, 4)), rng.normal(size=(40, 4))]), rows, 10)


def test_bundles_of_cells_and_shares_of_large_ones(spark, monkeypatch):
    """Vectors go to bundles of cells, of which there are few; cells beyond a share are dealt, with the same rows."""
    rng = np.random.default_rng(9)
    rows = np.concatenate([rng.normal(size=(300, 16)), np.ones((90, 16))])
    queries = np.concatenate([rng.normal(size=(60, 16)), np.ones((30, 16))])
    cells = mt.metric_cells(frame(spark, rows), 5)
    bound = spark.createDataFrame([(i, 1e6) for i in range(90)], "id bigint, bound double")
    assert len(cells.table) > 30 and mt._visits(frame(spark, queries).join(bound, "id"), cells).count() == 90
    monkeypatch.setattr(mt, "SHARE_ROWS", 40)
    assert mt._bundles(cells).max() < 20
    check(spark, queries, rows, 5)


def test_empty_sides(spark):
    some, none = frame(spark, np.eye(3)), frame(spark, [])
    assert mt.nearest_rows(some, none).collect() == [] and mt.nearest_rows(none, some).collect() == []
    assert mt.match_features(some, none).collect() == []


def test_clustered_rows_compare_few_pairs(spark):
    """Forty separate clusters: the bound of the first pass leaves a small part of all pairs."""
    rng = np.random.default_rng(2)
    centres = rng.normal(size=(40, 6)) * 100
    rows = frame(spark, centres[np.arange(800) % 40] + rng.normal(size=(800, 6)))
    queries = centres[np.arange(200) % 40] + rng.normal(size=(200, 6))
    cells = mt.metric_cells(rows, 20)
    _, dist = brute(queries, np.array([r["vec"] for r in rows.orderBy("id").collect()]))
    bound = spark.createDataFrame([(i, float(d)) for i, d in enumerate(dist)], "id bigint, bound double")
    visits = mt.open_cells(frame(spark, queries).join(bound, "id"), cells)
    sizes = cells.rows.groupBy("cell").agg(F.count(F.lit(1)).alias("n"))
    compared = visits.join(sizes, "cell").agg(F.sum("n")).first()[0]
    assert compared < 0.25 * 200 * 800


def test_radius_with_many_points_on_few_places(spark):
    """Against all pairs; points on one place are dealt in shares, and unknown vectors come first as null distances."""
    rng = np.random.default_rng(4)
    rows = [(i, *map(float, rng.integers(0, 3, 3)), rng.integers(0, 3, 4).astype(float).tolist()) for i in range(240)]
    schema = "id bigint, z double, y double, x double, vec array<double>"
    sides = [spark.createDataFrame(part, schema) for part in (rows[:120], rows[120:])]
    got = {tuple(r) for r in mt.match_features(*sides, radius=1.0, chunk_rows=7).collect()}

    def best(one, others):
        near = [(float(np.round(np.sqrt(((np.array(one[4]) - o[4]) ** 2).sum()), 12)), o[0]) for o in others if sum((p - q) ** 2 for p, q in zip(one[1:4], o[1:4])) <= 1]
        return min(near, default=None)

    there, back = {r[0]: best(r, rows[120:]) for r in rows[:120]}, {r[0]: best(r, rows[:120]) for r in rows[120:]}
    want = {(i, m[1]) for i, m in there.items() if m and back[m[1]][1] == i}
    assert {g[:2] for g in got} == want
    assert all(abs(g[2] - there[g[0]][0]) < 1e-9 for g in got)
    odd = [spark.createDataFrame(part, schema) for part in ([(1, 0.0, 0.0, 0.0, [1.0, 2.0])], [(2, 0.0, 0.0, 0.0, None), (4, 0.0, 0.0, 0.0, [1.0, 2.0])])]
    assert [tuple(r) for r in mt.match_features(*odd, radius=1.0).collect()] == [(1, 2, None)]
