"""Whitening against NumPy's eigenvectors, exact sums, the solver on hard matrices, and odd rows."""

from __future__ import annotations

import math

import numpy as np
import pytest

from voxelweave.llm import whitening
from voxelweave.llm.queries import all_queries


def plain(vectors: list[tuple]) -> dict:
    """``{vec_id: (deviation, w)}``, explained shares, directions by NumPy; rows that take part only."""
    good = [(i, v) for i, v in vectors if v and all(c is not None and math.isfinite(c) for c in v)]
    x = [[math.floor(64 * float(c)) + 1_000_000 for c in v] for _, v in good]
    n, sums = len(x), [sum(c) for c in zip(*x)]
    deviations = [sum((n * c - s) ** 2 for c, s in zip(row, sums)) for row in x]
    centred = np.array([[(n * c - s) / n for c, s in zip(row, sums)] for row in x])
    e, v = np.linalg.eigh(centred.T @ centred / n)
    return [i for i, _ in good], deviations, centred, e[::-1], v[:, ::-1].T


def compare(rows, vectors, components=32):
    ids, deviations, centred, e, v = plain(vectors)
    kept = min(components, int((e > e[0] * 1e-12).sum()))
    assert len(rows) == len(ids) * kept
    got = {}
    for r in rows:
        got.setdefault(r["vec_id"], {}).setdefault(r["component"], r)
    where = {i: k for k, i in enumerate(ids)}
    assert set(got) == set(ids)
    w = np.array([[got[i][c + 1]["whitened"] for c in range(kept)] for i in ids])
    want = centred @ v[:kept].T / np.sqrt(e[:kept])
    gaps = np.abs(np.diff(e))[: kept + 1] / e[0]
    for c in range(kept):
        apart = min(gaps[max(0, c - 1) : c + 1], default=1) > 1e-6
        if apart:
            sign = np.sign(w[:, c] @ want[:, c])
            assert np.allclose(w[:, c] * sign, want[:, c], atol=1e-7)
    covariance = (w - w.mean(0)).T @ (w - w.mean(0)) / len(w)
    assert np.abs(covariance - np.eye(kept)).max() < 1e-8
    for r in rows:
        assert r["n"] == len(ids)
        assert r["deviation"] == deviations[where[r["vec_id"]]]
        assert r["explained"] == pytest.approx(e[r["component"] - 1] / e.sum(), rel=1e-9)
        assert 0 <= r["identity_error"] < 1e-8


def test_query(spark, sf_dir):
    rows = all_queries()["op13_whitening"](spark, sf_dir)
    assert rows.schema.simpleString() == (
        "struct<vec_id:bigint,component:int,n:bigint,deviation:bigint,whitened:double,explained:double,identity_error:double>"
    )
    table = spark.read.parquet(f"{sf_dir}/embeddings.parquet").select("vec_id", "embedding").collect()
    compare(rows.collect(), [(r[0], r[1]) for r in table])


def test_odd_rows(spark):
    rng = np.random.default_rng(1)
    rows = [(i, [float(c) for c in rng.standard_normal(6) * [9, 5, 3, 3, 1, 0]]) for i in range(300)]
    rows = [(i, [*v[:5], 7.25]) for i, v in rows]  # one entry is the same in all rows
    bad = [(900, None), (901, []), (902, [1.0, None, 1.0, 1.0, 1.0, 1.0]), (903, [1.0, float("nan"), 1.0, 1.0, 1.0, 1.0]), (904, [float("-inf")] * 6)]
    df = spark.createDataFrame(rows + bad, "vec_id long, embedding array<double>")
    clash = df.selectExpr("*", "'clash' AS n", "'clash' AS x", "'clash' AS component", "'clash' AS at", "'clash' AS r")
    compare(whitening.whiten(clash).collect(), rows)
    twice = whitening.whiten(df.union(df).unionByName(df.where("vec_id = 3").selectExpr("CAST(NULL AS long) AS vec_id", "embedding")))
    assert twice.count() == (2 * 300 + 1) * 5
    assert twice.where("vec_id IS NULL").count() == 5
    assert whitening.whiten(df.limit(0)).count() == 0
    assert whitening.whiten(df.where("vec_id = 3")).count() == 0
    assert whitening.whiten(df.where("vec_id >= 900")).count() == 0
    assert whitening.whiten(df, components=2).select("component").distinct().count() == 2
    with pytest.raises(ValueError, match="lengths"):
        whitening.whiten(df.unionByName(spark.createDataFrame([(1, [1.0])], df.schema))).count()


def test_huge_entries(spark):
    rows = [(i, [1e300 if i % 2 else -1e300, float(i)]) for i in range(10)]
    out = whitening.whiten(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).collect()
    assert len(out) >= 10 and all(r["deviation"] is None and math.isfinite(r["whitened"]) for r in out)


def test_exact_sums_of_large_entries():
    sums = [3 * (1 << 40) + 1, 7]
    centre = whitening.Centre(3, sums)
    x = np.array([[1 << 40, 2], [(1 << 40) + 1, 2], [1 << 40, 3]])
    assert centre.deviations(x) == [sum((3 * int(c) - s) ** 2 for c, s in zip(row, sums)) for row in x]
    far = np.array([[1 << 55, 2]])
    assert centre.deviations(far) == [None]


def test_merging_in_many_pieces(spark):
    """More pieces than one group merges: the tree has several levels."""
    rng = np.random.default_rng(2)
    rows = [(i, [float(c) for c in rng.standard_normal(4) * 3]) for i in range(400)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    x = whitening.integer_vectors(df).repartition(90)
    sums = [sum(math.floor(64 * v[c]) + 1_000_000 for _, v in rows) for c in range(4)]
    centre = whitening.Centre(400, sums)
    data = whitening._reduced(x.mapInArrow(whitening._qr_task(centre), "r binary"), whitening._merge_group, "r")
    r = np.frombuffer(data, float).reshape(4, 4)
    full = centre.rows(np.array([[math.floor(64 * c) + 1_000_000 for c in v] for _, v in rows]))
    assert np.allclose(r.T @ r, full.T @ full, rtol=1e-12)


@pytest.mark.parametrize("kind", ["plain", "graded", "equal", "clusters", "rank", "identity", "few"])
def test_solver(kind):
    rng = np.random.default_rng(3)
    turn = np.linalg.qr(rng.standard_normal((24, 24)))[0]
    other = np.linalg.qr(rng.standard_normal((24, 24)))[0]
    a = {
        "plain": rng.standard_normal((24, 24)),
        "graded": np.triu(rng.standard_normal((24, 24))) * np.logspace(0, -9, 24),
        "equal": turn,
        "clusters": (turn * np.repeat([5.0, 2.0, 1e-2], 8)) @ other,
        "rank": rng.standard_normal((24, 7)) @ rng.standard_normal((7, 24)),
        "identity": np.eye(24),
        "few": np.vstack([rng.standard_normal((3, 24)), np.zeros((21, 24))]),
    }[kind]
    squares, vectors = whitening.right_vectors(a)
    true = np.linalg.svd(a, compute_uv=False)
    real = true > true[0] * 1e-11
    assert np.allclose(np.sqrt(squares[real]), true[real], rtol=1e-10)
    v = vectors[real]
    assert np.abs(v @ v.T - np.eye(len(v))).max() < 1e-10
    white = a @ v.T / np.sqrt(squares[real])
    assert np.abs(white.T @ white - np.eye(len(v))).max() < 1e-7


def test_graded_values_are_accurate():
    """Small values of a graded bidiagonal matrix to high relative accuracy, against exact arithmetic of its determinant."""
    diagonal, above = np.logspace(0, -12, 7), np.logspace(-0.5, -11.5, 6)
    squares = whitening.squared_singular_values(diagonal, above)
    assert np.prod(squares) == pytest.approx(float(np.prod(diagonal**2)), rel=1e-12)
    assert squares.sum() == pytest.approx((diagonal**2).sum() + (above**2).sum(), rel=1e-13)
