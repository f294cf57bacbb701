"""Ordinal regression: held-out documents, likelihood, thresholds and odd rows."""

from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.llm.conftest import with_clashes
from voxelweave.llm import grading
from voxelweave.llm.common import table

LARGER = "/root/testdata/sf0.1"


def test_held_out_documents(spark):
    """Fitted on half of the labels of larger tables, judged on the other half."""
    docs, labels = table(spark, LARGER, "documents"), table(spark, LARGER, "labels")
    half = F.pmod(F.xxhash64("doc_id"), F.lit(2)) == 0
    model = grading.train(docs, grading.corpus_ratings(labels.where(half)))
    found = grading.grade_documents(docs, model).join(labels.where(~half), "doc_id").collect()
    good = [r for r in found if r["quality"] == 1 and r["toxic"] == 0]
    poor = [r for r in found if r["quality"] == 0]
    assert len(found) > 1500
    assert np.mean([r["keep"] for r in good]) >= 0.98
    assert np.mean([not r["keep"] for r in poor]) >= 0.8
    assert np.mean([r["expected_grade"] for r in good]) > np.mean([r["expected_grade"] for r in poor]) + 0.5


def test_fit_orders_grades_and_thresholds():
    rng = np.random.default_rng(2)
    found, grades = [], []
    for _ in range(600):
        grade = int(rng.integers(0, 4))
        marks = [100 + j for j in range(3) if (grade > j) != (rng.random() < 0.05)]
        found.append(np.array(sorted({*marks, *rng.integers(1000, 1200, 20).tolist()})))
        grades.append(grade)
    model = grading.fit(found[:400], np.array(grades[:400]))
    assert (np.diff(model.thresholds) > 0).all()
    expected = model.tails(found[400:]).sum(1)
    assert np.corrcoef(expected, grades[400:])[0, 1] > 0.85
    assert (np.diff(model.tails(found[400:]), axis=1) <= 0).all()


def test_gradient_by_brute_force(monkeypatch):
    """At the fitted point the penalised likelihood falls in every direction."""
    monkeypatch.setattr(grading, "LEAST_R", 0.0)
    monkeypatch.setattr(grading, "LEAST_Z", 0.0)
    rng = np.random.default_rng(4)
    found = [np.unique(rng.integers(0, 6, 4)) for _ in range(80)]
    grades = np.array([min(2, max(0, int(f.sum() % 4))) for f in found])

    def loss(model):
        tails = np.concatenate([np.ones((80, 1)), model.tails(found), np.zeros((80, 1))], 1)
        chance = tails[np.arange(80), grades] - tails[np.arange(80), grades + 1]
        return -np.log(chance).mean() + 5 / 80 / 2 * (model.weights**2).sum()

    model = grading.fit(found, grades, steps=4000, l2=5, rate=0.01)
    base = loss(model)
    for i in range(6):
        for move in (-0.05, 0.05):
            changed = model.weights.copy()
            changed[i] += move
            assert loss(grading.GradeModel(changed, model.thresholds)) > base - 1e-6


@pytest.mark.parametrize("text", [None, "", " \n "])
def test_no_words_no_features(text):
    assert len(grading.features(text)) == 0


def test_shapes():
    assert [grading._shape(w) for w in ("THE!!", "Mixed", "x12,", "word%%%", "|", "A")] == ["A!+", "a", "a9,", "a§+", "§", "a"]


def test_odd_rows(spark, odd):
    ratings = spark.createDataFrame([(1, 0), (1, 2), (6, 2), (7, None), (None, 1), (99, 1)], "doc_id long, grade int")
    model = grading.train(odd, ratings)
    rows = grading.grade_documents(odd, model).collect()
    assert len(rows) == odd.count() and all(r["p_top"] is not None for r in rows)
    assert grading.keep_good(odd, model).columns == odd.columns
    unknown = grading.train(odd, ratings.limit(0))
    assert all(r["keep"] and r["p_top"] is None for r in grading.grade_documents(odd, unknown).collect())
    assert grading.grade_documents(odd.limit(0), model).count() == 0


def test_ratings_of_labels(spark):
    labels = with_clashes(spark.createDataFrame([(1, 1, 0), (2, 0, 1), (3, None, 1)], "doc_id long, quality int, toxic int"))
    assert [r["grade"] for r in grading.corpus_ratings(labels).orderBy("doc_id").collect()] == [2, 0, None]
