"""Quality grades of documents by ordinal cumulative-link regression on hashed text.

Ratings are grades 0..G. One weight vector over hashed features is shared by all thresholds: P(grade >= j) is the logistic of
score minus threshold j, thresholds rising. A document gets its expected grade and the probability of the top grade, by
which documents are selected.

Features of a whole text: which words occur (letters only, lower case); which words, beginnings of words and word shapes
make up more than certain shares of it; and how often a word follows itself. The model is fitted on at most ``SAMPLE`` rated
documents, chosen by hash of the id: their features, not their texts, come to the driver. Scoring is one map over all documents.
"""

from __future__ import annotations

import operator
import re
import struct
import zlib
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from voxelweave.llm.piece_model import UnitCache

SAMPLE = 10_000
BUCKETS = 1 << 18
SHARES = (0.02, 0.1, 0.3, 0.6)
WORD_SHARES = (0.005, 0.01, 0.03)
BEGINNINGS = (4, 5, 6)
_CODE = struct.Struct(f"<{2 + len(BEGINNINGS)}i")
MIN_DOCS = 4  # a feature in fewer sampled documents has no weight
LEAST_Z, LEAST_R = 3.5, 0.15  # the first rules samples below some 500 documents
_LETTERS = re.compile(r"[^\W\d_]+")
_SYMBOL = re.compile(r"[^\w\s.,;:!?'\"()-]")
_RUN = re.compile(r"(.)\1+")


def _number(kind: int, name: str) -> int:
    return zlib.crc32(name.encode(), kind) % BUCKETS


def _shape(word: str) -> str:
    """Letters, digits and unusual symbols as one sign each, a run of signs as the sign and a plus."""
    kind = "A" if len(word) > 1 and word.isupper() else "a"
    return _RUN.sub(r"\1+", _SYMBOL.sub("§", re.sub(r"\d+", "9", _LETTERS.sub(kind, word))))[:8]


def _word_codes(word: str) -> bytes:
    """Numbers of a word's shape, of its letters, and of the letters' beginnings."""
    if word.isalpha():
        letters, shape = word, "A" if len(word) > 1 and word.isupper() else "a"
    else:
        letters, shape = "".join(_LETTERS.findall(word)), _shape(word)
    lower = letters.lower()
    starts = [_number(n, lower[:n]) for n in BEGINNINGS]
    return _CODE.pack(_number(1, shape), _number(2, lower), *starts)


_CODES = UnitCache(lambda words: [_word_codes(w) for w in words], limit=700_000)


def _above(numbers: np.ndarray, shares: np.ndarray, levels: tuple[float, ...]) -> list[np.ndarray]:
    """A feature for each level that a number's share exceeds."""
    return [(numbers[shares > s] * 31 + 7919 * (i + 1)) % BUCKETS for i, s in enumerate(levels)]


def features(text: str | None) -> np.ndarray:
    """Sorted distinct feature numbers of a text; empty for one without words."""
    words = (text or "").split()
    if not words:
        return np.empty(0, np.int64)
    codes = np.frombuffer(b"".join(_CODES.get(words)), "<i4").reshape(len(words), -1).astype(np.int64)
    shapes, counts = np.unique(codes[:, 0], return_counts=True)
    found = _above(shapes, counts / len(words), SHARES)
    numbers, counts = np.unique(codes[:, 1:], return_counts=True)
    found += [np.unique(codes[:, 1]), *_above(numbers, counts / len(words), WORD_SHARES)]
    repeats = np.array([sum(map(operator.eq, words[1:], words)) / len(words)])
    found += _above(np.array([_number(3, "repeat")]), repeats, SHARES)
    return np.unique(np.concatenate(found))


@dataclass
class GradeModel:
    """Weights by feature and the rising thresholds; ``known`` is False where there was nothing to fit."""

    weights: np.ndarray = field(repr=False)
    thresholds: np.ndarray
    known: bool = True

    def tails(self, found: list[np.ndarray]) -> np.ndarray:
        """P(grade >= j) for j = 1..G, a row per document."""
        score = np.array([self.weights[f].sum() for f in found])
        return 1 / (1 + np.exp(-np.clip(score[:, None] - self.thresholds[None, :], -30, 30)))


def _related(rows: np.ndarray, columns: np.ndarray, grades: np.ndarray) -> np.ndarray:
    """Which features go with the grade: in ``MIN_DOCS`` documents or more, with a correlation of at least ``LEAST_R`` and
    ``LEAST_Z`` standard errors."""
    n = len(grades)
    docs = np.bincount(columns, minlength=BUCKETS)
    centred = grades - grades.mean()
    covariance = np.bincount(columns, centred[rows], BUCKETS) / n
    spread = np.sqrt(np.maximum(docs / n * (1 - docs / n), 1e-12)) * grades.std()
    return (docs >= MIN_DOCS) & (np.abs(covariance / spread) >= max(LEAST_R, LEAST_Z / np.sqrt(n)))


def fit(found: list[np.ndarray], grades: np.ndarray, steps: int = 1000, l2: float = 0.1, rate: float = 0.1) -> GradeModel:
    """Maximum likelihood with a ridge on the weights, by full-batch Adam from zero (no randomness)."""
    levels = int(grades.max()) if len(grades) else 0
    if not levels or len(np.unique(grades)) < 2:
        return GradeModel(np.zeros(BUCKETS), np.zeros(max(levels, 1)), False)
    rows = np.repeat(np.arange(len(found)), [len(f) for f in found])
    columns = np.concatenate(found)
    keep = _related(rows, columns, grades)[columns]
    rows, columns = rows[keep], columns[keep]
    used, columns = np.unique(columns, return_inverse=True)
    weights = np.zeros(len(used))
    # First threshold, then logarithms of the steps up, so that the order holds.
    shape = np.zeros(levels)
    share = [(grades >= j).mean() for j in range(1, levels + 1)]
    logit = [-np.log((p + 1e-3) / (1 - p + 1e-3)) for p in share]
    shape[0], shape[1:] = logit[0], np.log(np.maximum(np.diff(logit), 0.1))
    index, n = np.arange(len(grades)), len(grades)
    state = [np.zeros_like(weights), np.zeros_like(weights), np.zeros_like(shape), np.zeros_like(shape)]
    for step in range(1, steps + 1):
        theta = shape[0] + np.concatenate([[0.0], np.cumsum(np.exp(shape[1:]))])
        score = np.bincount(rows, weights[columns], n)
        tail = 1 / (1 + np.exp(-np.clip(score[:, None] - theta, -30, 30)))
        slope = tail * (1 - tail)
        bounded = np.concatenate([np.ones((n, 1)), tail, np.zeros((n, 1))], 1)
        slopes = np.concatenate([np.zeros((n, 1)), slope, np.zeros((n, 1))], 1)
        chance = np.maximum(bounded[index, grades] - bounded[index, grades + 1], 1e-12)
        d_score = -(slopes[index, grades] - slopes[index, grades + 1]) / chance / n
        d_theta = np.zeros(levels)
        low, high = grades > 0, grades < levels
        np.add.at(d_theta, grades[low] - 1, (slopes[index, grades] / chance / n)[low])
        np.add.at(d_theta, grades[high], -(slopes[index, grades + 1] / chance / n)[high])
        d_shape = np.zeros(levels)
        d_shape[0] = d_theta.sum()
        for j in range(1, levels):
            d_shape[j] = d_theta[j:].sum() * np.exp(shape[j])
        d_weights = np.bincount(columns, d_score[rows], len(used)) + l2 / n * weights
        for value, slope_of, m, v in ((weights, d_weights, 0, 1), (shape, d_shape, 2, 3)):
            state[m] += 0.1 * (slope_of - state[m])
            state[v] += 0.01 * (slope_of * slope_of - state[v])
            value -= rate * (state[m] / (1 - 0.9**step)) / (np.sqrt(state[v] / (1 - 0.99**step)) + 1e-9)
    out = np.zeros(BUCKETS)
    out[used] = weights
    return GradeModel(out, shape[0] + np.concatenate([[0.0], np.cumsum(np.exp(shape[1:]))]))


def rated_features(docs: DataFrame, ratings: DataFrame, id_col: str, text_col: str, sample: int) -> pa.Table:
    """``grade`` and ``features`` of at most ``sample`` rated documents, chosen by hash of the id.

    ``ratings`` is ``(doc_id, grade)``; an id rated several times counts with its lowest grade, null ratings do not count.
    """
    graded = ratings.select(F.col(id_col).cast("long").alias("_id"), F.col("grade").cast("int").alias("grade")).dropna()
    graded = graded.groupBy("_id").agg(F.min("grade").alias("grade"))
    chosen = graded.orderBy(F.xxhash64("_id"), "_id").limit(sample)

    def task(batches):
        for batch in batches:
            lists = pa.array([features(t.as_py()).astype(np.int32) for t in batch.column(1)], pa.list_(pa.int32()))
            yield pa.RecordBatch.from_arrays([batch.column(0), lists], names=["grade", "features"])

    texts = docs.select(F.col(id_col).cast("long").alias("_id"), F.col(text_col).alias("_text"))
    # At most `sample` short rows, so sending them to all tasks is safe.
    rows = texts.join(F.broadcast(chosen), "_id").select("grade", "_text")
    return rows.mapInArrow(task, "grade int, features array<int>").toArrow()


def train(
    docs: DataFrame, ratings: DataFrame, id_col: str = "doc_id", text_col: str = "text", sample: int = SAMPLE
) -> GradeModel:
    rows = rated_features(docs, ratings, id_col, text_col, sample)
    grades = rows["grade"].to_numpy().astype(np.int64)
    lists = rows["features"].combine_chunks()
    ends = np.asarray(lists.offsets)
    values = np.asarray(lists.values).astype(np.int64)
    found = [values[a:b] for a, b in zip(ends[:-1], ends[1:])]
    # Sums depend on the order of rows in their last digits; tasks end in any order.
    order = sorted(range(len(found)), key=lambda i: (grades[i], found[i].tobytes()))
    return fit([found[i] for i in order], grades[order])


def grade_of(model: GradeModel, text: Column) -> Column:
    """Struct ``(expected_grade, p_top)`` of a text; nulls where the model knows no grades."""
    shared = (model.weights.astype(np.float32), model.thresholds, model.known)

    @F.pandas_udf("expected_grade double, p_top double")
    def grade(texts: pd.Series) -> pd.DataFrame:
        weights, thresholds, known = shared
        if not known:
            return pd.DataFrame({"expected_grade": [None] * len(texts), "p_top": [None] * len(texts)}, dtype="float64")
        tails = GradeModel(weights, thresholds).tails([features(t) for t in texts])
        return pd.DataFrame({"expected_grade": tails.sum(1), "p_top": tails[:, -1]})

    return grade(text)


def grade_documents(
    docs: DataFrame, model: GradeModel, id_col: str = "doc_id", text_col: str = "text", least: float = 0.5
) -> DataFrame:
    """One row per input row: ``doc_id, expected_grade, p_top, keep``.

    ``keep`` is whether the top grade has probability ``least`` or more; all are kept by a model without grades. A null text
    counts as empty and gets the grade of a text without features. Null ids stay null, repeated rows repeat, an empty table
    gives an empty result, other columns are ignored.
    """
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), grade_of(model, F.col(text_col)).alias("g"))
    return rows.select("doc_id", "g.*", F.coalesce(F.col("g.p_top") >= least, F.lit(True)).alias("keep"))


def keep_good(docs: DataFrame, model: GradeModel, text_col: str = "text", least: float = 0.5) -> DataFrame:
    """The rows of ``docs`` that are kept, with their columns."""
    return docs.where(F.coalesce(grade_of(model, F.col(text_col))["p_top"] >= least, F.lit(True)))


def corpus_ratings(labels: DataFrame) -> DataFrame:
    """Grades of the ``labels`` table: 0, plus one for good quality, plus one for not toxic."""
    return labels.select("doc_id", (F.col("quality") + 1 - F.col("toxic")).alias("grade"))
