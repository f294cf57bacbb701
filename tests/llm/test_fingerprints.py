"""Sketches: likeness by peeling equals sets; order of documents; edited texts."""

from __future__ import annotations

import hashlib
import re

from pyspark.sql import functions as F

from voxelweave.llm import fingerprints
from voxelweave.llm.queries import all_queries

PARAGRAPH = re.compile(fingerprints.PARAGRAPH)


def likeness(a: str, b: str) -> float:
    x, y = set(PARAGRAPH.findall(a)), set(PARAGRAPH.findall(b))
    return len(x & y) / len(x | y) if x | y else 1.0


def expected(docs: list[tuple]):
    """``docs`` in order; (doc_id, n_chars, sha, near_edited, near_next) of each."""
    out = []
    for i, (doc_id, text) in enumerate(docs):
        follow = docs[(i + 1) % len(docs)][1]
        half = len(text) // 2
        edited = text[: len(text) - half] + follow[:half]
        out.append((doc_id, len(text), hashlib.sha256(edited.encode()).hexdigest(), likeness(text, edited), likeness(text, follow)))
    return out


def key(row):
    return (-(1 << 63) if row[0] is None else row[0], *row[1:])


def test_query(spark, sf_dir, corpus):
    rows = all_queries()["op10_fingerprints"](spark, sf_dir).collect()
    got = [(r["doc_id"], r["n_chars"], r["edited_sha256"], r["near_edited"], r["near_next"]) for r in rows]
    assert sorted(got) == sorted(expected(sorted(corpus.items(), reverse=True)))
    prints = {}
    for r in rows:
        prints.setdefault(corpus[r["doc_id"]], set()).add(r["fingerprint"])
    assert all(len(p) == 1 for p in prints.values())
    assert len({next(iter(p)) for p in prints.values()}) >= 0.99 * len(prints)


def test_larger_sketches_are_tried(spark):
    """Thousands of differing paragraphs do not fit the first sketches."""
    texts = ["\n".join(f"line {i} of {d}" for i in range(n)) for d, n in ((1, 4000), (2, 300), (3, 20), (4, 1))]
    texts.append(texts[0] + "\none more")
    docs = list(enumerate(texts))
    rows = fingerprints.fingerprint_documents(spark.createDataFrame(docs, "doc_id long, text string")).collect()
    got = [(r["doc_id"], r["n_chars"], r["edited_sha256"], r["near_edited"], r["near_next"]) for r in rows]
    assert sorted(got) == sorted(expected(docs[::-1]))


def test_native_plan(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for df in (fingerprints.successors(docs, "doc_id", "text"), all_queries()["op10_fingerprints"](spark, sf_dir)):
        plan = df._jdf.queryExecution().toString()
        assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan


def test_many_ranges(spark):
    bounds = list(range(0, 2000, 7))
    found = spark.range(-5, 2005).select("id", fingerprints._range_of(F.col("id"), bounds).alias("r")).collect()
    assert all(r["r"] == sum(b <= r["id"] for b in bounds) for r in found)


def test_odd_rows(spark, odd):
    rows = fingerprints.fingerprint_documents(odd).collect()
    docs = [(r["doc_id"], r["text"] or "") for r in odd.select("doc_id", "text").collect()]
    got = [(r["doc_id"], r["n_chars"]) for r in rows]
    assert sorted(got, key=key) == sorted([(i, len(t)) for i, t in docs], key=key)
    assert {r["near_edited"] for r in rows if r["n_chars"] == 0} == {1.0}
    one = odd.where("doc_id = 7")
    single = fingerprints.fingerprint_documents(one).first()
    assert (single["near_edited"], single["near_next"]) == (1.0, 1.0)
    assert fingerprints.fingerprint_documents(odd.limit(0)).count() == 0
