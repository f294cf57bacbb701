"""Fingerprints and components against brute force."""

from __future__ import annotations

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from voxelweave.llm import graph, simhash
from voxelweave.llm.queries import all_queries


def plain_fingerprint(text: str) -> int:
    words = text.encode().lower().split()
    shingles = [b" ".join(words[i : i + 4]) for i in range(len(words) - 3)] if len(words) >= 4 else [b" ".join(words)] * bool(words)
    hashes = [xxhash.xxh64_intdigest(s, seed=42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def components(ids, fps, bits=4):
    """Smallest id reachable, by plain search over all pairs."""
    fps, name = np.array(fps, np.uint64), {}
    for i in np.argsort(ids):
        if i in name:
            continue
        todo = [i]
        while todo:
            at = todo.pop()
            if at in name:
                continue
            name[at] = ids[i]
            todo += np.flatnonzero(np.bitwise_count(fps ^ fps[at]) <= bits).tolist()
    return [name[i] for i in range(len(ids))]


@pytest.mark.parametrize("text", ["", " \t", "One", "a B c", "a b c d", "x " * 50, "É é A\x0bb\x1cc d e f"])
def test_fingerprint(text):
    assert simhash.fingerprint(text) == plain_fingerprint(text)


def test_spark_hash_is_the_same(spark):
    spark_hash = spark.range(1).select(F.xxhash64(F.lit("é a b c"))).first()[0]
    assert spark_hash & (1 << 64) - 1 == xxhash.xxh64_intdigest("é a b c", seed=42)


def test_query(spark, sf_dir, corpus):
    rows = all_queries()["op7_simhash"](spark, sf_dir).collect()
    assert len(rows) == len(corpus)
    for r in rows:
        assert int(r["fingerprint"], 16) == plain_fingerprint(corpus[r["doc_id"]])
    found = components([r["doc_id"] for r in rows], [int(r["fingerprint"], 16) for r in rows])
    assert found == [r["component_id"] for r in rows]


@pytest.mark.parametrize("limit", [20_000, 9])
def test_dense_groups_with_and_without_dealt_runs(spark, limit):
    rng = np.random.default_rng(3)
    bases = rng.integers(0, 1 << 63, 4, dtype=np.uint64)
    fps = []
    for base in bases:
        for _ in range(60):
            bits = rng.choice(12, rng.integers(0, 6), replace=False)
            fps.append(int(base) ^ sum(1 << int(b) * 5 for b in bits))
    fps = sorted(set(fps))
    signed = [f - (1 << 64) if f >> 63 else f for f in fps]
    links = simhash.near_links(spark.createDataFrame([(f,) for f in signed], "fp long"), 4, limit)
    for a, b in links.collect():
        assert bin((a ^ b) & (1 << 64) - 1).count("1") <= 4
    roots = {r["node"]: r["root"] for r in graph.connected_components(links).collect()}
    got = {}
    for f, s in zip(fps, signed):
        got.setdefault(roots.get(s, s), []).append(f)
    want = {}
    for f, c in zip(fps, components(list(range(len(fps))), fps)):
        want.setdefault(c, []).append(f)
    assert sorted(map(sorted, got.values())) == sorted(map(sorted, want.values()))


def test_components_of_paths_and_stars(spark):
    rows = [(i, i + 1) for i in range(200)] + [(1000, 1000 + i) for i in range(1, 300)] + [(5000, 5000), (7, 7)]
    roots = graph.connected_components(spark.createDataFrame(rows, "a long, b long")).collect()
    groups = {}
    for r in roots:
        groups.setdefault(r["root"], set()).add(r["node"])
    assert sorted(map(len, groups.values())) == [201, 300]
    assert all(root in nodes for root, nodes in groups.items())
    assert graph.connected_components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_odd_rows(spark, odd):
    rows = simhash.near_duplicates(odd).collect()
    assert len(rows) == odd.count()
    white = {r["component_id"] for r in rows if r["fingerprint"] == "0" * 16}
    assert white == {2}  # null, empty and white texts, with and without an id
    assert {r["component_id"] for r in rows if r["doc_id"] in (1, 5)} == {1}
    assert simhash.near_duplicates(odd.limit(0)).count() == 0
