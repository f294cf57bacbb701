"""Balance, grouping and numbering of shards; cut links after propagation."""

from __future__ import annotations

import zlib

import pytest
from pyspark.sql import functions as F

from voxelweave.llm import sharding
from voxelweave.llm.queries import all_queries


def held(rows):
    """Checks that hold for any result; bytes per shard."""
    slots, sizes = {}, {}
    for r in rows:
        slots.setdefault(r["shard"], []).append(r["slot"])
        sizes[r["shard"]] = sizes.get(r["shard"], 0) + r["size"]
        assert r["law"] == "bytes" and r["grown_shard"] is None and 0 <= r["shard"]
    for found in slots.values():
        assert sorted(found) == list(range(len(found)))
    return sizes


def test_query(spark, sf_dir, corpus):
    rows = all_queries()["op3_sharding"](spark, sf_dir).collect()
    assert sorted(r["doc_id"] for r in rows) == sorted(corpus)
    sizes = held(rows)
    for r in rows:
        text = corpus[r["doc_id"]].encode()
        assert r["size"] == len(text) + 8 and r["text_crc32"] == zlib.crc32(text)
    assert max(sizes) < 24
    mean = sum(sizes.values()) / 24
    largest = max(r["size"] for r in rows)
    assert max(sizes.values()) <= max(mean * 1.05, largest) and len(sizes) == 24  # some eight documents a shard


def test_groups_stay_together_and_large_ones_are_split_evenly(spark):
    texts = [f"text {i // 3} " * 20 for i in range(600)] + ["the same text " * 15] * 400 + [f"single {i} " * (1 + i % 40) for i in range(900)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    rows = sharding.shard_documents(docs, shards=8).collect()
    sizes = held(rows)
    mean = sum(sizes.values()) / 8
    assert max(sizes.values()) - min(sizes.values()) < 0.01 * mean
    places = {}
    for r in rows:
        places.setdefault(texts[r["doc_id"]], set()).add(r["shard"])
    trios = [p for t, p in places.items() if t.startswith("text")]
    assert sum(len(p) == 1 for p in trios) >= 0.97 * len(trios)


def test_propagation_cuts_few_links_under_the_quota(spark):
    """Two rings of cliques: neighbours end up together, no shard above its quota."""
    links = [(g * 5 + i, g * 5 + j) for g in range(40) for i in range(5) for j in range(i)]
    nodes = spark.createDataFrame([(i, 10) for i in range(200)], "row long, size long")
    placed = sharding.propagate(nodes, spark.createDataFrame(links, "a long, b long"), 4, 600, 14, 64)
    at = {r["row"]: r["shard"] for r in placed.collect()}
    loads = [sum(10 for s in at.values() if s == k) for k in range(4)]
    assert len(at) == 200 and max(loads) <= 650
    assert sum(at[a] != at[b] for a, b in links) < 0.1 * len(links)


def test_native_plan(spark, sf_dir):
    plan = all_queries()["op3_sharding"](spark, sf_dir)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan


def test_running_total(spark):
    rows = spark.range(500).select(F.col("id").alias("row"), (F.col("id") % 3).alias("k"), (F.col("id") % 7 + 1).alias("w"))
    found = sharding.running_total(rows, "k", "w", "before", 16).collect()
    for k in range(3):
        mine = sorted((r["before"], r["w"]) for r in found if r["k"] == k)
        assert mine[0][0] == 0 and all(b == a + w for (a, w), (b, _) in zip(mine, mine[1:]))


def test_levels():
    assert sharding._levels([0, 0, 6], 3) == pytest.approx([1.5, 1.5, 0])
    assert sharding._levels([0, 3, 6], 9) == pytest.approx([6, 3, 0])


def test_odd_rows(spark, odd):
    rows = sharding.shard_documents(odd, shards=3).collect()
    held(rows)
    assert len(rows) == odd.count()
    assert {(r["size"], r["text_crc32"]) for r in rows if r["doc_id"] in (2, 3)} == {(8, 0)}
    assert sharding.shard_documents(odd.limit(0)).count() == 0
