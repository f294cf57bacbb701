"""Packing: every id once, capacity, little padding, balanced cost."""

from __future__ import annotations

import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from voxelweave.llm import packing
from voxelweave.llm.queries import all_queries

PATH = public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(PATH)


def ids_of(tokenizer, text):
    return np.array(tokenizer.encode(text or "", add_special_tokens=False).ids + [1], "<u4")


def held(rows, texts, tokenizer, capacity=2048):
    pieces, sequences = {}, {}
    for r in rows:
        pieces.setdefault(r["doc_id"], []).append(r)
        sequences.setdefault(r["sequence_id"], []).append(r)
    assert set(pieces) == set(texts)
    for doc_id, found in pieces.items():
        ids, at = ids_of(tokenizer, texts[doc_id]), 0
        for r in sorted(found, key=lambda r: r["start"]):
            assert r["start"] == at and r["doc_tokens"] == len(ids) and r["length"] > 0
            at += r["length"]
            assert r["ids_crc32"] == zlib.crc32(ids[r["start"] : at].tobytes())
        assert at == len(ids)
    for found in sequences.values():
        at = 0
        for r in sorted(found, key=lambda r: r["offset"]):
            assert r["offset"] == at
            at += r["length"]
        assert at <= capacity
    return sequences


def test_query(spark, sf_dir, corpus, tokenizer):
    rows = all_queries()["op6_packing"](spark, sf_dir).collect()
    sequences = held(rows, corpus, tokenizer)
    total = sum(r["length"] for r in rows)
    assert len(sequences) <= total // 2048 + 2


@pytest.mark.parametrize(
    "text", ["", "don't I'LL 're", "a<|endoftext|>b", "<|STARTOFTEXT|>", "İI K ﬁ", "x\x1cy\x85z\xa0q　r", "é É İ", "..'s 12½ 日本 😀", "ΑΣ ΑΣ."]
)
def test_word_ids_equal_the_tokenizer(text, tokenizer):
    assert packing.word_ids(PATH, text).tolist() == tokenizer.encode(text, add_special_tokens=False).ids


def test_assignment_by_brute_force():
    rng = np.random.default_rng(5)
    lengths = np.sort(rng.integers(1, 60, 80))[::-1]
    pieces = packing.assign(lengths, 64, 1.0, 1 / 64)
    n = -(-int(lengths.sum()) // 64)
    cost, room, whole = [0.0] * n, [64] * n, {}
    for item, size in enumerate(lengths.tolist()):
        fits = [s for s in range(n) if room[s] >= size]
        if fits:
            to = min(fits, key=lambda s: (cost[s], s))
            whole[item] = to
            room[to] -= size
            cost[to] += size + size * size / 64
    for item, first, size, sequence, _ in pieces:
        if item in whole:
            assert (first, size, sequence) == (0, lengths[item], whole[item])
    assert sum(p[2] for p in pieces) == lengths.sum() and max(p[3] for p in pieces) < n


def test_several_groups(spark, corpus, tokenizer):
    docs = spark.createDataFrame(list(corpus.items()), "doc_id long, text string")
    held(packing.pack(docs, PATH, group_rows=40).collect(), corpus, tokenizer)


def test_odd_rows(spark, odd, tokenizer):
    rows = packing.pack(odd, PATH).collect()
    empty = [r for r in rows if r["doc_id"] in (2, 3)]
    assert all(r["length"] == 1 and r["ids_crc32"] == zlib.crc32(np.array([1], "<u4").tobytes()) for r in empty)
    assert len([r for r in rows if r["doc_id"] == 1]) == 2 and len([r for r in rows if r["doc_id"] is None]) == 2
    assert sum(r["length"] for r in rows if r["doc_id"] == 8) > 100_000
    assert packing.pack(odd.limit(0), PATH).count() == 0
