"""Benchmark windows in documents against plain Python."""

from __future__ import annotations

import hashlib
import random
import re

import numpy as np
import pyarrow as pa

from tests.compare import differences, oracle_connection
from tests.llm.conftest import with_clashes
from voxelweave.llm import decontamination, words
from voxelweave.llm.queries import all_oracles, all_queries

WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")


def lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


def plain(docs, items, size=10):
    windows = {}
    for item, text in items:
        w = WORD.findall(lower(text))
        n = min(size, len(w))
        for i in range(len(w) - n + 1 if n else 0):
            windows.setdefault(tuple(w[i : i + n]), set()).add(item)
    sizes, out = {len(w) for w in windows}, []
    for doc, text in docs:
        w, hit, found = WORD.findall(lower(text)), set(), set()
        for n in sizes:
            for i in range(len(w) - n + 1):
                if tuple(w[i : i + n]) in windows:
                    hit |= set(range(i, i + n))
                    found |= windows[tuple(w[i : i + n])]
        ids = sorted(str(i) for i in found if i is not None)
        out.append((doc, len(w), len(hit), len(ids), hashlib.sha256(",".join(ids).encode()).hexdigest(), bool(hit)))
    return out


def rows_of(df):
    return [(r["doc_id"], r["n_words"], r["n_hit"], r["n_items"], r["items_sha256"], r["contaminated"]) for r in df.collect()]


def order(row):
    return (row[0] is not None, row[0] or 0, *row[1:])


def check(spark, docs, items, **options):
    left = spark.createDataFrame(docs, "doc_id long, text string")
    right = spark.createDataFrame(items, "item_id long, text string")
    got = rows_of(decontamination.decontaminate(with_clashes(left), with_clashes(right), **options))
    assert sorted(got, key=order) == sorted(plain(docs, items, options.get("window", 10)), key=order)
    return got


def test_query_equals_sql(spark, sf_dir):
    con = oracle_connection(sf_dir)
    name = "op12_decontamination"
    assert differences(all_queries()[name](spark, sf_dir), con, all_oracles()[name]) is None


def test_windows_of_all_sizes(spark):
    rng = random.Random(1)
    vocabulary = [f"w{i}" for i in range(60)]
    items = [(i, " ".join(rng.choices(vocabulary, k=rng.choice([1, 2, 3, 4, 5, 7, 9, 10, 11, 25])))) for i in range(40)]
    items = [(i, t) for i, t in items if len(t.split()) > 1 or i % 7 == 0]
    docs = []
    for d in range(60):
        parts = [rng.choices(vocabulary, k=rng.randrange(30))]
        for _ in range(rng.randrange(3)):
            text = rng.choice(items)[1].split()
            lo = rng.randrange(len(text))
            parts.append(text[lo : lo + rng.choice([3, 9, 10, 30])] if rng.random() < 0.5 else text)
            parts.append(rng.choices(vocabulary, k=rng.randrange(8)))
        docs.append((d, "... ".join(" ".join(p).title() for p in parts)))
    got = check(spark, docs, items)
    assert 0 < sum(r[5] for r in got) <= len(got)


def test_odd_rows(spark):
    text = "The quick brown fox, jumps over the lazy dog; twice a day"
    odd = [(1, text), (1, text), (2, None), (3, ""), (4, " \t\n"), (None, text), (None, None), (5, "x"), (6, "Ünï 日本語 😀 ünï 日本語")]
    long_text = " ".join(f"a{i % 9973}" for i in range(150_000)) + " " + text + " " + "z" * 3_000_000
    odd.append((7, long_text))
    items = [(10, text), (10, "x"), (11, text.upper()), (None, "日本語 😀"), (12, None), (13, ""), (14, "-- !"), (9, "lazy dog")]
    got = {r[0]: r for r in check(spark, odd, items)}
    assert got[7][2] == 12 and got[7][3] == 3
    assert got[6][2] == 2 and got[6][3] == 0 and got[6][5]
    assert check(spark, odd, []) and check(spark, [], items) == []


def test_windows_that_many_items_and_texts_share(spark):
    shared = " ".join(f"s{i}" for i in range(14))
    items = [(i, f"{shared} own{i} more{i}") for i in range(30)]
    docs = [(i, f"begin{i} {shared} end{i}") for i in range(200)] + [(900 + i, f"{shared} own{i} more{i}") for i in range(30)]
    got = check(spark, docs, items)
    assert {r[3] for r in got} == {30}


def test_other_window(spark):
    items = [(1, "a b c d e f g h"), (2, "a b")]
    check(spark, [(1, "x a b c d x"), (2, "a b c"), (3, "f g h")], items, window=3)


def test_words_in_slices():
    """Slices of any size give the same words and hashes."""
    rng = random.Random(2)
    texts = ["".join(rng.choices("aB0 é日-\n", k=rng.randrange(40))) for _ in range(300)] + ["", "x" * 50, "A"]
    column = pa.array(texts)
    data = np.frombuffer("".join(texts).encode(), np.uint8)
    offsets = np.cumsum([0] + [len(t.encode()) for t in texts])
    whole = words.words_of(data, offsets)
    for i, text in enumerate(texts):
        got = [whole.text(j, j + 1).decode() for j in range(whole.firsts[i], whole.firsts[i + 1])]
        assert got == WORD.findall(lower(text))
    by_hash = {}
    for j, h in enumerate(whole.hashes.tolist()):
        by_hash.setdefault(h, set()).add(whole.text(j, j + 1))
    assert all(len(v) == 1 for v in by_hash.values())
    assert len({next(iter(v)) for v in by_hash.values()}) == len(by_hash)
    small, parts = words.SLICE_BYTES, []
    try:
        words.SLICE_BYTES = 64
        parts = list(words.slices(column.slice(5)))
    finally:
        words.SLICE_BYTES = small
    assert np.array_equal(np.concatenate([p.hashes for _, _, p in parts]), whole.hashes[whole.firsts[5] :])
    assert [p[:2] for p in parts][-1][1] == len(texts) - 5
