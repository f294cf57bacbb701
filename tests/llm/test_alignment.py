"""Aligned tokens of two tokenizers against plain Python over whole texts; the minimal perfect hash; odd rows."""

from __future__ import annotations

import hashlib
import random
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tests.llm.conftest import with_clashes
from voxelweave.llm import alignment
from voxelweave.llm.minimal_hash import HashedTable, MinimalHash
from voxelweave.llm.queries import all_queries

PATHS = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
A = Tokenizer.from_file(PATHS[0])
A.encode_special_tokens = True
B = sentencepiece.SentencePieceProcessor(model_file=PATHS[1])
FROM_CHAR = alignment._byte_values()


def tokens(text):
    """Ids and byte strings of both sides, or nothing."""
    if not text:
        return None
    a = A.encode(" " + text, add_special_tokens=False)
    a_bytes = [bytes(FROM_CHAR[c] for c in t) for t in a.tokens]
    b = B.encode(text)
    b_bytes = [bytes([int(B.id_to_piece(i)[3:5], 16)]) if B.is_byte(i) else B.id_to_piece(i).replace("▁", " ").encode() for i in b]
    whole = (" " + text).encode()
    return (a.ids, a_bytes, b, b_bytes) if b"".join(a_bytes) == whole == b"".join(b_bytes) else None


def groups_of(text):
    found = tokens(text)
    if found is None:
        return None
    a, a_bytes, b, b_bytes = found
    a_ends, b_ends = np.cumsum(list(map(len, a_bytes))), np.cumsum(list(map(len, b_bytes)))
    ends = sorted(set(a_ends.tolist()) & set(b_ends.tolist()))
    out = [([], []) for _ in ends]
    for side, (ids, places) in enumerate(((a, a_ends), (b, b_ends))):
        for i, g in zip(ids, np.searchsorted(ends, places)):
            out[g][side].append(i)
    return out


def plain(rows):
    aligned = [(d, groups_of(t)) for d, t in rows]
    counts = Counter()
    for _, groups in aligned:
        counts.update({(x, y) for a, b in groups or [] for x in a for y in b})
    most = Counter()
    for (x, _), n in counts.items():
        most[x] = max(most[x], n)
    out = []
    for doc, groups in aligned:
        links = [(x, y) for a, b in groups or [] for x in a for y in b]
        text = ";".join(",".join(map(str, a)) + "|" + ",".join(map(str, b)) for a, b in groups or [])
        sizes = [sum(len(g[i]) for g in groups or []) for i in (0, 1)]
        best = sum(counts[p] == most[p[0]] for p in links)
        sha = hashlib.sha256(text.encode()).hexdigest() if groups else ""
        out.append((doc, *sizes, len(groups or []), len(links), best, sum(counts[p] for p in links), sha, text))
    return out, counts


COLUMNS = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]


def order(row):
    return (row[0] is not None, row[0] or 0, *row[1:])


def test_query(spark, sf_dir, corpus):
    rows = all_queries()["op11_alignment"](spark, sf_dir)
    assert rows.columns == COLUMNS
    want, _ = plain(corpus.items())
    assert sorted(map(tuple, rows.collect())) == sorted(r[:-1] for r in want)


@pytest.mark.parametrize("hot", [0, 40, 1 << 19])
def test_rare_pairs_are_joined(spark, corpus, hot):
    """Any size of the table that workers hold gives the same sums."""
    rows = list(corpus.items())[:60] + list(corpus.items())[:9]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = alignment.align_documents(docs, *PATHS, outputs=("groups_sha256", "groups"), hot=hot)
    want, _ = plain(rows)
    assert sorted(map(tuple, got.collect())) == sorted(want)


ODD_TEXTS = [
    None, "", " ", "  ", "\n", " a", "a ", "a  b", "a \n b", "\ta", "x y z　w", "don't can’t I'll", "a▁b", "▁", "日本語 テキスト です",
    "😀 👩‍👩‍👧 é", "<|endoftext|> <s> </s> <unk> <0x41>", "\x00 \x01", "a​ b", "a ́b", "=" * 3000, "ab" * 900, "  x ᠎ y", "é" * 99,
    "1234567890 " * 40, "  indented\n\n   more   spaces   ", "\x85 x\x85 y", "  a  b", "a\x1f b", "a \x1cb",
]


def test_odd_rows(spark):
    rng = random.Random(4)
    alphabet = ["a", "the", " ", " ", "  ", "\n", "'s", "日", "😀", "9", ".", "▁", "é", " ", "​", "<s>", "\t", "ing"]
    rows = [(i, t) for i, t in enumerate(ODD_TEXTS)] + [(None, "a null id"), (None, None), (3, "again"), (3, "again")]
    rows += [(100 + i, "".join(rng.choices(alphabet, k=rng.randrange(1, 30)))) for i in range(300)]
    rows.append((999, " ".join(f"w{i % 5003}é{i}" for i in range(60_000))))
    docs = with_clashes(spark.createDataFrame(rows, "doc_id long, text string"))
    got = alignment.align_documents(docs, *PATHS, outputs=("groups_sha256", "groups")).collect()
    want, _ = plain(rows)
    assert sorted(map(tuple, got), key=order) == sorted(want, key=order)
    empty = alignment.align_documents(docs.limit(0), *PATHS)
    assert empty.count() == 0 and "groups" in empty.columns


def test_small_parts_and_other_tokenizer_paths(corpus, monkeypatch):
    """Parts of any size, the library in place of ranks, and long groups give the same groups and links."""
    texts = [*list(corpus.values())[:40], *(t or "" for t in ODD_TEXTS), "=" * 3000 + "a"]
    aligner = alignment.Aligner(*PATHS)
    assert aligner.a.fast is not None and aligner.cuts
    for size, short, fast in ((1 << 18, 1 << 10, True), (50, 4, True), (2000, 1 << 10, False)):
        monkeypatch.setattr(alignment, "SLICE", size)
        monkeypatch.setattr(alignment, "SHORT", short)
        monkeypatch.setattr(alignment, "STORE", 96 << 20 if fast and size > 50 else 4000)
        if not fast:
            aligner.a.fast = None
        aligner.clear()
        got = {row: [b"", Counter(), False] for row in range(len(texts))}
        for lo, hi, _, docs, units in aligner.slices(texts):
            bad = aligner.failed(docs, units, hi - lo)
            pairs, times, of = aligner.links(units)
            for doc, unit in zip(docs.tolist(), units.tolist()):
                got[lo + doc][0] += aligner.groups[unit]
                got[lo + doc][2] |= bool(bad[doc])
            for pair, n, at in zip(pairs.tolist(), times.tolist(), of.tolist()):
                got[lo + docs[at]][1][divmod(pair, aligner.pieces)] += n
        got = {row: ("", Counter()) if failed else (shown.decode()[:-1], links) for row, (shown, links, failed) in got.items()}
        assert sorted(got) == list(range(len(texts)))
        for row, text in enumerate(texts):
            groups = groups_of(text) or []
            want = ";".join(",".join(map(str, a)) + "|" + ",".join(map(str, b)) for a, b in groups)
            assert got[row] == (want, Counter((x, y) for a, b in groups for x in a for y in b)), text[:50]


def test_pair_counts(spark, corpus, monkeypatch):
    """Many buckets and several levels of the tree."""
    rows = list(corpus.items())[:80]
    monkeypatch.setattr(alignment, "BUCKET", 300)
    monkeypatch.setattr(alignment, "PART_ROWS", 40)
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(40)
    got = alignment.pair_counts(docs, *PATHS).collect()
    _, counts = plain(rows)
    assert {(r["a"], r["b"]): r["docs"] for r in got} == dict(counts)
    most = {}
    for (a, _), n in counts.items():
        most[a] = max(most.get(a, 0), n)
    assert all(r["best"] == (r["docs"] == most[r["a"]]) and r["pair"] == r["a"] * B.get_piece_size() + r["b"] for r in got)
    others = alignment.align_documents(docs.limit(5), *PATHS, counts=alignment.pair_counts(docs.where(F.col("doc_id") > 10), *PATHS))
    assert others.count() == 5


def test_minimal_hash():
    rng = np.random.default_rng(5)
    for n in (0, 1, 2, 9, 5000):
        keys = np.unique(rng.integers(-(1 << 62), 1 << 62, n))
        hashed = MinimalHash.of(keys)
        assert sorted(hashed.numbers(keys).tolist()) == list(range(len(keys)))
        again = MinimalHash.unpacked(hashed.packed())
        assert np.array_equal(again.numbers(keys), hashed.numbers(keys))
        table = HashedTable(keys, keys * 3)
        at, known = table.find(np.concatenate([keys, keys + 1]))
        assert known[: len(keys)].all() and (table.values[0][at[: len(keys)]] == keys * 3).all()
        assert not known[len(keys) :][~np.isin(keys + 1, keys)].any()
    with pytest.raises(ValueError):
        MinimalHash.of(np.array([1, 1]))
