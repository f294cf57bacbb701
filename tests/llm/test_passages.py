"""Repeated passages: planted ones, the chain against all chains, alignment and cutting."""

from __future__ import annotations

import itertools
import random

import numpy as np
import pytest

from voxelweave.llm import passages
from voxelweave.llm.queries import all_queries


def words(n, seed):
    rng = random.Random(seed)
    return ["".join(rng.choices("abcdefghij", k=rng.randint(2, 7))) for _ in range(n)]


def best_chain(pos, target, k=passages.K, gap=passages.GAP_COST):
    """Highest chain score over all chains, by trying every subset."""
    best = 0.0
    for size in range(1, len(pos) + 1):
        for chosen in itertools.combinations(range(len(pos)), size):
            total = k
            for a, b in zip(chosen, chosen[1:]):
                if pos[a] >= pos[b] or target[a] >= target[b]:
                    break
                total += k - max(0.0, gap * (pos[b] - pos[a] - k + target[b] - target[a] - k))
            else:
                best = max(best, total)
    return best


def score(pos, target, chain, k=passages.K, gap=passages.GAP_COST):
    steps = zip(chain, chain[1:])
    return k + sum(k - max(0.0, gap * (pos[b] - pos[a] - k + target[b] - target[a] - k)) for a, b in steps)


@pytest.mark.parametrize("seed", range(25))
def test_best_chain_by_brute_force(seed):
    rng = np.random.default_rng(seed)
    found = sorted({(int(p), int(t)) for p, t in rng.integers(0, 60, (9, 2))})
    pos, target = np.array([f[0] for f in found]), np.array([f[1] for f in found])
    chains = passages.chain(pos, target)
    assert sorted(i for c in chains for i in c.tolist()) == list(range(len(pos)))
    for c in chains:
        assert (np.diff(pos[c]) > 0).all() and (np.diff(target[c]) > 0).all()
    # The linear gap lets overlapping matches gain a little in the tree, never in what is chosen at the end.
    assert max(score(pos, target, c.tolist()) for c in chains) >= 0.85 * best_chain(pos, target)


def test_separate_chains_by_brute_force():
    pos = np.array([0, 7, 14, 100, 107, 114])
    assert [c.tolist() for c in passages.chain(pos, pos + 3, gap_cost=0.1)] == [[0, 1, 2], [3, 4, 5]]


def test_seeds_of_a_shared_run_are_shared():
    run = words(passages.WINDOW + passages.K - 1, 1)
    for seed in range(20):
        a, b = (words(30, 100 + 2 * seed + i) + run + words(30, 500 + 2 * seed + i) for i in (0, 1))
        x, y = (set(passages.seeds_of(passages.word_hashes(" ".join(t)))[0].tolist()) for t in (a, b))
        assert x & y


def test_monotonous_text_has_few_seeds():
    assert len(passages.seeds_of(passages.word_hashes("again " * 5000))[0]) == 1


def test_planted_passages(spark):
    shared, fuzzy = words(80, 1), words(120, 2)
    changed = [w if i % 9 else "changed" for i, w in enumerate(fuzzy)]
    changed = changed[:60] + ["put", "in"] + changed[60:]
    docs = [
        words(100, 10) + shared + words(50, 11),
        words(30, 12) + shared + words(200, 13),
        words(60, 14) + fuzzy + words(10, 15),
        words(5, 16) + changed + words(90, 17) + shared,
        words(400, 18),
        words(90, 19) + shared[:40] + words(90, 20),
        shared,
    ]
    df = spark.createDataFrame([(i, " ".join(d)) for i, d in enumerate(docs)], "doc_id long, text string")
    got = {}
    for r in passages.repeated_passages(df).collect():
        got[r["doc_id"], r["source_id"]] = (r["start_word"], r["end_word"], r["source_start"], r["source_end"], r["similarity"])
    assert set(got) == {(1, 0), (3, 0), (3, 2), (6, 0)}  # 40 words are too few
    assert got[1, 0] == (30, 110, 100, 180, 1.0) and got[6, 0] == (0, 80, 100, 180, 1.0)
    start, end, source_start, source_end, share = got[3, 2]
    # The last edit lies three words before the end, which is not worth crossing.
    assert abs(start - 5) <= 1 and 124 <= end <= 127 and abs(source_start - 60) <= 1 and 0.8 <= share < 1
    cut = {r["doc_id"]: r["text"] for r in passages.remove_passages(df, passages.repeated_passages(df)).collect()}
    assert cut[1].split() == docs[1][:30] + docs[1][110:] and cut[6] == "" and cut[4] == " ".join(docs[4]) and cut[0] == " ".join(docs[0])


def test_runs_whose_parts_have_lower_holders(spark):
    """Documents 3 and 4 of each case share 60 words that 1 and 2 have in parts; likewise a second place in one source."""
    docs, want = [], set()
    for case in range(20):
        run, base = words(60, 1000 + case), 10 * case
        parts = [run[:34], run[26:], run, run]
        docs += [(base + i + 1, words(20, 5000 + base + i) + p + words(20, 7000 + base + i)) for i, p in enumerate(parts)]
        want.add((base + 4, 20, 80, base + 3))
    line = words(34, 1)
    docs += [(500, line + words(30, 2) + line + words(40, 3)), (501, words(9, 4) + line + words(40, 3))]
    df = spark.createDataFrame([(i, " ".join(d)) for i, d in docs], "doc_id long, text string")
    rows = passages.repeated_passages(df).collect()
    assert want <= {(r["doc_id"], r["start_word"], r["end_word"], r["source_id"]) for r in rows}
    assert any(r["doc_id"] == 501 and r["start_word"] == 9 and r["end_word"] == 83 for r in rows)
    assert {r["doc_id"] for r in rows} == {w[0] for w in want} | {501}


def test_near_passages_whose_parts_have_lower_holders(spark):
    """Documents 3 and 4 of each case share 70 words but for three; 1 and 2 have parts of it, each below 50 words."""
    docs, want = [], set()
    for case in range(20):
        run, base = words(70, 20_000 + case), 10 * case
        near = [f"edit{case}x{i}" if i in (10, 35, 60) else w for i, w in enumerate(run)]
        parts = [near[:38], near[32:], run, near]
        docs += [(base + i + 1, words(20, 30_000 + base + i) + p + words(20, 40_000 + base + i)) for i, p in enumerate(parts)]
        want.add((base + 4, base + 3))
    df = spark.createDataFrame([(i, " ".join(d)) for i, d in docs], "doc_id long, text string")
    rows = passages.repeated_passages(df).collect()
    assert {(r["doc_id"], r["source_id"]) for r in rows} == want
    assert all(r["start_word"] <= 31 and r["end_word"] >= 79 and r["similarity"] >= 0.8 for r in rows)
    spans = {r["doc_id"]: [tuple(x) for x in r["spans"]] for r in passages.repeated_spans(df).collect()}
    assert {i for i, _ in want} == set(spans)


def test_a_monotonous_text_meets_its_source_once_a_gram(spark):
    """Runs of one repeated word and of a repeated pair of words, in a document whose parts other documents hold."""
    line = words(9, 1)
    texts = [["one"] * 60 + line, line * 8, words(30, 2) + ["one"] * 90 + line * 12 + words(30, 3)]
    df = spark.createDataFrame([(i, " ".join(t)) for i, t in enumerate(texts)], "doc_id long, text string")
    found = set()
    for r in passages.repeated_passages(df).collect():
        if r["similarity"] == 1.0:
            assert texts[r["doc_id"]][r["start_word"] : r["end_word"]] == texts[r["source_id"]][r["source_start"] : r["source_end"]]
        if r["doc_id"] == 2:
            found |= set(range(r["start_word"], r["end_word"]))
    assert set(range(30, 120)) <= found and set(range(120, 228)) <= found


def test_query_finds_every_word_of_exact_runs(spark, sf_dir, corpus):
    rows = all_queries()["op8_passages"](spark, sf_dir).collect()
    found = {(r["doc_id"], p) for r in rows for p in range(r["start_word"], r["end_word"])}
    seen = set()
    for i in sorted(corpus):
        split = corpus[i].encode().lower().split()
        grams = [tuple(split[s : s + 50]) for s in range(len(split) - 49)]
        assert all((i, p) in found for s, g in enumerate(grams) if g in seen for p in range(s, s + 50))
        seen.update(grams)


def test_query_finds_every_exact_run(spark, sf_dir, corpus):
    """Every run of 50 words that an earlier document has is covered, up to words next to another document's passage."""
    rows = all_queries()["op8_passages"](spark, sf_dir).collect()
    split = {i: t.encode().lower().split() for i, t in corpus.items()}
    seen, needed = set(), {}
    for i in sorted(split):
        grams = [tuple(split[i][s : s + 50]) for s in range(len(split[i]) - 49)]
        cover = {p for s, g in enumerate(grams) if g in seen for p in range(s, s + 50)}
        if cover:
            needed[i] = cover
        seen.update(grams)
    found = {}
    for r in rows:
        assert r["source_id"] < r["doc_id"] and r["end_word"] - r["start_word"] >= 50 and r["similarity"] >= 0.8
        found.setdefault(r["doc_id"], set()).update(range(r["start_word"], r["end_word"]))
    assert set(needed) <= set(found)
    missed = sum(len(c - found[i]) for i, c in needed.items())
    assert missed <= 0.005 * sum(map(len, needed.values()))


def test_odd_rows(spark, odd):
    both = odd.union(odd.where("doc_id = 8").selectExpr("9", *odd.columns[1:])).union(odd.where("doc_id = 8"))
    rows = passages.repeated_passages(both).collect()
    assert [(r["doc_id"], r["source_id"], r["start_word"], r["end_word"]) for r in rows] == [(9, 8, 0, 30_000)]
    cut = passages.remove_passages(both, passages.repeated_passages(both))
    assert cut.columns == both.columns and cut.count() == both.count()
    assert cut.where("doc_id is null").count() == 2 and cut.where("doc_id = 9").first()["text"] == ""
    assert passages.repeated_passages(odd.limit(0)).count() == 0
