"""The pipeline: columns, effect of every stage, and small cases by brute force."""

from __future__ import annotations

import random
from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from voxelweave.llm import jaccard
from voxelweave.llm.common import scratch, shared_folder, table, written
from voxelweave.llm.queries import all_oracles, all_queries


@pytest.fixture(scope="module")
def stages(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    out = [docs]
    for name, stage in corpus_pipeline.STAGES:
        docs = written(stage(spark, docs, sf_dir), name)
        out.append(docs)
    return out


def test_columns_and_effects(stages):
    raw, good, once, cut, packed = stages
    assert raw.columns == good.columns == once.columns == cut.columns
    counts = [s.count() for s in stages[:-1]]
    assert counts[0] > counts[1] > counts[2] == counts[3]
    assert cut.where(F.col("n_chars") != F.char_length("text")).count() == 0
    assert packed.select("doc_id").distinct().count() == counts[3]


def test_clean_documents_are_kept(spark, sf_dir, stages):
    labels = table(spark, sf_dir, "labels")
    clean = labels.where("quality = 1 and toxic = 0")
    lost = clean.join(stages[1], "doc_id", "left_anti").count()
    assert lost <= 0.02 * clean.count()
    assert labels.where("quality = 0").join(stages[1], "doc_id", "left_semi").count() <= 0.2 * labels.where("quality = 0").count()


def shingle_sets(rows):
    split = [t.encode().lower().split() for _, t in rows]
    return [{tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} for w in split]


def first_ids(rows):
    """Lowest ids of the groups that pairs at a Jaccard likeness of 0.8 make; ``rows`` are (id, text), in order."""
    sets, name, holders = shingle_sets(rows), {}, {}
    for i, s in enumerate(sets):
        for x in s:
            holders.setdefault(x, []).append(i)
    links = {i: set() for i in range(len(rows))}
    for i, s in enumerate(sets):
        for j in {j for x in s for j in holders[x] if j < i}:
            if len(s & sets[j]) >= 0.8 * len(s | sets[j]):
                links[i].add(j)
                links[j].add(i)
    for i in range(len(rows)):
        todo = [i]
        while todo:
            at = todo.pop()
            if at not in name:
                name[at] = rows[i][0]
                todo += links[at]
    return set(name.values())


def test_one_of_each_near_duplicate_group(stages):
    rows = sorted((r["doc_id"], r["text"] or "") for r in stages[1].select("doc_id", "text").collect())
    assert {r["doc_id"] for r in stages[2].select("doc_id").collect()} == first_ids(rows)


def test_near_duplicates_by_brute_force(spark):
    """Raw documents of sf0.01 against all pairs at a Jaccard likeness of 0.8 over five-word shingles."""
    docs = table(spark, "/root/testdata/sf0.01", "documents").where("doc_id is not null and text is not null")
    rows = sorted((r["doc_id"], r["text"]) for r in docs.select("doc_id", "text").collect())
    kept = corpus_pipeline.near_dedup(spark, docs, "").select("doc_id").collect()
    assert sorted(r["doc_id"] for r in kept) == sorted(first_ids(rows))


def test_long_runs_are_dealt_in_blocks(spark, monkeypatch):
    """A large group of near copies, most of them under 0.8 to each other, in runs of a few rows."""
    rng = random.Random(6)
    base = [f"w{i}" for i in range(120)]
    rows = []
    for i in range(150):
        words = list(base)
        for at in rng.sample(range(120), rng.choice([1, 2, 3, 4])):
            words[at] = f"x{i}y{at}"
        rows.append((i, " ".join(words)))
    monkeypatch.setattr(jaccard, "RUN_LIMIT", 10)
    schema = table(spark, "/root/testdata/sf0.001", "documents").schema
    docs = spark.createDataFrame([(i, t, "en", "s", 1) for i, t in rows], schema)
    kept = corpus_pipeline.near_dedup(spark, docs, "").select("doc_id").collect()
    assert sorted(r["doc_id"] for r in kept) == sorted(first_ids(rows))


def test_near_duplicates_come_by_fingerprints(spark, monkeypatch):
    """Without any common band, the fingerprints alone find a near copy; pairs of fingerprints pass the exact check as well."""
    sharing = jaccard._sharing
    monkeypatch.setattr(jaccard, "_sharing", lambda sketched: sharing(sketched).limit(0))
    base = [f"w{i}" for i in range(2000)]
    texts = [base, [*base[:200], "other", *base[201:]], [f"v{i}" for i in range(400)]]
    schema = table(spark, "/root/testdata/sf0.001", "documents").schema
    docs = spark.createDataFrame([(i + 1, " ".join(t), "en", "s", 1) for i, t in enumerate(texts)], schema)
    assert sorted(r["doc_id"] for r in corpus_pipeline.near_dedup(spark, docs, "").select("doc_id").collect()) == [1, 3]
    nodes = [r["node"] for r in docs.orderBy("doc_id").select(F.xxhash64("text").alias("node")).collect()]
    monkeypatch.setattr(jaccard, "_marked_alike", lambda texts: spark.createDataFrame([(nodes[0], nodes[2])], "a long, b long"))
    assert corpus_pipeline.near_dedup(spark, docs, "").count() == 3


def test_all_texts_of_near_fingerprints_are_compared(spark, monkeypatch):
    """Two near copies in the component of a third text that is not 0.8 like either, without any common band."""
    sharing = jaccard._sharing
    monkeypatch.setattr(jaccard, "_sharing", lambda sketched: sharing(sketched).limit(0))
    base = [f"w406a{i}" for i in range(300)]
    near = [*base[:255], *(f"x{i}" for i in range(45))]
    rows = [(i + 1, " ".join(t)) for i, t in enumerate([base, near, [*near[:100], "other", *near[101:]]])]
    sets = shingle_sets(rows)
    assert [len(sets[i] & sets[j]) >= 0.8 * len(sets[i] | sets[j]) for i, j in ((0, 1), (0, 2), (1, 2))] == [False, False, True]
    schema = table(spark, "/root/testdata/sf0.001", "documents").schema
    docs = spark.createDataFrame([(*r, "en", "s", 1) for r in rows], schema)
    texts = docs.select(F.xxhash64("text").alias("node"), "text")
    marked = jaccard._marked_alike(texts).collect()
    assert len(marked) == 2 and {r["a"] for r in marked} == {texts.first()["node"]}
    kept = corpus_pipeline.near_dedup(spark, docs, "").select("doc_id").collect()
    assert sorted(r["doc_id"] for r in kept) == sorted(first_ids(rows)) == [1, 2]


def test_scratch_tables_go(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").where("doc_id < 40")
    with scratch(spark) as keep:
        inner = written(docs.select("doc_id"), "inner")
        outer = keep(inner, "outer")
        assert inner.count() == 40
    assert outer.count() == 40
    with pytest.raises(Exception):
        inner.count()


def test_one_id_with_two_texts_and_clashing_names(spark, sf_dir):
    """Each text of an id is cut by its own passages, whatever the order of rows and the names of other columns."""
    docs = table(spark, sf_dir, "documents")
    shared = [f"s{i}" for i in range(70)]
    texts = [(1, shared), (5, ["a", "b", *shared]), (5, [f"t{i}" for i in range(90)]), (5, ["c"]), (6, [f"t{i}" for i in range(80)])]
    rows = [(i, " ".join(w), "en", "s", 1) for i, w in texts]
    for order in (rows, rows[::-1]):
        odd = spark.createDataFrame(order, docs.schema)
        for name in ("_text_node", "_node", "_First", "_spans", "_text_hash", "doc", "root", "row"):
            odd = odd.withColumn(name, F.lit("clash"))
        once = corpus_pipeline.near_dedup(spark, odd, sf_dir)
        assert once.columns == odd.columns
        cut = corpus_pipeline.passage_dedup(spark, written(odd, "odd"), sf_dir)
        got = sorted((r["doc_id"], r["text"]) for r in cut.collect())
        assert cut.columns == odd.columns and len(got) == 5
        assert (1, " ".join(shared)) in got and (5, "a b ") in got and (5, "c") in got
        assert sum("t79" in t for _, t in got) == 1


def test_near_duplicates_beyond_the_lowest_and_ids_with_two_texts(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    base = [f"w{i}" for i in range(200)]
    steps = [base[:], base[:176] + [f"x{i}" for i in range(24)], base[:152] + [f"x{i}" for i in range(24)] + [f"y{i}" for i in range(24)]]
    rows = [(i + 1, " ".join(t), "en", "s", 1) for i, t in enumerate(steps)]
    rows += [(9, "one text of an id", "en", "s", 1), (9, "quite another text with the same id", "en", "s", 1)]
    kept = corpus_pipeline.near_dedup(spark, spark.createDataFrame(rows, docs.schema), sf_dir).collect()
    sets = shingle_sets([r[:2] for r in rows])
    alike = [len(sets[i] & sets[i + 1]) / len(sets[i] | sets[i + 1]) for i in range(2)]
    want = [1] + [i + 2 for i in range(2) if alike[i] < 0.8]
    assert sorted(r["doc_id"] for r in kept) == want + [9, 9]


def test_run_equals_the_stages(spark, sf_dir, stages):
    key = ["doc_id", "start", "length", "ids_crc32", "doc_tokens"]
    run = {tuple(r) for r in all_queries()["pipeline"](spark, sf_dir).select("doc_id", "doc_tokens").collect()}
    assert run == {tuple(r) for r in stages[-1].select("doc_id", "doc_tokens").collect()}
    assert set(key) <= set(stages[-1].columns)
    assert set(all_oracles()) <= set(all_queries())


def test_odd_tables(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    text = docs.where("doc_id = 1").first()["text"]
    rows = [(1, text, "en", "s", 1), (1, text, "en", "s", 1), (2, text, "en", "s", 1), (None, text, None, None, None), (3, None, None, None, None)]
    odd = spark.createDataFrame(rows, docs.schema).withColumn("row", F.lit("clash"))
    for name, stage in corpus_pipeline.STAGES[1:3]:
        out = stage(spark, odd, sf_dir)
        assert out.columns == odd.columns, name
    once = corpus_pipeline.near_dedup(spark, odd, sf_dir).select("doc_id").collect()
    assert sorted((r["doc_id"] for r in once), key=str) == [1, 3, None]
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs.limit(0), sf_dir).count() == 0


def test_shared_folder_comes_from_the_session(spark):
    def session(folder, master):
        context = SimpleNamespace(getCheckpointDir=lambda: None, master=master)
        return SimpleNamespace(conf=SimpleNamespace(get=lambda key, default: folder), sparkContext=context)

    assert shared_folder(session("file:///shared/x/", "spark://host:7077")) == "file:///shared/x"
    with pytest.raises(ValueError):
        shared_folder(session(None, "spark://host:7077"))
    assert shared_folder(spark)
