"""From raw documents to packed training sequences.

Stages: reject low-grade and toxic documents, keep one document of each near-duplicate group, cut repeated passages out of
later documents, pack what is left. Each stage reads the Parquet that the one before it wrote.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from voxelweave.llm import grading, jaccard, packing, passages
from voxelweave.llm.common import scratch, table, unused, written


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose top grade is likely; rows are judged one by one, so repeated ones share their fate.

    Null and empty texts are judged as empty ones; null ids stay; without labels or documents the result is as
    :func:`grading.train` and :func:`grading.keep_good` state.
    """
    model = grading.train(docs, grading.corpus_ratings(table(spark, sf_dir, "labels")))
    return grading.keep_good(docs, model)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of the smallest id of each group of near duplicates; documents without an id stay.

    Links are pairs of texts whose sets of five-word shingles are 0.8 alike or more (Jaccard), among all pairs of a
    component of op7's fingerprints and all that share a band of minima (:mod:`jaccard`); texts without words are alike (null as empty). An id with several texts is a document per text. Of rows equal in id and text the
    first in the order of all other columns stays.
    """
    node, first = unused("_node", docs), unused("_first", docs)
    text = F.coalesce("text", F.lit(""))
    hashed = F.xxhash64(text)
    with scratch(spark) as keep:
        found = docs.where("doc_id is not null").select("doc_id", hashed.alias("node"), text.alias("text"))
        firsts = written(found.groupBy("node").agg(F.min("doc_id").alias("doc_id"), F.any_value("text").alias("text")), "distinct-texts")
        roots = jaccard.groups(firsts.select("node", "text"))
        placed = firsts.join(roots, "node", "left").select("node", "doc_id", F.coalesce("root", "node").alias("root"))
        low = F.min(F.struct("doc_id", "node")).alias("low")
        kept = keep(placed.groupBy("root").agg(low).select("low.doc_id", F.col("low.node").alias(node)), "kept-ids")
    once = docs.withColumn(node, hashed).join(kept, ["doc_id", node], "left_semi")
    others = [c for c in docs.columns if c not in ("doc_id", "text")]
    row = F.struct("text", *others)
    once = once.groupBy("doc_id", node).agg(F.min(row).alias(first)).select("doc_id", f"{first}.*")
    return once.select(*docs.columns).unionByName(docs.where("doc_id is null"))


def passage_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the passages that a document of smaller id has as well; no row goes.

    Null ids and texts are left alone; see :func:`passages.repeated_spans` for repeated rows and ids.
    """
    with scratch(spark) as keep:
        found = keep(passages.repeated_spans(docs), "passages")
    cut = passages.remove_spans(docs, found)
    return cut.withColumn("n_chars", F.char_length("text").cast(docs.schema["n_chars"].dataType)).select(*docs.columns)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of token sequences; a null text is an empty one, every row is packed (see :func:`packing.pack`)."""
    return packing.pack(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [("quality", quality), ("near_dedup", near_dedup), ("passage_dedup", passage_dedup), ("packing", pack)]
#: Regression, spanning forests and alignment have no SQL form; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        with scratch(spark) as keep:
            docs = keep(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
