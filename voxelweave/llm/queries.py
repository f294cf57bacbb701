"""The registered corpus queries, with production parameters over whole tables, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import corpus_pipeline
from voxelweave.llm import alignment, decontamination, encoding, fingerprints, grading, neighbours, packing, passages, sharding
from voxelweave.llm import simhash, token_counts, whitening, wrappers
from voxelweave.llm.common import table

PIECES, WORDS, BYTES = "piece_bpe_32k.model", "word_bpe_49k.json", "byte_bpe_50k.json"


def op1_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    outputs = ("n_tokens", "ids_sha256", "decoded_sha256", "spans_crc32")
    return encoding.encode(table(spark, sf_dir, "documents"), public_tokenizers.path(PIECES), outputs=outputs)


def op2_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.token_counts(table(spark, sf_dir, "documents"), public_tokenizers.path(PIECES))


def op3_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard_documents(table(spark, sf_dir, "documents"), shards=24)


def op4_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = grading.train(docs, grading.corpus_ratings(table(spark, sf_dir, "labels")))
    return grading.grade_documents(docs, model)


def op5_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return wrappers.main_text(table(spark, sf_dir, "pages"))


def op6_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), public_tokenizers.path(WORDS))


def op7_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"), width=4, max_bits=4)


def op8_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return passages.repeated_passages(table(spark, sf_dir, "documents"), min_words=50, similarity=0.8)


def op9_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neighbours.search(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0, k=10)


def op10_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.fingerprint_documents(table(spark, sf_dir, "documents"))


def op11_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    paths = public_tokenizers.path(BYTES), public_tokenizers.path(PIECES)
    return alignment.align_documents(table(spark, sf_dir, "documents"), *paths, outputs=("groups_sha256",))


def op12_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontamination.decontaminate(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), window=10)


def op13_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(table(spark, sf_dir, "embeddings"), components=32)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_sentencepiece": op1_sentencepiece,
    "op2_token_counts": op2_token_counts,
    "op3_sharding": op3_sharding,
    "op4_quality": op4_quality,
    "op5_main_text": op5_main_text,
    "op6_packing": op6_packing,
    "op7_simhash": op7_simhash,
    "op8_passages": op8_passages,
    "op9_neighbours": op9_neighbours,
    "op10_fingerprints": op10_fingerprints,
    "op11_alignment": op11_alignment,
    "op12_decontamination": op12_decontamination,
    "op13_whitening": op13_whitening,
}
ORACLES: dict[str, str] = {"op12_decontamination": decontamination.ORACLE}


def all_queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    pipeline = {"pipeline": corpus_pipeline.run} if corpus_pipeline.STAGES else {}
    return QUERIES | pipeline


def all_oracles() -> dict[str, str]:
    sql = {"pipeline": corpus_pipeline.ORACLE_SQL} if corpus_pipeline.ORACLE_SQL else {}
    return ORACLES | sql
