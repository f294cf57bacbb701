from __future__ import annotations

import pytest
from pyspark.sql import functions as F

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def sf_dir():
    return SF_DIR


@pytest.fixture(scope="session")
def corpus(spark):
    rows = spark.read.parquet(f"{SF_DIR}/documents.parquet").select("doc_id", "text").collect()
    return {r["doc_id"]: r["text"] for r in rows}


#: Null ids and texts, empty, white, repeated and odd texts; a long one is added by ``odd``.
ODD = [
    (1, "one two three four five"),
    (1, "one two three four five"),
    (2, None),
    (3, ""),
    (4, " \t\n "),
    (None, "a text without an id"),
    (None, None),
    (5, "one two three four five"),
    (6, "日本語 and 😀 emoji\nnext line"),
    (7, "x"),
]


@pytest.fixture(scope="session")
def odd(spark):
    long_text = " ".join(f"w{i % 997}x{i}" for i in range(30_000))
    rows = spark.createDataFrame([*ODD, (8, long_text)], "doc_id long, text string")
    return with_clashes(rows)


def with_clashes(df):
    """Extra columns named like those that operators use inside or give out."""
    names = "row size key n fp part shard slot seed doc pos ids n_tokens component_id group added own length cell _spans range host".split()
    return df.select("*", *(F.lit("clash").alias(n) for n in names))
