"""Every registered query against its SQL on the smallest tables."""

from __future__ import annotations

import pytest

import __spark_entry__ as entry
from tests.compare import differences, oracle_connection

SF_DIR = entry.SMOKE_DIR
QUERIES, ORACLES = entry.queries(), entry.oracle_sql()
# Run on the next larger tables (the smallest volume is smaller than one block step).
LARGER_DIR = "/root/testdata/sf0.01"
LARGER = {"reg_affine", "reg_deformation"}


@pytest.fixture(scope="module")
def con():
    return oracle_connection(SF_DIR)


def test_every_oracle_has_a_query():
    assert set(ORACLES) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_sql(spark, con, name):
    assert differences(QUERIES[name](spark, SF_DIR), con, ORACLES[name]) is None


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLES)))
def test_query_runs(spark, name):
    assert QUERIES[name](spark, LARGER_DIR if name in LARGER else SF_DIR).count() > 0


def test_entry(spark):
    assert entry.entry(spark).columns == ["label", "channel", "y", "x", "value"]
