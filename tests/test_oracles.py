"""Every query of the catalog job against DuckDB on the same files."""

from __future__ import annotations

import pytest

import __spark_entry__ as contract
from compare import connect, difference
from queries.catalog import ORACLES, QUERIES

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return connect(SF_DIR)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_same_rows_as_sql(spark, con, name):
    assert difference(QUERIES[name](spark, SF_DIR), con, ORACLES[name]) is None


def test_every_query_has_its_sql():
    assert QUERIES.keys() == ORACLES.keys() <= contract.oracle_sql().keys() <= contract.queries().keys()


def test_entry_is_ordered_by_revenue(spark):
    amounts = [r.chiffre_affaires for r in contract.entry(spark).collect()]
    assert amounts and amounts == sorted(amounts, reverse=True)


@pytest.mark.parametrize("name", ["premium", "ordinary"])
def test_parts_are_ordered_by_score(spark, name):
    scores = [r.z_score for r in QUERIES[name](spark, SF_DIR).collect()]
    assert scores and scores == sorted(scores, reverse=True)
