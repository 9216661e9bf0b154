"""Every query of the library proper against its DuckDB statement, on the smallest given tables."""

from __future__ import annotations

import pytest

import __spark_entry__ as entry
from stockflow.plans import catalog, oracle
from tests.compare import differences, duck

SF = "/root/testdata/sf0.001"
QUERIES, STATEMENTS = catalog.registered(), oracle.statements()


@pytest.fixture(scope="module")
def con():
    return duck(SF)


def test_every_query_has_a_statement():
    assert set(QUERIES) == set(STATEMENTS)
    assert set(QUERIES) <= set(entry.queries())
    assert set(STATEMENTS) <= set(entry.oracle_sql()) <= set(entry.queries())


@pytest.mark.parametrize("name", list(QUERIES))
def test_query(spark, con, name):
    assert differences(QUERIES[name](spark, SF), con, STATEMENTS[name]) == []


def test_entry(spark):
    assert entry.entry(spark).count() > 0
