"""Every registered query with check SQL against DuckDB."""

from __future__ import annotations

import pytest

import __spark_entry__ as contract
from conftest import SMALL
from oracle_check import compare, connect

CHECKS = contract.oracle_sql()
QUERIES = contract.queries()


@pytest.fixture(scope="module")
def connection():
    return connect(SMALL)


@pytest.mark.parametrize("name", sorted(CHECKS))
def test_query_matches_sql(spark, connection, name):
    assert compare(spark, connection, QUERIES[name], CHECKS[name], SMALL) == ""


def test_every_check_has_a_query():
    assert set(CHECKS) <= set(QUERIES)


def test_entry_runs(spark):
    rows = contract.entry(spark).collect()
    assert {r["PARTITION_TYPE"] for r in rows} == {1, 2, 3}
