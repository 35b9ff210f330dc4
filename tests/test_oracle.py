"""Every registered query against its SQL, through a second engine."""

from __future__ import annotations

import pytest
from helpers import SMALL

import __spark_entry__ as contract
from checks.catalog import QUERIES
from checks.compare import difference, duck
from checks.oracle import ORACLE_SQL


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLE_SQL)


def test_every_query_is_registered():
    assert set(QUERIES) <= set(contract.queries())
    assert set(contract.oracle_sql()) <= set(contract.queries())


def test_entry(spark):
    rows = contract.entry(spark).collect()
    assert len(rows) == 8
    assert sum(row.total_events for row in rows) == 863


@pytest.fixture(scope="module")
def connection():
    return duck(SMALL)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql(spark, connection, name):
    assert difference(spark, connection, name, SMALL) == ""
