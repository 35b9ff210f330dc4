"""Registered queries that SQL can express, against a second engine."""

from __future__ import annotations

from collections import Counter

import pytest

from checks.compare import duck
from tapewatch.llm.queries import ORACLE_SQL, QUERIES

FOLDER = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def connection():
    return duck(FOLDER)


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_query_equals_sql(spark, connection, name):
    result = QUERIES[name](spark, FOLDER)
    found = connection.execute(ORACLE_SQL[name])
    names = [item[0] for item in found.description]
    assert sorted(result.columns) == sorted(names)
    expected = Counter(found.fetchall())
    assert expected and Counter(tuple(row) for row in result.select(*names).collect()) == expected
