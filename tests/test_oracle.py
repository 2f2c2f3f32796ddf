"""Every registered query against another engine, on the smallest tables."""

from __future__ import annotations

import pytest
from compare import connect, differences
from conftest import SMALL

from __spark_entry__ import entry, oracle_sql, queries
from tillwarden.registry import QUERIES

@pytest.fixture(scope="module")
def db():
    return connect(SMALL)


def test_every_query_has_sql():
    assert set(QUERIES) <= set(oracle_sql())
    assert set(oracle_sql()) <= set(queries())


@pytest.mark.parametrize("name", sorted(set(QUERIES) & set(oracle_sql())))
def test_query(name, spark, db):
    assert differences(queries()[name](spark, SMALL), db, oracle_sql()[name]) == []


def test_entry(spark):
    rows = entry(spark).collect()
    assert sum(r.total_transactions for r in rows) == 1000
    assert sum(r.fraud_transactions for r in rows) == 97
