"""Every registered query against its SQL on the driver tables."""

from __future__ import annotations

import duckdb
import pytest
from conftest import SF_DIR

from __spark_entry__ import entry, oracle_sql, queries
from vaultwright.plans import QUERIES

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark "
    "labels conversations"
).split()


@pytest.fixture(scope="module")
def oracle():
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SF_DIR}/{name}.parquet'")
    return connection


@pytest.mark.parametrize("name", sorted(oracle_sql()))
def test_query_matches_sql(spark, oracle, name):
    df = queries()[name](spark, SF_DIR)
    result = oracle.execute(oracle_sql()[name])
    columns = [d[0] for d in result.description]
    assert sorted(df.columns) == sorted(columns)
    order = sorted(columns)
    actual = sorted((tuple(r[c] for c in order) for r in df.collect()), key=repr)
    places = [columns.index(c) for c in order]
    expected = sorted((tuple(r[i] for i in places) for r in result.fetchall()), key=repr)
    assert actual == expected
    assert actual, "a query without rows shows nothing"


def test_every_query_of_the_vault_has_sql():
    assert all(query.sql for query in QUERIES.values())
    assert QUERIES.keys() <= oracle_sql().keys() <= queries().keys()


def test_entry_runs(spark):
    df = entry(spark)
    assert df.columns[:2] == ["CUSTOMER_HK", "HASH_DIFF"]
    assert df.count() > 0
