"""Every registered query against DuckDB on the same tables."""

import os

import duckdb
import pytest
from helpers import DUCK_TYPES, TABLES, duck_rows, spark_rows

import __spark_entry__ as registered
import oracle_queries
import spark_queries

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
QUERIES, ORACLE = spark_queries.QUERIES, oracle_queries.ORACLE


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SF_DIR}/{table}.parquet'")
    return connection


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLE)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_matches_oracle(spark, duck, name):
    result = QUERIES[name](spark, SF_DIR)
    relation = duck.execute(ORACLE[name])
    types = {c[0]: str(c[1]) for c in relation.description}
    assert {c: DUCK_TYPES[t] for c, t in result.dtypes} == types
    expected = duck_rows(relation)
    assert expected, "an empty result proves nothing"
    assert spark_rows(result) == expected


def test_all_are_registered():
    assert QUERIES.items() <= registered.queries().items()
    assert ORACLE.items() <= registered.oracle_sql().items()


def test_entry_runs(spark):
    assert registered.entry(spark).count() > 0
