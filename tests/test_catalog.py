"""Every query against its SQL in an independent engine, on the smallest tables."""

import os

import duckdb
import pytest

import __spark_entry__ as contract
from trapiche.catalog import ORACLE_SQL, QUERIES

FOLDER = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="test tables are not here")


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for file in os.listdir(FOLDER):
        name = file.removesuffix(".parquet")
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{FOLDER}/{file}'")
    return connection


def in_name_order(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(columns), sorted((tuple(r[i] for i in order) for r in rows), key=repr)


@pytest.mark.parametrize("name", sorted(contract.oracle_sql()))
def test_query(spark, duck, name):
    result = contract.queries()[name](spark, FOLDER)
    relation = duck.sql(contract.oracle_sql()[name])
    mine = in_name_order(result.columns, result.collect())
    theirs = in_name_order(relation.columns, relation.fetchall())
    assert mine[0] == theirs[0]
    assert mine[1] == theirs[1]


def test_entry(spark):
    assert contract.entry(spark).count() > 0


def test_every_query_of_the_catalog_has_sql():
    assert set(QUERIES) == set(ORACLE_SQL)
    assert set(contract.oracle_sql()) <= set(contract.queries())
