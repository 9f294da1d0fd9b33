"""Every registered query against its SQL on the smallest tables."""

import os

import duckdb
import pytest

from siltstone.workloads import ORACLE, QUERIES

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events".split()

pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no test data here")


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for name in TABLES:
        connection.sql(f"CREATE VIEW {name} AS SELECT * FROM '{SF}/{name}.parquet'")
    return connection


def ordered(columns, data):
    places = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(row[i] for i in places) for row in data), key=repr)


def test_every_query_has_its_sql():
    assert QUERIES.keys() == ORACLE.keys()


@pytest.mark.parametrize("name", list(QUERIES))
def test_query(spark, duck, name):
    got, want = QUERIES[name](spark, SF), duck.sql(ORACLE[name])
    assert sorted(got.columns) == sorted(want.columns)
    assert ordered(got.columns, got.collect()) == ordered(want.columns, want.fetchall())
