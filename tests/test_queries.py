"""Every registered query against its SQL on the smallest tables."""

import os

import duckdb
import pytest

import __spark_entry__ as contract

SF = "/root/testdata/sf0.001"
QUERIES, CHECKS = contract.queries(), contract.oracle_sql()


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for name in os.listdir(SF):
        table = name.removesuffix(".parquet")
        connection.execute(f"create view {table} as select * from '{SF}/{name}'")
    return connection


def normalised(rows, columns):
    order = sorted(range(len(columns)), key=columns.__getitem__)
    return sorted(repr([row[i] for i in order]) for row in rows)


def test_every_check_has_a_query():
    assert set(CHECKS) <= set(QUERIES)


@pytest.mark.parametrize("name", QUERIES)
def test_query(spark, duck, name):
    df = QUERIES[name](spark, SF)
    rows = df.collect()
    assert rows
    if name in CHECKS:
        result = duck.execute(CHECKS[name])
        columns = [c[0] for c in result.description]
        assert sorted(columns) == sorted(df.columns)
        assert normalised(rows, df.columns) == normalised(result.fetchall(), columns)


def test_entry(spark):
    df = contract.entry(spark)
    assert df.count() == 6000
    assert len(df.columns) == 25
