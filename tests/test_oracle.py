"""Every registered query against its SQL twin on the smallest data set."""

import duckdb
import pytest

import __spark_entry__ as contract
from compare import TABLES, normal

from .conftest import SMALL

QUERIES, SQL = contract.queries(), contract.oracle_sql()


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"create view {name} as select * from '{SMALL}/{name}.parquet'")
    return connection


def test_every_sql_twin_has_a_query():
    assert set(SQL) <= set(QUERIES)


@pytest.mark.parametrize("name", list(QUERIES))
def test_query(spark, duck, name):
    got = QUERIES[name](spark, SMALL).toPandas()
    if name not in SQL:
        assert len(got) > 0
        return
    want = duck.execute(SQL[name]).df()
    got, want = normal(got), normal(want)
    assert list(got.columns) == list(want.columns)
    assert got.equals(want)


def test_entry(spark):
    assert contract.entry(spark).count() > 0
