"""Every registered query against its SQL, at the smallest scale."""

import duckdb
import pytest

import __spark_entry__ as entry
from check import TABLES, rows_of, types_of
from tests.conftest import SF
from workload.oracles import ORACLES
from workload.queries import QUERIES


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for t in TABLES:
        connection.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return connection


def test_every_query_has_its_sql():
    assert set(QUERIES) == set(ORACLES)
    assert set(QUERIES) <= set(entry.queries()) and set(ORACLES) <= set(entry.oracle_sql())


def test_entry(spark):
    assert entry.entry(spark).count() > 0


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, duck, name):
    actual = QUERIES[name](spark, SF).toArrow()
    expected = duck.sql(ORACLES[name]).to_arrow_table()
    assert types_of(actual) == types_of(expected)
    assert rows_of(actual) == rows_of(expected)
