"""Every registered query against DuckDB on the given tables."""

import pytest

import __spark_entry__ as driver
from checks.compare import connect, differences
from checks.queries import QUERIES as warehouse

QUERIES = driver.queries()
SQL = driver.oracle_sql()


@pytest.fixture(scope="module")
def database(sf_dir):
    return connect(sf_dir)


def test_every_query_of_the_warehouse_has_sql():
    assert set(warehouse) <= SQL.keys() <= QUERIES.keys()


@pytest.mark.parametrize("name", SQL)
def test_query(spark, sf_dir, database, name):
    assert differences(QUERIES[name](spark, sf_dir), database, SQL[name]) == []


def test_entry(spark):
    assert driver.entry(spark).count() > 0
