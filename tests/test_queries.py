"""Every registered query at the smallest size, against its SQL twin."""

from __future__ import annotations

import duckdb
import pytest

import __spark_entry__ as driver
from check import TABLES, difference

SF_DIR = driver.SMOKE_DIR


@pytest.fixture(scope="module")
def oracle():
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SF_DIR}/{name}.parquet'")
    return connection


def test_every_twin_has_a_query():
    assert set(driver.oracle_sql()) <= set(driver.queries())


@pytest.mark.parametrize("name", sorted(driver.queries()))
def test_query(spark, oracle, name):
    found = driver.queries()[name](spark, SF_DIR).toPandas()
    assert len(found)
    sql = driver.oracle_sql().get(name)
    if sql is not None:
        assert difference(found, oracle.execute(sql).df()) is None


def test_entry(spark):
    assert driver.entry(spark).columns == ["user_session", "user_id", "product_id", "name", "score"]
