"""Every named query against its SQL counterpart on the smallest sample."""

import datetime
import math
import os

import pytest

import __spark_entry__ as driver
from market_engine.plans import catalog

SMALL = driver.SMALL

duckdb = pytest.importorskip("duckdb")
pytestmark = pytest.mark.skipif(not os.path.isdir(SMALL), reason="sample tables are absent")


@pytest.fixture(scope="module")
def database():
    connection = duckdb.connect()
    for file in os.listdir(SMALL):
        connection.execute(f"CREATE VIEW {file.removesuffix('.parquet')} AS SELECT * FROM '{SMALL}/{file}'")
    return connection


def comparable(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else round(value, 8) + 0.0
    if isinstance(value, datetime.datetime):
        return value.isoformat()
    return value


def rows(columns, data):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((repr([comparable(r[i]) for i in order]) for r in data))


def test_every_query_has_sql():
    assert set(catalog.QUERIES) <= set(driver.oracle_sql()) <= set(driver.queries())


@pytest.mark.parametrize("name", sorted(catalog.QUERIES))
def test_query_matches_sql(spark, database, name):
    df = driver.queries()[name](spark, SMALL)
    cursor = database.execute(driver.oracle_sql()[name])
    columns = [c[0] for c in cursor.description]
    assert sorted(df.columns) == sorted(columns)
    assert rows(df.columns, df.collect()) == rows(columns, cursor.fetchall())


def test_entry(spark):
    df = driver.entry(spark)
    assert df.count() == driver.queries()["price_change"](spark, SMALL).count()
    assert len(df.columns) == 62
