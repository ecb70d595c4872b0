"""Each training-data query that SQL can express against that SQL, on the smallest sample."""

import os

import pytest

import __spark_entry__ as driver
from market_engine.llm import oracle, queries
from test_catalog import rows

duckdb = pytest.importorskip("duckdb")
pytestmark = pytest.mark.skipif(not os.path.isdir(driver.SMALL), reason="sample tables are absent")


def test_registered_queries():
    assert set(oracle.ORACLE) <= set(queries.QUERIES) <= set(driver.queries())
    assert [int(name[2:].split("_")[0]) for name in queries.QUERIES] == list(range(1, 14))


@pytest.mark.parametrize("name", sorted(oracle.ORACLE))
def test_query_matches_sql(spark, name):
    connection = duckdb.connect()
    for table in ("documents", "pages"):
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{driver.SMALL}/{table}.parquet'")
    df = queries.QUERIES[name](spark, driver.SMALL)
    cursor = connection.execute(oracle.ORACLE[name])
    columns = [c[0] for c in cursor.description]
    assert sorted(df.columns) == sorted(columns)
    assert rows(df.columns, df.collect()) == rows(columns, cursor.fetchall())
