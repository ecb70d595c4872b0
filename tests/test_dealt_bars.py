"""Bars of lines that are dealt out by ticker: one shuffle up to the features, and the same rows."""

from datetime import datetime, timedelta

import pytest
from frames import plan_of

from market_engine.plans import catalog, prices
from market_engine.plans import sample_tables as sample

LINES = (
    "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, l_extendedprice double, "
    "l_shipdate timestamp"
)


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    """Two thirds of the lines on one ticker, some on none; NULL values, days without a date and a line that comes twice."""
    path = tmp_path_factory.mktemp("lines")
    rows = []
    for i in range(600):
        supplier = None if i % 50 == 7 else 1 if i % 3 else i % 5 + 2
        price = None if i % 41 == 0 else 900.0 + (i * 37) % 101
        quantity = None if i % 43 == 0 else float(i % 50)
        day = None if i % 97 == 5 else datetime(1995, 1, 1, i % 24) + timedelta(days=i % 80)
        rows.append((None if i % 59 == 3 else i // 4, i % 17, supplier, i % 4, quantity, price, day))
    rows.append(rows[100])
    spark.createDataFrame(rows, LINES).repartition(3).write.parquet(str(path / "lineitem.parquet"))
    return str(path)


def rows_of(df):
    return sorted(map(tuple, df.collect()), key=repr)


def test_all_price_features_take_one_shuffle(spark, folder):
    plan = plan_of(catalog.price_features_all(spark, folder))
    assert plan.count("Exchange") == 1
    assert f"{spark.conf.get('spark.sql.shuffle.partitions')}), REPARTITION_BY_NUM" in plan


def test_dealt_lines_make_the_same_bars(spark, folder):
    plain = sample.bars(spark, folder)
    dealt = sample.bars(spark, folder, 3)
    assert dealt.dtypes == plain.dtypes
    assert rows_of(dealt) == rows_of(plain)


def test_features_of_dealt_bars_are_those_of_plain_bars(spark, folder):
    found = catalog.price_features_all(spark, folder)
    plain = prices.silver_prices(sample.bars(spark, folder), 1, keep_intermediate=True, stamp=False)
    assert found.columns == plain.columns
    rows = rows_of(found)
    assert rows == rows_of(plain) and len(rows) > 80
