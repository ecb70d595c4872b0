from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F

from market_engine.operators import incremental
from market_engine.plans import jobs, prices
from market_engine.schemas import SILVER_PRICES
from market_engine.sources import bronze

START = date(2024, 1, 1)
RAW = "symbol string, date string, open double, high double, low double, close double, volume long, seq long"


def raw(spark, symbols, days, first=0):
    rows = []
    for s in symbols:
        for i in range(first, first + days):
            close = 10.0 + (i * 7 + len(s)) % 11
            rows.append((s, (START + timedelta(days=i)).isoformat(), close, close + 1, close - 1, close, 100 + i, i))
    return spark.createDataFrame(rows, RAW)


def content(df):
    columns = sorted(set(df.columns) - {"ingestion_timestamp", "month"})
    return sorted(map(repr, df.select(columns).collect()))


def test_price_table_and_refresh(spark, tmp_path):
    old = raw(spark, ["A", "BB"], 50)
    jobs.load_prices(old, "prices_t", ["seq"], 10)
    assert spark.table("prices_t").count() == 100
    assert incremental.last_date(spark, "prices_t") == START + timedelta(days=49)
    path = str(tmp_path / "silver")
    price_silver = prices.raw_to_silver(old, ["seq"], 10)
    from market_engine.sinks import tables

    tables.write_months(price_silver, path)
    new = raw(spark, ["A"], 5, first=50)
    jobs.refresh_prices(old.union(new), new, path, ["seq"], 10)
    refreshed = spark.read.parquet(path)
    want = prices.raw_to_silver(old.union(new), ["seq"], 10)
    assert content(refreshed) == content(want)
    assert set(refreshed.columns) - {"month"} == set(SILVER_PRICES.fieldNames())
    spark.sql("DROP TABLE prices_t")


def test_news_table_and_gold(spark, tmp_path):
    day = START.isoformat()
    rows = [("a", day, "good day", "u1", 1), ("a", day, "good day", "u1", 2), ("a", day, "bad day", None, 3)]
    articles = spark.createDataFrame(rows, "ticker string, query_date string, title string, url string, n int")
    lexicon = spark.createDataFrame([("good", 1.0), ("bad", -1.0)], "word string, valence double")
    for _ in range(2):
        jobs.load_news(articles, "news_t", lexicon, ["n"])
    table = spark.table("news_t")
    assert table.count() == 2
    bars = prices.raw_to_silver(raw(spark, ["A"], 12), ["seq"], 10)
    jobs.load_gold(bars, table, str(tmp_path / "gold"))
    first = spark.read.parquet(str(tmp_path / "gold")).orderBy("date").first()
    assert first.articles == 2 and abs(first.avg_vader_compound) < 1e-12
    spark.sql("DROP TABLE news_t")


@pytest.mark.parametrize("volume, passed", [(1, True), (-1, False)])
def test_validation(spark, tmp_path, volume, passed):
    bars = raw(spark, ["A"], 3).withColumn("volume", F.lit(volume).cast("long"))
    assert jobs.validate_prices(bars, ["seq"], str(tmp_path), "2024-01-31") is passed
    news = spark.createDataFrame([("A", START, "t")], "ticker string, query_date date, title string")
    assert jobs.validate_news(news, str(tmp_path), "2024-01-31")


def test_bronze_loads_keep_what_is_stored(spark, tmp_path):
    bars = "symbol string, date date, close double"
    path = str(tmp_path / "bars")
    jobs.store_bars(spark.createDataFrame([("A", START, 1.0), ("B", START, 2.0)], bars), path)
    jobs.store_bars(spark.createDataFrame([("A", START, 3.0), ("A", START + timedelta(days=1), 4.0)], bars), path)
    held = sorted((r.symbol, r.date.day, r.close) for r in bronze.read_prices(spark, path).collect())
    assert held == [("A", 1, 3.0), ("A", 2, 4.0), ("B", 1, 2.0)]

    news = "ticker string, query_date string, title string, url string"
    path = str(tmp_path / "news")
    jobs.store_news(spark.createDataFrame([("A", "2024-01-01", "old", "u"), ("A", "2024-01-01", "t", None)], news), path)
    later = [("A", "2024-01-01", "new", "u"), ("A", "2024-01-02", "t", None), ("A", "no date", "x", "v")]
    jobs.store_news(spark.createDataFrame(later, news), path)
    held = sorted((r.query_date.day if r.query_date else 0, r.title) for r in bronze.read_news(spark, path).collect())
    assert held == [(0, "x"), (1, "new"), (1, "t"), (2, "t")]


def test_a_processed_day_is_not_asked_for_again(spark, tmp_path):
    days = spark.createDataFrame([("A", START + timedelta(days=i)) for i in range(4)], "ticker string, date date")
    path = str(tmp_path / "processed")
    jobs.mark_processed(days.where(F.dayofmonth("date") == 1), path)
    jobs.mark_processed(days.where(F.dayofmonth("date").isin(1, 3)), path)
    left = incremental.missing_days(days, spark.read.parquet(path))
    assert sorted(r.date.day for r in left.collect()) == [2, 4]
