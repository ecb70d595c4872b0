"""Loads lose nothing, evaluate their input once, and validation survives bad data."""

from datetime import date, timedelta

import pandas as pd
import pytest
from pyspark.sql import functions as F

from market_engine.operators import candidates, incremental, quality, sentiment, windows
from market_engine.plans import jobs, prices
from market_engine.sinks import tables

from test_jobs import START, content, raw

NEWS = "ticker string, query_date string, title string, url string, n int"
LABELS = ("positive", "negative", "neutral")


def counting_model(counter):
    def load():
        def model(texts):
            counter.add(len(texts))
            return [[float(len(t)), 1.0, 2.0] for t in texts]

        return model

    return load


@pytest.fixture
def lexicon(spark):
    return spark.createDataFrame([("good", 1.0), ("bad", -1.0)], "word string, valence double")


def test_two_loads_in_a_month_equal_one(spark, lexicon):
    def day(i):
        return (START + timedelta(days=i)).isoformat()

    first = [("a", day(0), "good day", "u1", 1), ("a", day(0), "bad day", None, 2), ("b", day(40), "x", "u9", 3)]
    second = [("a", day(1), "good", "u1", 4), ("a", day(2), "bad", "", 5), ("c", day(0), "new", "u1", 6)]
    one, two, both = (spark.createDataFrame(rows, NEWS) for rows in (first, second, first + second))
    for part in (one, two, two):
        jobs.load_news(part, "news_parts", lexicon, ["n"])
    jobs.load_news(both, "news_whole", lexicon, ["n"])

    def rows(name):
        return content(spark.table(name).drop("sentiment_timestamp"))

    assert rows("news_parts") == rows("news_whole") and len(rows("news_parts")) == 6
    changed = spark.createDataFrame([("a", day(0), "better", "u1", 7)], NEWS)
    jobs.load_news(changed, "news_parts", lexicon, ["n"])
    assert spark.table("news_parts").count() == 6
    assert spark.table("news_parts").where("title = 'better'").count() == 1
    spark.sql("DROP TABLE news_parts")
    spark.sql("DROP TABLE news_whole")


def test_refresh_writes_a_newly_qualified_ticker_in_full(spark, tmp_path):
    path = str(tmp_path / "silver")
    old = raw(spark, ["A"], 30).union(raw(spark, ["BB"], 8, first=22))
    tables.write_months(prices.raw_to_silver(old, ["seq"], 10), path)
    assert {r.ticker for r in spark.read.parquet(path).select("ticker").distinct().collect()} == {"A"}
    new = raw(spark, ["A", "BB"], 5, first=30)
    jobs.refresh_prices(old.union(new), new, path, ["seq"], 10)
    want = prices.raw_to_silver(old.union(new), ["seq"], 10)
    assert content(spark.read.parquet(path)) == content(want)
    jobs.refresh_prices(old.union(new), new.limit(0), path, ["seq"], 10)
    assert spark.read.parquet(path).count() == want.count()


def test_refresh_of_a_table_not_written_yet(spark, tmp_path):
    path = str(tmp_path / "silver")
    bars = raw(spark, ["A"], 12)
    jobs.refresh_prices(bars, bars.where("seq >= 9"), path, ["seq"], 10)
    assert spark.read.parquet(path).count() == 12


def test_rows_without_a_date_survive_merges(spark, tmp_path):
    path = str(tmp_path / "bars")
    for ticker in ("A", "B"):
        rows = spark.createDataFrame([(ticker, None, 1.0)], "ticker string, date date, close double")
        tables.merge_months(rows, path, ["ticker", "date"], [F.col("_new").desc()])
    assert sorted(r.ticker for r in spark.read.parquet(path).collect()) == ["A", "B"]


def test_loads_evaluate_each_row_once(spark, tmp_path, lexicon):
    seen = spark.sparkContext.accumulator(0)

    @F.pandas_udf("double")
    def counted(values: pd.Series) -> pd.Series:
        seen.add(len(values))
        return values

    rows = spark.range(1000).select(
        F.lit("A").alias("ticker"), F.date_add(F.lit("2024-01-01"), F.col("id").cast("int")).alias("date"), F.col("id").cast("double").alias("v")
    )
    scored = rows.withColumn("v", counted("v"))
    tables.write_months(scored, str(tmp_path / "a"))
    assert seen.value == 1000
    for total in (2000, 3000):
        tables.merge_months(scored, str(tmp_path / "b"), ["ticker", "date"], [F.col("_new").desc()])
        assert seen.value == total
    texts = spark.sparkContext.accumulator(0)
    news = spark.range(200).select(
        F.lit("A").alias("ticker"), F.lit("2024-01-01").alias("query_date"), F.concat(F.lit("t"), F.col("id")).alias("title"),
        F.concat(F.lit("u"), F.col("id")).alias("url"), F.col("id").alias("n"),
    )
    for total in (200, 400):
        jobs.load_news(news, "news_once", lexicon, ["n"], counting_model(texts), LABELS)
        assert texts.value == total
    assert spark.table("news_once").count() == 200
    spark.sql("DROP TABLE news_once")


def test_a_hot_month_of_one_ticker_is_cut(spark, tmp_path):
    size = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    before = spark.conf.get(size)
    spark.conf.set(size, "64k")
    try:
        rows = spark.range(0, 200_000, 1, 8).select(
            F.lit("HOT").alias("ticker"), F.lit("2024-01-05").cast("date").alias("date"), F.rand(1).alias("close")
        )
        tables.write_months(rows, str(tmp_path / "hot"))
    finally:
        spark.conf.set(size, before)
    assert len(list((tmp_path / "hot" / "month=2024-01").glob("*.parquet"))) > 2
    assert spark.read.parquet(str(tmp_path / "hot")).count() == 200_000


def test_validation_reports_bad_dates(spark, tmp_path):
    news = spark.createDataFrame(
        [("A", "2024-01-01", "t"), ("A", "soon", "t"), ("A", "2024-01-20 08:00:00", "t")], "ticker string, query_date string, title string"
    )
    report = {(r.check, r.item): r for r in quality.news_report(news).collect()}
    assert report[("null_dates", "query_date")].failures == 1
    assert report[("null_dates", "query_date")].detail == "2024-01-01 to 2024-01-20, 2 days"
    assert report[("date_gaps", "over_7_days")].failures == 1
    assert report[("date_gaps", "over_7_days")].detail == "longest 19 days"
    assert not jobs.validate_news(news, str(tmp_path), "2024-01-31")
    assert windows.date_gaps(news, 7, date="query_date").count() == 1
    done = spark.createDataFrame([("A", "soon"), ("A", "2024-01-02")], "ticker string, date string")
    spine = spark.createDataFrame([("A", date(2024, 1, 1)), ("A", date(2024, 1, 2))], "ticker string, date date")
    assert [r.date.day for r in incremental.missing_days(spine, done).collect()] == [1]


def test_a_wrong_type_fails_once_even_without_rows(spark):
    bars = raw(spark, [], 0).withColumnRenamed("symbol", "ticker")
    report = {r.item: r for r in quality.price_report(bars).where("check = 'column_types'").collect()}
    assert (report["date"].failures, report["date"].detail) == (1, "expected date, found string")
    assert report["close"].passed


def test_validation_shows_what_cleaning_repaired(spark, tmp_path):
    bars = raw(spark, ["A"], 3)
    broken = bars.union(bars.where("seq = 1").withColumn("high", F.lit(0.5)))
    assert jobs.validate_prices(broken, ["seq"], str(tmp_path), "2024-01-31")
    report = {(r.check, r.item): r for r in spark.read.json(str(tmp_path / "20240131_prices.json")).collect()}
    assert report[("duplicates", "ticker,date")].failures == 0
    assert report[("raw_duplicates", "ticker,date")].failures == 2
    assert report[("raw_duplicates", "ticker,date")].detail == "1 groups, at most 2 rows, 2.0 on average"
    assert report[("raw_ohlc_order", "all")].failures == 1
    assert not report[("raw_ohlc_order", "all")].critical


def test_labels_are_scored_once(spark):
    texts = spark.sparkContext.accumulator(0)
    articles = spark.range(300).select(F.when(F.col("id") % 3 > 0, F.concat(F.lit("t"), "id")).alias("sentiment_text"))
    out = sentiment.label_distribution(sentiment.model_scores(articles, counting_model(texts), LABELS))
    assert [(r.articles, r.percentage) for r in out.collect()] == [(200, 100.0)]
    assert texts.value == 200


def found(spark, rows):
    schema = "ticker string, date string, endpoint string, term string, page int, rank int, title string, text string, url string, failed boolean"
    return spark.createDataFrame(rows, schema)


def test_repeated_tickers_do_not_multiply_and_the_search_stops_at_the_target(spark):
    names = spark.createDataFrame([("A", "Co", None, None)] * 4, "ticker string, company_name string, abbrev1 string, abbrev2 string")
    rows = [("A", "2024-01-01", "advanced", "ticker", 1, i, f"A {i}", "A", f"u{i}", False) for i in range(3)]
    rows += [("A", "2024-01-01", "regular", "ticker", 1, 10 + i, f"A r{i}", "A", f"r{i}", False) for i in range(9)]
    out = candidates.select_articles(found(spark, rows), names, target=3, threshold=7).collect()
    assert sorted(r["rank"] for r in out) == [0, 1, 2]
    assert {r.endpoint_used for r in out} == {"advanced"}
