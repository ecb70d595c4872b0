from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F

from market_engine.functions import ohlc
from market_engine.operators import clean, qualify, quality, summaries

from frames import plan_of

BAR = "ticker string, date date, open double, high double, low double, close double, volume double"


def bars(spark, *rows):
    return spark.createDataFrame(rows, BAR)


def test_repair_widens_only_broken_bars(spark):
    df = bars(
        spark,
        ("A", date(2024, 1, 1), 10.0, 9.0, 11.0, 12.0, 1.0),
        ("B", date(2024, 1, 1), 10.0, 13.0, 9.0, 12.0, 1.0),
        ("C", date(2024, 1, 1), 10.0, None, 9.0, 12.0, 1.0),
    )
    out = {r.ticker: (r.high, r.low) for r in clean.repair_ohlc(df).collect()}
    assert out == {"A": (12.0, 10.0), "B": (13.0, 9.0), "C": (None, 9.0)}
    assert clean.repair_ohlc(df).where(ohlc.invalid_ohlc()).count() == 0


def test_violation_labels(spark):
    df = bars(spark, ("A", date(2024, 1, 1), 10.0, 9.0, 8.0, 7.0, 1.0))
    row = clean.ohlc_violations(df).first()
    assert row["high_below_open"] == "high < open" and row["low_above_close"] == "low > close"
    assert row["high_below_low"] == "" and row["high_below_close"] == ""


def test_first_bar_of_a_day_wins(spark):
    rows = [("A", date(2024, 1, 1), float(i), 1.0, 1.0, 1.0, 1.0) for i in (3, 1, 2)]
    out = clean.one_bar_per_day(bars(spark, *rows), ["open"])
    assert [r.open for r in out.collect()] == [1.0]


def test_completeness_counts_rows_and_days(spark):
    day = date(2024, 1, 1)
    row = qualify.completeness(bars(spark, *[("A", d, 1.0, 1.0, 1.0, 1.0, 1.0) for d in (day, day, None)])).first()
    assert (row.record_count, row.unique_dates, row.min_date) == (2, 1, day)


def test_null_tickers_do_not_qualify(spark):
    df = bars(spark, *[(t, date(2024, 1, 1), 1.0, 1.0, 1.0, 1.0, 1.0) for t in ("A", None)])
    assert [r.ticker for r in qualify.qualified(df, 1).collect()] == ["A"]


def test_duplicates_treat_null_keys_as_equal_but_leave_them_out_of_groups(spark):
    df = spark.createDataFrame([("a", 1), ("a", 1), ("a", 1), (None, 2), (None, 2)], "k string, v int")
    row = summaries.duplicate_profile(df, ["k", "v"]).first()
    assert tuple(row) == (5, 1, 3.0, 3)


def test_price_report_and_verdict(spark):
    good = bars(spark, *[("A", date(2024, 1, d), 10.0, 11.0, 9.0, 10.0, 1.0) for d in (1, 2)])
    assert quality.verdict(quality.price_report(good)).first()[0] == "PASS"
    gap = good.union(bars(spark, ("A", date(2024, 3, 1), 10.0, 11.0, 9.0, 10.0, 1.0)))
    report = {(r.check, r.item): r for r in quality.price_report(gap).collect()}
    assert report[("date_gaps", "over_7_days")].failures == 1
    assert quality.verdict(quality.price_report(gap)).first()[0] == "PASS"
    for bad in (
        ("A", date(2024, 1, 1), 10.0, 11.0, 9.0, 10.0, 1.0),
        ("A", None, 10.0, 11.0, 9.0, 10.0, 1.0),
        ("A", date(2024, 1, 3), 0.0, 11.0, 0.0, 10.0, 1.0),
        ("A", date(2024, 1, 3), 10.0, 11.0, 9.0, 10.0, -1.0),
        ("A", date(2024, 1, 3), 10.0, 9.5, 9.0, 10.0, 1.0),
    ):
        assert quality.verdict(quality.price_report(good.union(bars(spark, bad)))).first()[0] == "FAIL", bad


def test_empty_table_passes(spark):
    report = quality.price_report(bars(spark))
    assert {r.percentage for r in report.collect()} <= {0.0, None}
    assert quality.verdict(report).first()[0] == "PASS"


def news(spark, *rows):
    return spark.createDataFrame(rows, "ticker string, query_date date, title string, text string, news_url string")


def test_news_report_falls_back_to_the_other_url_name(spark):
    day = date(2024, 1, 1)
    df = news(spark, ("A", day, "t", None, "u"), ("A", day, "s", None, "u"), (None, day, " \t", None, None))
    report = {(r.check, r.item): r for r in quality.news_report(df).collect()}
    assert report[("duplicates", "ticker,query_date,news_url")].failures == 2
    assert report[("required_fields", "title")].failures == 1
    assert report[("required_fields", "ticker")].failures == 1
    assert not report[("duplicates", "ticker,query_date,news_url")].critical
    assert quality.verdict(quality.news_report(df)).first()[0] == "FAIL"


def test_news_metrics(spark):
    df = news(spark, ("A", date(2020, 1, 1), "", None, "u"), (None, None, None, None, "u")).withColumnRenamed("news_url", "url")
    row = quality.news_metrics(df, date(2024, 1, 1)).first()
    assert tuple(row) == (1, 1, 1, 2, 1, 1)
    with pytest.raises(ValueError, match="title"):
        quality.news_metrics(df.drop("title"), date(2024, 1, 1))
    without = quality.news_metrics(df.drop("url"), date(2024, 1, 1))
    assert "duplicate_title_date" in without.columns


def test_types(spark):
    df = bars(spark).withColumn("volume", F.col("volume").cast("bigint")).withColumn("date", F.col("date").cast("string"))
    failed = [c for c, _, _, ok in quality.type_checks(df, quality.PRICE_TYPES) if not ok]
    assert failed == ["date"]


def test_source_mix(spark):
    df = spark.createDataFrame([("A", "ticker"), ("A", None), ("A", "abbrev1"), ("A", "abbrev1")], "ticker string, search_source string")
    row = summaries.search_source_mix(df).first()
    assert (row.articles, row.ticker_count, row.abbrev1_pct, row.company_name_pct) == (4, 2, 50.0, 0.0)


def test_price_report_lists_the_worst(spark):
    day = lambda i: date(2024, 1, 1) + timedelta(days=i)
    rows = [("A", day(i), 10.0, 11.0, 9.0, 10.0, 1.0) for i in (0, 8, 20, 30, 50, 60, 75, 76)]
    rows += [("B", day(0), 10.0, 11.0, 9.0, 10.0, 1.0)] * 3 + [("B", day(i), float(i), 1.0, 2.0, 1.5, 1.0) for i in (1, 1, 2, 3, 4, 5, 6)]
    rows += [("B", None, 1.0, 1.0, 1.0, 1.0, 1.0)] * 2
    report = quality.price_report(bars(spark, *rows)).collect()
    found = {(r.check, r.item): r for r in report}
    assert len(found) == len(report)
    gaps = [(found["longest_gap", str(k)].failures, found["longest_gap", str(k)].detail) for k in range(1, 6)]
    assert gaps[0] == (20, "A 2024-01-31 to 2024-02-20") and [g[0] for g in gaps] == [20, 15, 12, 10, 10]
    assert gaps[3][1] < gaps[4][1] and ("longest_gap", "6") not in found and found["date_gaps", "over_7_days"].failures == 6
    assert [(r.failures, r.detail) for r in report if r.check == "repeated_day"] == [(3, "B 2024-01-01"), (2, "B 2024-01-02")]
    assert found["duplicates", "all_columns"].failures == 2
    assert found["duplicates", "ticker,date"].detail == "3 groups, at most 3 rows, 2.3 on average"
    broken = [(r.item, r.failures, r.detail) for r in report if r.check == "broken_row"]
    assert broken[1] == ("2", 4, "B 2024-01-03 open 2.0000 high 1.0000 low 2.0000 close 1.5000: high < low, high < open, high < close, low > close")
    assert len(broken) == 5 and found["ohlc_order", "all"].failures == 7
    summary = {r.item: r.detail for r in report if r.check == "summary"}
    assert summary == {"unique_tickers": "2", "unique_dates": "14", "records_per_ticker": "10.0", "date_range_days": "76"}
    assert not any(r.critical for r in report if r.check in ("longest_gap", "repeated_day", "broken_row", "summary"))


def test_reports_read_their_rows_once(spark, tmp_path):
    path = str(tmp_path / "bars")
    bars(spark, ("A", date(2024, 1, 1), 10.0, 11.0, 9.0, 10.0, 1.0)).write.parquet(path)
    assert plan_of(quality.price_report(spark.read.parquet(path))).count("FileScan") == 1


def test_news_report_lists_repeated_articles(spark):
    day = date(2024, 1, 1)
    rows = [(t, day, f"title {i % 4}", None, "u" * 120 + str(i // 2)) for t in ("A", "B") for i in range(8)]
    rows += [(None, day, "x", None, "u"), (None, day, "x", None, "u")]
    report = quality.news_report(news(spark, *rows)).collect()
    titles = [(r.item, r.failures, r.detail) for r in report if r.check == "repeated_title"]
    assert titles == [(str(k + 1), 2, f"{t} 2024-01-01 title {n}") for k, (t, n) in enumerate([("A", 0), ("A", 1), ("A", 2), ("A", 3), ("B", 0)])]
    urls = [r.detail for r in report if r.check == "repeated_news_url"]
    assert len(urls) == 5 and urls[0] == f"A 2024-01-01 {'u' * 100}..."
    found = {(r.check, r.item): r for r in report}
    assert found["duplicates", "ticker,query_date,news_url"].detail == "9 groups, at most 2 rows, 2.0 on average"
    assert found["summary", "articles_per_ticker"].detail == "9.0"
