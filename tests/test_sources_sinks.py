import json
from datetime import date, datetime

import pandas as pd
import pytest
from pyspark.sql import functions as F

from market_engine import paths
from market_engine.operators import clean, incremental, quality
from market_engine.plans import jobs
from market_engine.schemas import BARS_BRONZE, SILVER_NEWS, SILVER_PRICES
from market_engine.sinks import tables
from market_engine.sources import bronze, payloads

TODAY = date(2026, 12, 1)


def chart(timestamps, **quote):
    return json.dumps({"chart": {"result": [{"timestamp": timestamps, "indicators": {"quote": [quote]}}]}})


def test_chart_payload(spark):
    full = chart(
        [1699833600, 1699920000],
        open=[150.0],
        high=[152.0, 153.0],
        low=[149.0, 150.0],
        close=[151.5, None],
        volume=[1000000, 1100000, 7],
    )
    rows = [("A", f"<html>{full}</html>"), ("B", '{"chart": {"result": []}}'), ("C", "no json"), ("D", chart([1699833600]))]
    df = spark.createDataFrame(rows, "symbol string, payload string")
    out = sorted(map(tuple, payloads.chart_bars(df).collect()))
    assert out == [
        ("A", date(2023, 11, 13), 150.0, 152.0, 149.0, 151.5, 1000000),
        ("A", date(2023, 11, 14), None, 153.0, 150.0, None, 1100000),
        ("D", date(2023, 11, 13), None, None, None, None, None),
    ]


def test_chart_dates_follow_the_exchange(spark):
    df = spark.createDataFrame([("A", chart([1699833600], open=[1.0]))], "symbol string, payload string")
    assert payloads.chart_bars(df, zone="America/New_York").first().date == date(2023, 11, 12)
    spark.conf.set("spark.sql.session.timeZone", "Asia/Tokyo")
    try:
        assert payloads.chart_bars(df).first().date == date(2023, 11, 13)
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_news_payload(spark):
    body = json.dumps({"data": [{"title": "t", "url": "u", "topics": ["x"]}, {"title": "s"}]})
    df = spark.createDataFrame([(1, body), (2, '{"message": "none"}'), (3, "broken")], "id int, payload string")
    out = payloads.articles(df, keep=("id",)).collect()
    assert [(r.id, r.title, r.topics) for r in out] == [(1, "t", ["x"]), (1, "s", None)]


def test_answers_are_read_or_refused(spark):
    whole = chart([1699833600], open=[1.0])
    texts = [whole, whole[:-20], whole[: len(whole) // 2], None, "  ", "no json", '{"chart": {"result": []}}', '{"chart": null}', "[1]"]
    texts += ['{"chart": {"result": null, "error": {"code": "Not Found", "description": "delisted"}}}', chart(["soon"], open=["high"])]
    df = spark.createDataFrame(list(enumerate(texts)), "symbol int, payload string")
    answers = payloads.chart_answers(df)
    out = {r.symbol: r.outcome for r in answers.collect()}
    assert len(out) == len(texts) and out[0] == payloads.READ
    assert out[1] == out[2] == out[5] == payloads.BROKEN and out[3] == out[4] == payloads.EMPTY
    assert out[6] == out[7] == payloads.NO_RESULT and out[9] == "no result: Not Found"
    assert out[10] in (payloads.PARTLY, payloads.BROKEN) and out[8] in (payloads.NO_RESULT, payloads.BROKEN)
    held = {r.symbol for r in payloads.bars_of(answers).collect()}
    gone = {r.symbol for r in payloads.refused(answers).collect()}
    assert held <= set(out) - gone and 0 in held
    assert sum(r.answers for r in payloads.outcomes(answers).collect()) == len(texts)
    shown = payloads.refused(answers).where("symbol = 2").first().excerpt
    assert shown == whole[: len(whole) // 2][: payloads.EXCERPT]


def test_answers_are_stored_with_the_refused_ones(spark, tmp_path):
    bars, news, refused = (str(tmp_path / n) for n in ("bars", "news", "refused"))
    asked = date(2024, 1, 2)
    rows = [("A", asked, chart([1699833600, 1699920000], open=[1.0, 2.0])), ("B", asked, '{"chart": {"resu'), ("C", asked, None)]
    rows.append(("A", date(2024, 1, 3), chart([1699920000], open=[3.0])))
    df = spark.createDataFrame(rows, "symbol string, asked date, payload string")
    for _ in range(2):
        counts = {r.outcome: r.answers for r in jobs.store_chart_answers(df, bars, refused).collect()}
    assert counts == {"read": 2, "broken": 1, "empty": 1}
    assert sorted((r.symbol, r.open) for r in spark.read.parquet(bars).collect()) == [("A", 1.0), ("A", 3.0)]
    held = sorted((r.symbol, r.outcome, r.excerpt) for r in spark.read.parquet(refused).collect())
    assert held == [("B", "broken", '{"chart": {"resu'), ("C", "empty", None)]
    body = json.dumps({"data": [{"title": "t", "url": "u", "date": "Fri, 25 Oct 2024 16:00:00 -0400"}]})
    df = spark.createDataFrame([("A", "2024-01-02", body), ("A", "2024-01-03", body[:30])], "ticker string, query_date string, payload string")
    counts = {r.outcome: r.answers for r in jobs.store_news_answers(df, news, refused + "-news").collect()}
    assert counts == {"read": 1, "broken": 1}
    assert [(r.title, r.date) for r in spark.read.parquet(news).collect()] == [("t", datetime(2024, 10, 25, 20))]


def test_dates_in_words(spark):
    texts = {
        "2024-10-25": date(2024, 10, 25),
        "2024-10-25 00:00:00": date(2024, 10, 25),
        "2024-10-25T23:30:00-04:00": date(2024, 10, 26),
        "Fri, 25 Oct 2024 16:00:00 -0400": date(2024, 10, 25),
        "Fri, 25 Oct 2024 22:00:00 EDT": date(2024, 10, 26),
        "Friday, 25 Oct 2024 22:00:00 gmt": date(2024, 10, 25),
        "5 Jan 2024": date(2024, 1, 5),
        "10/5/2024": date(2024, 10, 5),
        "soon": None,
        "": None,
        "2024-13-45": None,
    }
    df = spark.createDataFrame([(t,) for t in [*texts, None]], "date string")
    out = df.select("date", clean.as_date(df, "date").alias("day"), clean.unread_date(df, "date").alias("unread")).collect()
    assert {r.date: r.day for r in out if r.date is not None} == texts
    assert {r.date for r in out if r.unread} == {"soon", "2024-13-45"}
    parsed = {r.date for r in clean.parse_date(df).collect()}
    assert parsed == set(texts.values())


def test_last_date_reads_one_month(spark, tmp_path):
    rows = [("A", date(2024, m, d)) for m in (1, 2, 3) for d in (1, 9)] + [("A", None)]
    bars = spark.createDataFrame(rows, "ticker string, date date")
    path = str(tmp_path / "months")
    spark.sql("DROP TABLE IF EXISTS months_t")
    tables.create_table(spark, "months_t", bars.schema, path)
    assert incremental.last_date(spark, "months_t") is None
    tables.load_table(bars, "months_t", bars.schema, "date")
    assert incremental.last_date(spark, "months_t") == date(2024, 3, 9)
    newest = incremental.newest_month(spark.table("months_t"))
    assert {r.date.month for r in newest.collect()} == {3}
    assert incremental.pending_range(newest, "2024-03-20").first().start_date == date(2024, 3, 10)
    for folder in ("month=2024-01", "month=2024-02"):
        for file in (tmp_path / "months" / folder).glob("*.parquet"):
            file.write_bytes(b"damaged")
    # Only the last month is opened.
    assert incremental.last_date(spark, "months_t") == date(2024, 3, 9)
    spark.sql("DROP TABLE months_t")
    assert incremental.newest_month(bars) is bars


def test_price_files_by_name_and_damage(spark, tmp_path):
    root = tmp_path / "prices"
    for name, symbol in (("A/prices_A.parquet", "A"), ("B/prices_B.parquet", "B"), ("all_1year.parquet", "Z")):
        file = root / name
        file.parent.mkdir(parents=True, exist_ok=True)
        pd.DataFrame({"symbol": [symbol], "date": ["2024-01-02"], "close": [1.0]}).to_parquet(file)
    (root / "C").mkdir()
    (root / "C" / "prices_C.parquet").write_bytes(b"not parquet")
    out = bronze.read_price_files(spark, str(root), BARS_BRONZE, skip_unreadable=True)
    assert sorted(r.symbol for r in out.collect()) == ["A", "B"]
    skipped = bronze.files_without_rows(out, str(root), bronze.PRICE_FILES).collect()
    assert [(r.path.rsplit("/", 1)[1], r.length) for r in skipped] == [("prices_C.parquet", 11)]
    with pytest.raises(Exception, match="prices_C.parquet"):
        bronze.read_price_files(spark, str(root), BARS_BRONZE).collect()
    empty = tmp_path / "empty"
    empty.mkdir()
    (empty / "prices_D.parquet").write_bytes(b"not parquet")
    with pytest.raises(ValueError, match="no readable rows"):
        bronze.read_price_files(spark, str(empty), BARS_BRONZE, skip_unreadable=True)


def test_probed_files_tell_what_is_lost(spark, tmp_path):
    frame = pd.DataFrame({"symbol": ["A"] * 3000, "close": [i * 0.37 % 7 for i in range(3000)]})
    for name in ("whole", "inside", "footer", "long"):
        frame.to_parquet(tmp_path / f"{name}.parquet", row_group_size=1000, index=False)
    (tmp_path / "text.parquet").write_text("no table")
    data = bytearray((tmp_path / "inside.parquet").read_bytes())
    data[200:400] = b"\xff" * 200
    (tmp_path / "inside.parquet").write_bytes(data)
    (tmp_path / "footer.parquet").write_bytes((tmp_path / "footer.parquet").read_bytes()[:-20])
    pd.concat([frame] * 20).to_parquet(tmp_path / "long.parquet", index=False, compression=None)
    limit = (tmp_path / "whole.parquet").stat().st_size * 4
    out = {r.path.rsplit("/", 1)[1]: r for r in bronze.probe_files(spark, str(tmp_path), max_bytes=limit).collect()}
    assert (out["whole.parquet"].rows, out["whole.parquet"].lost_rows, out["whole.parquet"].error) == (3000, 0, None)
    assert (out["inside.parquet"].rows, out["inside.parquet"].lost_rows) == (3000, 1000) and out["inside.parquet"].error
    for name in ("footer.parquet", "text.parquet"):
        assert out[name].rows is None and out[name].error
    assert "longer" in out["long.parquet"].error and len(out) == 5


def test_whole_numbers_are_no_nanoseconds(spark, tmp_path):
    spark.conf.set(bronze.NANOS_AS_LONG, "false")
    pd.DataFrame({"ticker": ["A"], "date": [20240102]}).to_parquet(tmp_path / "a.parquet")
    assert bronze.read_news(spark, str(tmp_path)).first().date == 20240102
    assert spark.conf.get(bronze.NANOS_AS_LONG) == "false"


def test_news_with_nanoseconds_and_differing_columns(spark, tmp_path):
    root = tmp_path / "news"
    root.mkdir()
    stamp = pd.to_datetime(["2024-01-02 03:04:05.123456789"]).astype("datetime64[ns]")
    pd.DataFrame({"ticker": ["A"], "date": stamp}).to_parquet(root / "a.parquet")
    pd.DataFrame({"ticker": ["B"], "title": ["t"]}).to_parquet(root / "b.parquet")
    out = {r.ticker: r for r in bronze.read_news(spark, str(root)).collect()}
    assert out["A"].date == datetime(2024, 1, 2, 3, 4, 5, 123456)
    assert out["A"].title is None and out["B"].date is None


def test_ticker_list(spark, tmp_path):
    file = tmp_path / "tickers.csv"
    file.write_text("Symbol,CompanyName,Abbreviated Company Name\nAAPL,Apple Inc.,Apple\nX,Some Co,\n")
    out = [tuple(r) for r in bronze.read_tickers(spark, str(file)).collect()]
    assert out == [("AAPL", "Apple Inc.", "Apple", None), ("X", "Some Co", None, None)]


def bars(spark, *rows):
    return spark.createDataFrame(rows, "ticker string, date date, close double")


def test_months_are_replaced_not_appended(spark, tmp_path):
    path = str(tmp_path / "bars")
    jan, feb = bars(spark, ("A", date(2024, 1, 2), 1.0)), bars(spark, ("A", date(2024, 2, 2), 2.0))
    tables.write_months(jan.union(feb), path)
    tables.write_months(feb.withColumn("close", F.lit(3.0)), path)
    got = spark.read.parquet(path)
    assert sorted((str(r.date), r.close) for r in got.collect()) == [("2024-01-02", 1.0), ("2024-02-02", 3.0)]
    scan = got.where("month = '2024-02'")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(month" in scan


def test_merge_keeps_other_days_and_prefers_new_rows(spark, tmp_path):
    path = str(tmp_path / "bars")
    order = [F.col("_new").desc()]
    for _ in range(2):
        tables.merge_months(bars(spark, ("A", date(2024, 1, 2), 1.0), ("A", date(2024, 1, 3), 1.0)), path, ["ticker", "date"], order)
    tables.merge_months(bars(spark, ("A", date(2024, 1, 3), 5.0), ("B", date(2024, 2, 1), 7.0)), path, ["ticker", "date"], order)
    got = sorted((r.ticker, r.date.day, r.close) for r in spark.read.parquet(path).collect())
    assert got == [("A", 2, 1.0), ("A", 3, 5.0), ("B", 1, 7.0)]


def test_per_ticker_and_combined_layouts(spark, tmp_path):
    df = bars(spark, ("A", date(2024, 1, 2), 1.0), ("B", date(2024, 1, 2), 2.0))
    tables.write_per_ticker(df, str(tmp_path / "by"))
    assert {p.name for p in (tmp_path / "by").glob("ticker=*")} == {"ticker=A", "ticker=B"}
    tables.write_per_ticker(df.where("ticker = 'B'").withColumn("close", F.lit(9.0)), str(tmp_path / "by"))
    assert sorted(r.close for r in bronze.read_prices(spark, str(tmp_path / "by")).collect()) == [1.0, 9.0]
    tables.write_combined(df, str(tmp_path / "all"))
    assert spark.read.parquet(str(tmp_path / "all")).count() == 2


def test_news_dates_are_coerced(spark):
    df = spark.createDataFrame([("2024-01-02 10:00:00", "soon")], "date string, query_date string")
    row = tables.prepare_news(df).first()
    assert row.date == datetime(2024, 1, 2, 10) and row.query_date is None


def test_silver_table(spark, tmp_path):
    tables.create_table(spark, "silver_prices", SILVER_PRICES, str(tmp_path / "silver"))
    tables.create_table(spark, "silver_prices", SILVER_PRICES, str(tmp_path / "silver"))
    assert incremental.last_date(spark, "silver_prices") is None
    day = date(2024, 1, 2)
    df = bars(spark, ("A", day, 1.0)).withColumn("date_key", F.col("date")).withColumn("other", F.lit(1))
    for _ in range(2):
        tables.load_table(df, "silver_prices", SILVER_PRICES)
    assert spark.table("silver_prices").count() == 1
    assert incremental.last_date(spark, "silver_prices") == day
    with pytest.raises(ValueError, match="other"):
        tables.load_table(df, "silver_prices", SILVER_PRICES, strict=True)
    with pytest.raises(Exception, match="NULL in required column close"):
        tables.load_table(df.withColumn("close", F.lit(None).cast("double")), "silver_prices", SILVER_PRICES)
    with pytest.raises(ValueError, match="does not exist"):
        tables.load_table(df, "nowhere", SILVER_NEWS)
    assert incremental.last_date(spark, "nowhere") is None
    spark.sql("DROP TABLE silver_prices")


def test_loads_keep_other_months_under_any_session_mode(spark, tmp_path):
    mode = "spark.sql.sources.partitionOverwriteMode"
    spark.conf.set(mode, "static")
    try:
        tables.create_table(spark, "silver_months", SILVER_PRICES, str(tmp_path / "silver"))
        for day in (date(2024, 1, 2), date(2024, 2, 2), date(2024, 2, 2)):
            df = bars(spark, ("A", day, 1.0)).withColumn("date_key", F.col("date"))
            tables.load_table(df, "silver_months", SILVER_PRICES)
            tables.write_months(df, str(tmp_path / "months"))
            tables.write_per_ticker(df.withColumn("ticker", F.date_format("date", "MM")), str(tmp_path / "tickers"))
        assert spark.table("silver_months").count() == 2
        assert spark.read.parquet(str(tmp_path / "months")).count() == 2
        assert spark.read.parquet(str(tmp_path / "tickers")).count() == 2
        assert spark.conf.get(mode) == "static"
    finally:
        spark.conf.set(mode, "dynamic")
        spark.sql("DROP TABLE IF EXISTS silver_months")


def test_report_file(spark, tmp_path):
    report = quality.price_report(
        bars(spark, ("A", date(2024, 1, 2), 1.0)).selectExpr("*", "close open", "close high", "close low", "1D volume")
    )
    path = tables.write_report(report, str(tmp_path), "2024-01-31", "prices")
    assert path.endswith("20240131_prices.json")
    assert spark.read.json(path).count() == report.count()


def loaded(spark, *rows):
    return spark.createDataFrame(rows, "ticker string, date date")


def test_pending_range(spark):
    one = incremental.pending_range(loaded(spark, ("A", date(2026, 11, 28))), TODAY).first()
    assert tuple(one) == (date(2026, 11, 29), TODAY)
    none = incremental.pending_range(loaded(spark, ("A", TODAY)), TODAY)
    assert none.count() == 0 and incremental.nothing_pending(none)
    first = incremental.pending_range(loaded(spark), TODAY)
    assert tuple(first.first()) == (date(2025, 12, 1), TODAY)
    assert not incremental.nothing_pending(none, first)


def test_ranges_days_and_resume(spark):
    held = loaded(spark, ("A", date(2026, 11, 28)), ("B", date(2026, 11, 30)), ("C", TODAY))
    tickers = spark.createDataFrame([("A",), ("B",), ("C",), ("D",)], "ticker string")
    ranges = incremental.pending_ranges_by_ticker(tickers, held.where("ticker != 'C'"), TODAY)
    got = {r.ticker: r.start_date for r in ranges.collect()}
    assert got == {"A": date(2026, 11, 29), "B": TODAY, "C": TODAY, "D": TODAY}
    spine = incremental.day_spine(ranges.where("ticker = 'A'"))
    assert [r.date.day for r in spine.orderBy("date").collect()] == [29, 30, 1]
    left = incremental.missing_days(spine, loaded(spark, ("A", date(2026, 11, 30))))
    assert sorted(r.date for r in left.collect()) == [date(2026, 11, 29), TODAY]


def test_layer_paths():
    assert paths.layer_path("s3://x/", "gold", "sentiment_price_daily") == "s3://x/gold/sentiment_prices/daily"
