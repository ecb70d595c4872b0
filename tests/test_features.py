import math
import random
import re
import statistics
from datetime import date, timedelta

import pytest
from frames import column, plan_of
from pyspark.sql import Window
from pyspark.sql import functions as F

from market_engine.operators import clean, features, recurrence, windows
from market_engine.plans import prices
from market_engine.schemas import SILVER_PRICES


def near(values, expected, tolerance=1e-6):
    assert len(values) == len(expected)
    for got, want in zip(values, expected):
        assert (got is None) == (want is None), (values, expected)
        if want is not None:
            assert math.isclose(got, want, rel_tol=tolerance, abs_tol=1e-9), (got, want)


def fold_ema(closes, n):
    alpha, value, out = 2 / (n + 1), None, []
    for x in closes:
        if x is not None:
            value = x if value is None else x * alpha + value * (1 - alpha)
        out.append(value)
    return out


def fold_rsi(closes, n=14):
    gains, losses, out = [], [], []
    up = down = None
    for i, x in enumerate(closes):
        before = closes[i - 1] if i else None
        change = x - before if x is not None and before is not None else None
        gains.append(max(change, 0.0) if change is not None else 0.0)
        losses.append(max(-change, 0.0) if change is not None else 0.0)
        if i < n:
            up, down = statistics.fmean(gains), statistics.fmean(losses)
        else:
            up, down = (up * (n - 1) + gains[-1]) / n, (down * (n - 1) + losses[-1]) / n
        out.append(100 - 100 / (1 + up / down) if down else None)
    return out


def test_ema_small(make_bars):
    out = features.compute(make_bars([1.0, 2.0, 4.0, 8.0]), [features.ema([5])])
    near(column(out, "ema_5"), [1, 1.333333, 2.222222, 4.148148])


def test_ema_repeats_over_nulls(make_bars):
    out = features.compute(make_bars([None, 1.0, 2.0, None, 4.0]), [features.ema([5, 1])])
    near(column(out, "ema_5"), [None, 1, 1.333333, 1.333333, 2.222222])
    near(column(out, "ema_1"), [None, 1, 2, 2, 4])


@pytest.mark.parametrize("seed", [1, 2])
def test_averages_match_a_direct_fold_over_many_blocks(make_bars, seed):
    rnd = random.Random(seed)
    closes = [None if rnd.random() < 0.05 else rnd.uniform(1, 1000) for _ in range(3500)]
    out = features.compute(make_bars(closes), [features.ema([2, 5, 50]), features.rsi()]).orderBy("date").collect()
    for n in (2, 5, 50):
        near([r[f"ema_{n}"] for r in out], fold_ema(closes, n), 1e-10)
    near([r["rsi_14"] for r in out], fold_rsi(closes), 1e-9)


def test_block_length_keeps_powers_finite():
    for decay in (0.01, 1 / 3, 2 / 3, 0.96, 13 / 14):
        assert decay ** -recurrence.block_days([decay]) < 1e300


def test_partition_count_does_not_matter(spark, make_bars):
    rnd = random.Random(3)
    frames = [make_bars([rnd.uniform(1, 9) for _ in range(60)], ticker=f"T{i}") for i in range(4)]
    bars = frames[0]
    for other in frames[1:]:
        bars = bars.union(other)
    parts = [features.ema(), features.returns(), features.macd()]
    results = []
    for n in (1, 7):
        spark.conf.set("spark.sql.shuffle.partitions", n)
        results.append(sorted(map(tuple, features.compute(bars.repartition(n), parts).collect())))
    spark.conf.set("spark.sql.shuffle.partitions", 4)
    assert results[0] == results[1]


def test_partial_frames_and_min_periods(make_bars):
    bars = make_bars([10.0, 20.0, 30.0])
    near(column(features.compute(bars, [features.sma([5])]), "sma_5"), [10, 15, 20])
    near(column(features.compute(bars, [features.sma([5], min_periods=3)]), "sma_5"), [None, None, 20])


def test_single_value_has_no_deviation(make_bars):
    out = features.compute(make_bars([10.0, 11.0]), [features.bollinger()])
    near(column(out, "bb_upper"), [None, 10.5 + 2 * statistics.stdev([10, 11])])


def test_rsi_small(make_bars):
    near(column(features.compute(make_bars([10.0, 11.0, 10.5]), [features.rsi()]), "rsi_14"), [None, None, 66.666667])
    near(column(features.compute(make_bars([1.0, 2.0, 3.0]), [features.rsi()]), "rsi_14"), [None, None, None])


def test_zero_prices_give_null_not_errors(make_bars):
    bars = make_bars([0.0, 5.0, 0.0, 2.0], volume=[0.0, 0.0, 1.0, 1.0])
    row = features.compute(bars, features.all_features()).orderBy("date").collect()
    assert row[0]["daily_range_pct"] is None and row[0]["volume_ratio"] is None and row[0]["vwap_20d"] is None
    assert row[1]["price_change_pct"] is None and row[1]["log_return"] is None
    assert row[2]["log_return"] is None


def test_null_close_counts_volume(make_bars):
    out = features.compute(make_bars([10.0, None], volume=[1.0, 3.0]), [features.volume()])
    near(column(out, "vwap_cumulative"), [10, 2.5])


def test_drawdown_and_momentum(make_bars):
    near(column(features.compute(make_bars([10.0, 8.0, 12.0]), [features.drawdown()]), "drawdown"), [0, -0.2, 0])
    out = features.compute(make_bars([float(i) for i in range(1, 8)]), [features.momentum()])
    near(column(out, "momentum_5d"), [None] * 5 + [5, 5])
    near(column(out, "momentum_5d_pct"), [None] * 5 + [500, 250])


def test_candles(make_bars):
    bars = make_bars(
        [9.0, 10.5, 100.0, 5.0],
        open=[10.0, 8.5, 100.05, 5.0],
        high=[10.5, 11.0, 101.0, 5.0],
        low=[8.5, 8.0, 99.0, 5.0],
    )
    out = features.compute(bars, [features.candles()])
    assert column(out, "is_bullish_engulfing") == [0, 1, 0, 0]
    assert column(out, "is_doji") == [0, 0, 1, 1]
    near(column(out, "price_position"), [0.25, 2.5 / 3, 0.5, 0.5])


def test_hammer_uses_the_far_end_of_the_body(make_bars):
    bars = make_bars([10.0], open=[10.2], high=[10.2], low=[9.0])
    # Lower wick 1.2 from the open, body 0.2; the upper wick counts from the same end.
    assert column(features.compute(bars, [features.candles()]), "is_hammer") == [1]


def test_macd_with_exponential_signal(make_bars):
    closes = [float(10 + (i * 7) % 5) for i in range(40)]
    out = features.macd_with_ema_signal(make_bars(closes))
    lines = [a - b for a, b in zip(fold_ema(closes, 12), fold_ema(closes, 26))]
    near(column(out, "macd"), lines, 1e-9)
    near(column(out, "macd_signal"), fold_ema(lines, 9), 1e-9)


def test_invariants(make_bars):
    rnd = random.Random(5)
    closes = [rnd.uniform(5, 50) for _ in range(300)]
    bars = make_bars(closes, high=[c + 1 for c in closes], low=[c - 1 for c in closes])
    for r in features.compute(bars, features.all_features()).collect():
        assert r["rsi_14"] is None or 0 <= r["rsi_14"] <= 100
        assert r["drawdown"] <= 0 and r["support_20d"] <= r["close"] <= r["resistance_20d"]
        assert r["bb_upper"] is None or r["bb_lower"] <= r["bb_middle"] <= r["bb_upper"]


def test_all_features_share_one_shuffle_and_one_sort(make_bars):
    plan = plan_of(features.compute(make_bars([1.0, 2.0]), features.all_features()))
    assert len(re.findall(r"Exchange hashpartitioning\(ticker", plan)) == 1
    assert plan.count("Exchange") == 1
    assert len(re.findall(r"\+- \*?(?:\(\d+\) )?Sort \[ticker", plan)) == 1
    assert "PythonUDF" not in plan and "ArrowEvalPython" not in plan


def test_qualification_reuses_the_feature_shuffle(make_bars):
    plan = plan_of(prices.silver_prices(make_bars([1.0, 2.0]), 1))
    assert plan.count("Exchange") == 1 and "Join" not in plan


def test_unused_features_are_pruned(make_bars):
    out = features.compute(make_bars([1.0, 2.0]), features.all_features()).select("ticker", "date", "sma_5")
    assert "collect_list" not in plan_of(out)


def test_ticker_filter_passes_below_the_windows(make_bars, spark, tmp_path):
    make_bars([1.0, 2.0]).write.parquet(str(tmp_path / "bars"))
    out = features.compute(spark.read.parquet(str(tmp_path / "bars")), [features.sma()]).where("ticker = 'T'")
    assert "PushedFilters: [IsNotNull(ticker), EqualTo(ticker,T)]" in plan_of(out)


def test_silver_layout(make_bars):
    out = prices.silver_prices(make_bars([float(i) for i in range(1, 30)]), 20)
    assert out.columns == SILVER_PRICES.fieldNames()
    assert [f.dataType for f in out.schema] == [f.dataType for f in SILVER_PRICES]
    wide = prices.silver_prices(make_bars([1.0]), 1, keep_intermediate=True)
    assert set(wide.columns) - set(out.columns) == {"ema_9", "ema_12", "ema_26", "bb_std", "running_max"}
    assert len(wide.columns) == 68


def test_short_histories_drop_out(make_bars):
    bars = make_bars([1.0] * 5, ticker="A").union(make_bars([1.0] * 3, ticker="B"))
    assert {r.ticker for r in prices.silver_prices(bars, 4).collect()} == {"A"}


def test_gaps(spark):
    days = [date(2024, 1, 1), date(2024, 1, 8), date(2024, 1, 16), date(2024, 1, 16)]
    df = spark.createDataFrame([("T", d) for d in days], "ticker string, date date")
    assert [(r.gap_start, r.gap_days) for r in windows.date_gaps(df).collect()] == [(days[1], 8)]
    assert windows.date_gaps(df, 1).count() == 2


def test_raw_bars_are_cleaned_before_features(spark):
    start = date(2024, 1, 1)
    rows = [("T", (start + timedelta(days=i)).isoformat(), 10.0, 9.0, 11.0, 12.0, 5, i) for i in range(3)]
    rows.append(("T", start.isoformat(), 99.0, 99.0, 99.0, 99.0, 5, 100))
    raw = spark.createDataFrame(
        rows, "symbol string, date string, open double, high double, low double, close double, volume long, seq long"
    )
    out = prices.raw_to_silver(raw, ["seq"], 3).orderBy("date").collect()
    assert len(out) == 3
    assert [(r.high, r.low, r.close, r.daily_range) for r in out] == [(12.0, 10.0, 12.0, 2.0)] * 3


def test_bad_date_text_becomes_null(spark):
    df = spark.createDataFrame([("2024-01-05",), ("soon",)], "date string")
    assert [r.date for r in clean.parse_date(df).collect()] == [date(2024, 1, 5), None]


def test_only_daily_bars_are_accepted(make_bars):
    from pyspark.sql import functions as F

    with pytest.raises(TypeError, match="DATE"):
        features.compute(make_bars([1.0]).withColumn("date", F.col("date").cast("timestamp")), [features.sma()])


def test_single_block_and_many_blocks_agree(make_bars):
    closes = [float(1 + (i * 13) % 17) for i in range(2200)]
    long = features.compute(make_bars(closes), [features.ema([10])]).orderBy("date").collect()
    # The same averages with a steeper one alongside, which shortens the blocks of all.
    short = features.compute(make_bars(closes), [features.ema([2, 10])]).orderBy("date").collect()
    near([r.ema_10 for r in short], [r.ema_10 for r in long], 1e-12)


def test_long_frames_are_put_together_from_parts(make_bars):
    """No frame of many rows is added up anew for every row, and enough tasks share the work however few bytes it is."""
    out = prices.silver_prices(make_bars([1.0, 2.0]), 1)
    frames = [int(n) for n in re.findall(r"RowFrame, -(\d+), currentrow", plan_of(out))]
    assert frames and max(frames) < 10
    assert "REPARTITION_BY_NUM" in plan_of(out)


def test_parts_agree_with_plain_frames(make_bars):
    """With missing closes and volumes, short frames at the start and frames that no part divides."""
    closes = [None if i % 7 == 3 or 30 <= i < 42 else 100 + (i * 37 % 11) / 7 for i in range(90)]
    volumes = [None if i % 13 == 5 else float(i * 17 % 23) for i in range(90)]
    bars = make_bars(closes, volume=volumes)
    found = features.compute(bars, [*features.all_features(), features.sma((7, 15), 4)], keep_intermediate=True)
    for name, agg, value, n in (
        ("sma_7", F.avg, "close", 7),
        ("sma_15", F.avg, "close", 15),
        ("sma_10", F.avg, "close", 10),
        ("sma_50", F.avg, "close", 50),
        ("volume_sma_20", F.avg, "volume", 20),
        ("volatility_20d", F.stddev_samp, "price_change_pct", 20),
        ("support_50d", F.min, "low", 50),
        ("resistance_20d", F.max, "high", 20),
        ("bb_std", F.stddev_samp, "close", 20),
    ):
        frame = Window.partitionBy("ticker").orderBy("date").rowsBetween(1 - n, 0)
        plain = agg(value).over(frame)
        if name in ("sma_7", "sma_15"):
            plain = F.when(F.count(value).over(frame) >= 4, plain)
        rows = found.select(F.col(name).alias("got"), plain.alias("want")).collect()
        near([r.got for r in rows], [r.want for r in rows], 1e-12)


def test_equal_values_deviate_by_exactly_nothing(make_bars):
    rows = features.compute(make_bars([0.1] * 33 + [None, 0.1]), [features.bollinger(), features.returns()]).collect()
    assert {r.bb_width for r in rows} == {None, 0.0} and {r.bb_percent_b for r in rows} == {None}
    assert {r.sharpe_ratio_60d for r in rows} == {None}


def test_rounding_is_that_of_decimals(spark):
    values = [None, float("nan"), float("inf"), 0.0, -0.0, 0.00005, -0.00005, 1.00005, 2.00015, -1e-9, 1e300, 1e15 + 0.5, 0.49999999999999994e-4]
    values += [(i + 0.5) / 10**4 * (1 + e * 2.0**-52) for i in range(-300, 300, 7) for e in (-2, -1, 0, 1, 2)]
    df = spark.createDataFrame([(v,) for v in values], "x double")
    for places in (0, 4, 8):
        want = df.select(F.round("x", places).cast("string").alias("x")).collect()
        assert clean.round_numbers(df, places).select(F.col("x").cast("string")).collect() == want
