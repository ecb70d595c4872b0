"""Refreshes from stored states equal loads of the whole history; tables take new columns."""

import random
from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F

from market_engine.operators import carry, features
from market_engine.plans import jobs, prices
from market_engine.schemas import SILVER_PRICES
from market_engine.sinks import tables

from frames import plan_of

START = date(2023, 1, 2)
RAW = "symbol string, date string, open double, high double, low double, close double, volume long, seq long"


def walk(ticker, days, first=0, seed=1, seq=0):
    """A random walk with missing days and closes."""
    rng = random.Random(f"{ticker}{seed}")
    price, rows = 100.0, []
    for i in range(first + days):
        price *= 1 + rng.uniform(-0.05, 0.05)
        spread, gone = rng.uniform(0, 3), rng.random()
        if i >= first and gone > 0.15:
            close = None if gone < 0.17 else price
            rows.append((ticker, (START + timedelta(days=i)).isoformat(), price, price + spread, price - spread, close, 100 + i, seq))
    return rows


def rounded(df):
    columns = [c for c in SILVER_PRICES.fieldNames() if c != "ingestion_timestamp"]
    return sorted(
        tuple(str(round(v, 3) + 0.0) if isinstance(v, float) else str(v) for v in r) for r in df.select(*columns).collect()
    )


def bronze(spark, rows):
    return spark.createDataFrame(rows, RAW)


@pytest.fixture
def places(tmp_path):
    return str(tmp_path / "silver"), str(tmp_path / "states")


def refresh(spark, stored, new, places):
    jobs.refresh_prices_from_states(bronze(spark, stored + new), bronze(spark, new), *places, [F.desc("seq")], 20)


def test_refresh_from_states_equals_a_full_load(spark, places):
    stored = walk("A", 400) + walk("B", 400) + walk("C", 30, first=370) + walk("D", 15, first=385)
    refresh(spark, [], stored, places)
    steps = [
        walk("A", 10, first=400) + walk("D", 10, first=400),
        # a corrected old bar, a ticker that is new, and one that goes on after months without bars
        [(*walk("A", 400)[200][:5], 250.0, 7, 9)] + walk("E", 50, first=360) + walk("B", 20, first=600),
        walk("A", 3, first=410) + walk("C", 200, first=400),
    ]
    for new in steps:
        refresh(spark, stored, new, places)
        stored = stored + new
        want = prices.raw_to_silver(bronze(spark, stored), [F.desc("seq")], 20)
        assert rounded(tables.read_months(spark, places[0])) == rounded(want)
    bars = prices.clean_bars(bronze(spark, stored), [F.desc("seq")]).select(*prices.BAR)
    full = carry.states_of(prices.silver_prices(bars, 20, states=True))
    held = tables.read_months(spark, places[1]).drop("month")

    def values(df):
        return sorted(tuple(f"{v:.6g}" if isinstance(v, float) else str(v) for v in r) for r in df.select(*full.columns).collect())

    assert values(held) == values(full)
    assert dict(full.dtypes) == dict(held.dtypes)
    fields = features.state_type()
    assert all(f"{c}:{t}" in fields for c, t in full.drop("ticker").dtypes)


def test_refresh_reads_only_recent_bars(spark, places):
    stored = walk("A", 900) + walk("B", 900)
    refresh(spark, [], stored, places)
    new = walk("A", 5, first=900)
    states = tables.read_months(spark, places[1])
    since = carry.first_days(bronze(spark, new).withColumnRenamed("symbol", "ticker"))
    starts = carry.starting_points(states.drop("month"), since)
    point = starts.first()
    bars = prices.clean_bars(bronze(spark, stored + new), ["seq"])
    tail = carry.bars_to_read(bars, since, starts)
    days = [r.date for r in tail.select("date").orderBy("date").collect()]
    assert {r.ticker for r in tail.select("ticker").distinct().collect()} == {"A"}
    assert days[0] > point[features.CARRY].date and sum(d < point.since for d in days) >= features.LONGEST_FRAME
    # No more than the frame, the rest of its month and one month.
    assert len(days) <= features.LONGEST_FRAME + 2 * 31 + 5


def test_no_new_bars_change_nothing(spark, places):
    stored = walk("A", 200)
    refresh(spark, [], stored, places)
    before = rounded(tables.read_months(spark, places[0]))
    jobs.refresh_prices_from_states(bronze(spark, stored), bronze(spark, stored).limit(0), *places, ["seq"], 20)
    assert rounded(tables.read_months(spark, places[0])) == before


def test_states_add_no_shuffle(spark, make_bars):
    bars = make_bars([float(i % 7 + 1) for i in range(100)])
    plain, stated = (plan_of(features.compute(bars, features.all_features(), states=s)) for s in (False, True))
    assert plain.count("Exchange") == stated.count("Exchange") and plain.count("Sort [") == stated.count("Sort [")


def test_a_repeated_day_stops_the_job(spark, make_bars):
    bars = make_bars([1.0, 2.0, 3.0])
    with pytest.raises(Exception, match="two bars of ticker T on 2020-01-02"):
        features.compute(bars.union(bars.where("close = 2")), [features.sma()]).collect()


# New columns ----------------------------------------------------------------------------------------


def days(spark, first, n, **more):
    rows = spark.createDataFrame(walk("A", n, first=first), RAW).where("close IS NOT NULL")
    for name, value in more.items():
        rows = rows.withColumn(name, F.lit(value))
    return rows


def test_a_load_adds_the_columns_the_table_lacks(spark):
    spark.sql("DROP TABLE IF EXISTS wide")
    jobs.load_prices(days(spark, 0, 100), "wide", ["seq"], 5)
    before = spark.table("wide").count()
    later = days(spark, 130, 60, adj_close=5.0)
    jobs.load_prices(later, "wide", ["seq"], 5, more=["adj_close"])
    table = spark.table("wide")
    assert table.columns == [c for c in SILVER_PRICES.fieldNames()] + ["adj_close", "month"]
    old, new = table.where("date < '2023-05-01'"), table.where("date > '2023-05-01'")
    assert old.count() == before and old.where("adj_close IS NOT NULL").count() == 0
    assert new.count() > 0 and new.where("adj_close IS NULL").count() == 0
    with pytest.raises(ValueError, match="split"):
        jobs.load_prices(later.withColumn("split", F.lit(1)), "wide", ["seq"], 5, more=["split"], strict=True)
    jobs.load_prices(later.withColumn("ADJ_CLOSE", F.lit(6)), "wide", ["seq"], 5, more=["ADJ_CLOSE"])
    table = spark.table("wide")
    assert {r.adj_close for r in table.select("adj_close").distinct().collect()} == {None, 6.0}
    jobs.load_prices(later, "wide", ["seq"], 5)
    assert spark.table("wide").where("adj_close IS NOT NULL").count() == 0
    untyped = later.withColumn("later_on", F.lit(None))
    jobs.load_prices(untyped, "wide", ["seq"], 5, more=["later_on"])
    assert "later_on" not in spark.table("wide").columns
    spark.sql("DROP TABLE wide")


def test_a_merge_adds_columns_and_keeps_the_held_ones(spark, tmp_path):
    schema = tables.StructType.fromDDL("ticker string, date_key date, v int")
    spark.sql("DROP TABLE IF EXISTS merged_wide")
    tables.create_table(spark, "merged_wide", schema)
    one = spark.createDataFrame([("A", START, 1), ("B", START, 2)], "ticker string, date_key date, v int")
    two = spark.createDataFrame([("A", START, 3, "x")], "ticker string, date_key date, v int, note string")
    for part in (one, two, two):
        tables.merge_table(part, "merged_wide", schema, ["ticker", "date_key"], [F.col("_new").desc()])
    assert sorted(tuple(r)[::2] for r in spark.table("merged_wide").select("ticker", "date_key", "v", "month", "note").collect()) == [
        ("A", 3, "x"),
        ("B", 2, None),
    ]
    spark.sql("DROP TABLE merged_wide")
    path = str(tmp_path / "months")
    for part in (one, two.withColumn("date_key", F.date_add("date_key", 60)), two):
        tables.merge_months(part, path, ["ticker", "date_key"], [F.col("_new").desc()], "date_key")
    assert sorted((r.ticker, r.v, r.note) for r in tables.read_months(spark, path).collect()) == [
        ("A", 3, "x"),
        ("A", 3, "x"),
        ("B", 2, None),
    ]
