"""Loads by day, read as one row per key before and after compaction."""

from datetime import date, timedelta

from pyspark.sql import functions as F

from market_engine.plans import jobs
from market_engine.sinks import deltas

START = date(2024, 1, 1)


def bars(spark, *rows):
    return spark.createDataFrame([(s, START + timedelta(days=d) if d is not None else None, c) for s, d, c in rows], "symbol string, date date, close double")


def held(df):
    return sorted((r.symbol, (r.date - START).days if r.date else -1, r.close) for r in df.collect())


def test_loads_and_compaction(spark, tmp_path):
    path = str(tmp_path / "bars")
    assert jobs.added_bars(spark, path) is None and jobs.compact_bars(spark, path) == []
    jobs.add_bars(bars(spark, ("A", 0, 1.0), ("A", 40, 2.0), ("B", 0, 3.0), ("B", 0, 9.0), ("N", None, 1.0)), path)
    before = {f: f.stat().st_mtime_ns for f in (tmp_path / "bars" / "data").rglob("*.parquet")}
    jobs.add_bars(bars(spark, ("A", 1, 4.0)), path)
    new = [f for f in (tmp_path / "bars" / "data").rglob("*.parquet") if f not in before]
    # One day's load writes that day and touches nothing else.
    assert len(new) == 1 and all(f.stat().st_mtime_ns == t for f, t in before.items())
    jobs.add_bars(bars(spark, ("A", 0, 5.0), ("N", None, 2.0)), path)
    want = [("A", 0, 5.0), ("A", 1, 4.0), ("A", 40, 2.0), ("B", 0, 3.0), ("N", -1, 2.0)]
    assert held(jobs.added_bars(spark, path)) == want
    assert sorted(jobs.compact_bars(spark, path)) == ["2024-01", "none"]
    assert held(jobs.added_bars(spark, path)) == want
    assert all(len(p) == 1 for p in deltas.live(deltas.contents(spark, path)).values())
    assert len(deltas.superseded(spark, path)) == 5 and jobs.compact_bars(spark, path) == []
    jobs.add_bars(bars(spark, ("B", 0, 7.0)), path)
    assert ("B", 0, 7.0) in held(jobs.added_bars(spark, path)) and jobs.added_bars(spark, path).count() == 5


def test_a_load_during_compaction_is_not_lost(spark, tmp_path):
    path = str(tmp_path / "bars")
    for close in (1.0, 2.0):
        jobs.add_bars(bars(spark, ("A", 0, close)), path)
    upto = max(p.upto for p in deltas.contents(spark, path))
    rows = deltas.read(spark, path, jobs.BAR_KEYS)
    jobs.add_bars(bars(spark, ("A", 0, 3.0)), path)
    deltas._write(rows.withColumn("close", F.lit(2.0)), path, None, upto, "date", "symbol")
    assert held(jobs.added_bars(spark, path)) == [("A", 0, 3.0)]


def test_files_that_are_not_listed_do_not_count(spark, tmp_path):
    path = str(tmp_path / "bars")
    jobs.add_bars(bars(spark, ("A", 0, 1.0)), path)
    bars(spark, ("A", 0, 2.0)).withColumn("month", F.lit("2024-01")).write.partitionBy("month").parquet(f"{path}/data/{'0' * 32}")
    assert held(jobs.added_bars(spark, path)) == [("A", 0, 1.0)]
    jobs.add_bars(bars(spark), path)
    assert held(jobs.added_bars(spark, path)) == [("A", 0, 1.0)]


def test_new_columns_and_plain_months(spark, tmp_path):
    path = str(tmp_path / "bars")
    jobs.add_bars(bars(spark, ("A", 0, 1.0), ("A", 40, 1.0)), path)
    jobs.add_bars(bars(spark, ("A", 1, 1.0)).withColumn("note", F.lit("x")), path)
    out = jobs.added_bars(spark, path)
    assert sorted((r.date.month, r.date.day, r.note) for r in out.collect()) == [(1, 1, None), (1, 2, "x"), (2, 10, None)]
    jobs.compact_bars(spark, path)
    plan = jobs.added_bars(spark, path)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Window" not in plan


def test_news_loads(spark, tmp_path):
    path = str(tmp_path / "news")
    schema = "ticker string, query_date string, title string, url string"
    jobs.add_news(spark.createDataFrame([("A", "2024-01-01", "old", "u"), ("A", "2024-01-01", "t", None)], schema), path)
    jobs.add_news(spark.createDataFrame([("A", "2024-01-01", "new", "u"), ("A", "no date", "x", "v")], schema), path)
    want = ["new", "t", "x"]
    assert sorted(r.title for r in jobs.added_news(spark, path).collect()) == want
    assert jobs.compact_news(spark, path) == ["2024-01"]
    assert sorted(r.title for r in jobs.added_news(spark, path).collect()) == want
