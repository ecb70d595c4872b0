"""Tickers with enough history."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

MIN_BARS = 200


def date_range(bars: DataFrame) -> DataFrame:
    return bars.agg(F.min("date").alias("min_date"), F.max("date").alias("max_date"))


def completeness(bars: DataFrame, ticker: str = "ticker") -> DataFrame:
    """Rows with a date, first and last date and distinct dates per ticker."""
    return bars.groupBy(ticker).agg(
        F.count("date").alias("record_count"),
        F.min("date").alias("min_date"),
        F.max("date").alias("max_date"),
        F.countDistinct("date").alias("unique_dates"),
    )


def qualified(bars: DataFrame, min_bars: int = MIN_BARS, carry: str | None = None) -> DataFrame:
    """Bars of tickers with at least ``min_bars`` dates, for one bar per day.

    Counting over the ticker window instead of joining a count back reads the bars once, and the
    features that follow reuse its shuffle. Bars before a carried state count as well.
    """
    dates = F.count("date").over(Window.partitionBy("ticker"))
    if carry:
        dates = dates + F.coalesce(F.col(f"{carry}.rows"), F.lit(0))
    return (
        bars.where("ticker IS NOT NULL").withColumn("_dates", dates).where(F.col("_dates") >= min_bars).drop("_dates")
    )
