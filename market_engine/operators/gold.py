"""Daily sentiment joined to prices."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .joins import lookup_table


def daily_sentiment(news: DataFrame) -> DataFrame:
    """One row per ticker and day."""
    def labelled(label: str):
        return F.count_if(F.col("finbert_label") == label).alias(f"{label}_count")

    return news.groupBy("ticker", "date_key").agg(
        F.count("*").alias("articles"),
        F.avg("finbert_score").alias("avg_finbert_score"),
        F.avg("vader_compound").alias("avg_vader_compound"),
        labelled("positive"),
        labelled("negative"),
        labelled("neutral"),
    )


def sentiment_prices(prices: DataFrame, daily: DataFrame) -> DataFrame:
    """All prices, with the sentiment of their day where there were articles.

    Both sides have one row per key. If ``prices`` are bars fresh from a per-day aggregation the join
    needs no further shuffle of them.
    """
    keyed = prices if "date_key" in prices.columns else prices.withColumn("date_key", F.col("date"))
    return keyed.join(daily, ["ticker", "date_key"], "left").withColumn(
        "articles", F.coalesce("articles", F.lit(0))
    )


def on_trading_days(news: DataFrame, prices: DataFrame) -> DataFrame:
    """The articles with the day of the next prices of their ticker, their own day included, as ``date_key``.

    Articles of a weekend thus count for the day that trades on them; their own day stays as ``article_day``. Those
    after a ticker's last prices keep their day. Days are looked up once per ticker and day: the days of both
    tables together, in order, with the next day that has prices carried back.
    """
    keyed = prices if "date_key" in prices.columns else prices.withColumn("date_key", F.col("date"))
    trading = keyed.select("ticker", "date_key", F.col("date_key").alias("_trading"))
    asked = news.select("ticker", "date_key").distinct().withColumn("_trading", F.lit(None).cast("date"))
    onwards = Window.partitionBy("ticker").orderBy("date_key", F.col("_trading").asc_nulls_first())
    following = F.first("_trading", ignorenulls=True).over(onwards.rowsBetween(0, Window.unboundedFollowing))
    days = trading.unionByName(asked).withColumn("_next", following).where("_trading IS NULL")
    table = lookup_table(days, ["ticker", "date_key"], F.min("_next").alias("_next"))
    moved = news.join(table, ["ticker", "date_key"], "left").withColumn("article_day", F.col("date_key"))
    return moved.withColumn("date_key", F.coalesce("_next", "date_key")).drop("_next")


def sentiment_correlation(
    joined: DataFrame, score: str = "avg_vader_compound", change: str = "price_change_pct", lag_days: int = 0
) -> DataFrame:
    """Correlation per ticker of sentiment, ``lag_days`` rows earlier, with the price change."""
    if lag_days:
        earlier = F.lag(score, lag_days).over(Window.partitionBy("ticker").orderBy("date_key"))
        joined = joined.withColumn(score, earlier)
    pairs = joined.where(F.col(score).isNotNull() & F.col(change).isNotNull())
    # A ticker whose sentiment or price never moved has no correlation.
    spread = F.stddev_pop(score) * F.stddev_pop(change)
    return pairs.groupBy("ticker").agg(
        F.count("*").alias("days"), F.try_divide(F.covar_pop(score, change), spread).alias("correlation")
    )


def sentiment_trend(daily: DataFrame, score: str = "avg_vader_compound", days: int = 7) -> DataFrame:
    """Mean of the last ``days`` days that have articles."""
    frame = Window.partitionBy("ticker").orderBy("date_key").rowsBetween(-(days - 1), 0)
    return daily.withColumn("sentiment_trend", F.avg(score).over(frame))


def training_rows(joined: DataFrame, horizon: int = 1) -> DataFrame:
    """Features of a day with the change that followed; the last rows of a ticker have no outcome yet."""
    later = F.lead("close", horizon).over(Window.partitionBy("ticker").orderBy("date_key"))
    change = F.try_divide(later - F.col("close"), F.col("close")) * 100
    rose = F.when(F.col("next_change_pct") > 0, 1).when(F.col("next_change_pct").isNotNull(), 0)
    return joined.withColumn("next_change_pct", change).withColumn("next_up", rose)
