"""Counts and summaries of bars and articles."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SEARCH_SOURCES = ("ticker", "company_name", "abbrev1", "abbrev2")


def null_profile(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """NULL count and percentage of each column, in one pass."""
    columns = list(columns or df.columns)
    counted = df.agg(
        F.count("*").alias("_rows"), *[F.count_if(F.col(c).isNull()).alias(f"_{i}") for i, c in enumerate(columns)]
    )
    pairs = [F.struct(F.lit(c).alias("column_name"), F.col(f"_{i}").alias("null_count")) for i, c in enumerate(columns)]
    return counted.select("_rows", F.inline(F.array(*pairs))).select(
        "column_name",
        "null_count",
        F.coalesce(F.try_divide(F.col("null_count") * 100.0, F.col("_rows")), F.lit(0.0)).alias("null_percentage"),
    )


def distinct_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.agg(*[F.countDistinct(c).alias(f"unique_{c}") for c in columns])


def rows_per_key(df: DataFrame, *keys: str) -> DataFrame:
    return df.groupBy(*keys).agg(F.count("*").alias("rows"))


def repeated_keys(df: DataFrame, *keys: str) -> DataFrame:
    """Keys held by more than one row; NULLs count as one value."""
    return rows_per_key(df, *keys).where("rows > 1")


def repeated_key_count(df: DataFrame, *keys: str) -> DataFrame:
    return repeated_keys(df, *keys).agg(F.count("*").alias("repeated_keys"))


def duplicate_profile(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows in repeated groups (NULL keys equal), and size figures of the groups without NULL keys."""
    groups = repeated_keys(df, *keys)
    complete = F.lit(True)
    for key in keys:
        complete = complete & F.col(key).isNotNull()
    size = F.when(complete, F.col("rows"))
    return groups.agg(
        F.coalesce(F.sum("rows"), F.lit(0)).alias("duplicate_rows"),
        F.count(size).alias("duplicate_groups"),
        F.coalesce(F.avg(size), F.lit(0.0)).alias("avg_group_rows"),
        F.coalesce(F.max(size), F.lit(0)).alias("max_group_rows"),
    )


def duplicate_sample(df: DataFrame, keys: Sequence[str], n: int = 5) -> DataFrame:
    return repeated_keys(df.dropna(subset=list(keys)), *keys).orderBy(*keys).limit(n)


def articles_per_ticker(news: DataFrame) -> DataFrame:
    """The tickers with most articles first."""
    return news.groupBy("ticker").agg(F.count("*").alias("articles")).orderBy(F.desc("articles"), "ticker")


def article_totals(news: DataFrame) -> DataFrame:
    total, tickers = F.count("*"), F.countDistinct("ticker")
    return news.agg(
        total.alias("total_articles"),
        tickers.alias("unique_tickers"),
        F.try_divide(total, tickers).alias("articles_per_ticker"),
    )


def price_summary(prices: DataFrame) -> DataFrame:
    return prices.agg(
        F.count("*").alias("total_records"),
        F.countDistinct("ticker").alias("unique_tickers"),
        F.countDistinct("date").alias("unique_dates"),
        F.min("date").alias("min_date"),
        F.max("date").alias("max_date"),
        F.avg("close").alias("avg_close"),
        F.avg("volume").alias("avg_volume"),
    )


def news_summary(news: DataFrame) -> DataFrame:
    def labelled(label: str) -> Column:
        return F.count_if(F.col("finbert_label") == label).alias(f"{label}_count")

    return news.agg(
        F.count("*").alias("total_articles"),
        F.countDistinct("ticker").alias("unique_tickers"),
        F.countDistinct("date_key").alias("unique_dates"),
        F.avg("finbert_score").alias("avg_finbert_score"),
        F.avg("vader_compound").alias("avg_vader_compound"),
        labelled("positive"),
        labelled("negative"),
        labelled("neutral"),
    )


def search_source_mix(news: DataFrame) -> DataFrame:
    """Articles per ticker and search source, with percentages; an untagged article counts as found by ticker."""
    source = F.coalesce("search_source", F.lit("ticker"))
    counts = news.groupBy("ticker").agg(
        F.count("*").alias("articles"),
        *[F.count_if(source == name).alias(f"{name}_count") for name in SEARCH_SOURCES],
    )
    return counts.withColumns(
        {f"{name}_pct": F.col(f"{name}_count") * 100.0 / F.col("articles") for name in SEARCH_SOURCES}
    )
