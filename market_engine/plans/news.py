"""Bronze articles to the Silver news table."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import text
from ..operators import clean, emphasis, quality, sentiment
from ..schemas import SILVER_NEWS
from ..sinks import tables

KEY = ["ticker", "date_key", "url"]
DATA_SOURCE = "stock_news_api"


def article_key() -> list:
    """What tells the articles of the table apart: the url, or the title where there is none."""
    return ["ticker", "date_key", *clean.article_identity()]


def transform(news: DataFrame) -> DataFrame:
    """Valid articles with parsed dates, upper-case tickers and the text to score."""
    quality.require_columns(news)
    if "news_url" in news.columns:
        url = F.coalesce("url", "news_url") if "url" in news.columns else F.col("news_url")
        news = news.withColumn("url", url)
    for optional in ("url", "text", "date", "company_name", "search_source", "endpoint_used"):
        if optional not in news.columns:
            news = news.withColumn(optional, F.lit(None).cast("string"))
    valid = clean.valid_articles(news)
    dated = clean.parse_date(clean.parse_date(valid, "date"), "query_date")
    return dated.withColumns(
        {
            "ticker": F.upper("ticker"),
            "article_date": F.col("date"),
            "query_date_parsed": F.col("query_date"),
            "date_key": F.col("query_date"),
            "sentiment_text": text.sentiment_text(F.col("title"), F.col("text")),
            "data_source": F.lit(DATA_SOURCE),
            "ingestion_timestamp": F.current_timestamp(),
        }
    )


def deduplicated(news: DataFrame, order: list) -> DataFrame:
    """Transformed articles, one per (ticker, date_key, url or title).

    These keys then identify an article and are also how rows are partitioned, so the scores join back
    without moving the texts again.
    """
    return clean.dedup_articles(transform(news), ["ticker", "date_key"], order, keep_identity=True)


def scored(
    unique: DataFrame,
    lexicon: DataFrame,
    load_model: Callable | None = None,
    labels: Sequence[str] = (),
    shifters: DataFrame | None = None,
) -> DataFrame:
    """Both scores, in the columns of the Silver table; with ``shifters`` the word scores follow ``emphasis``."""
    keys = ["ticker", "date_key", *clean.IDENTITY]
    if shifters is None:
        words = sentiment.lexicon_scores(unique, lexicon, keys)
    else:
        words = emphasis.emphatic_scores(unique, lexicon, shifters, keys)
    out = unique.join(words, keys, "left")
    if load_model is not None:
        out = sentiment.model_scores(out, load_model, labels)
    return clean.conform(out.withColumn("sentiment_timestamp", F.current_timestamp()), SILVER_NEWS)


def silver_news(
    news: DataFrame,
    lexicon: DataFrame,
    order: list,
    load_model: Callable | None = None,
    labels: Sequence[str] = (),
) -> DataFrame:
    """The Silver table as one lazy plan, which reads the articles twice; ``jobs.load_news`` reads them once."""
    return scored(deduplicated(news, order), lexicon, load_model, labels)


def merged_news(new: DataFrame, held: DataFrame) -> DataFrame:
    """New and held rows of the Silver table, one per article; of two the new one stays."""
    return tables.merged(new, held, article_key(), [F.col("_new").desc()])
