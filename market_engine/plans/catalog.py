"""Named queries over the sample tables, one or more per operator."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import ohlc, text
from ..operators import (
    candidates,
    carry,
    clean,
    emphasis,
    features,
    gold,
    incremental,
    qualify,
    quality,
    sentiment,
    summaries,
    windows,
)
from ..session import shared_folder
from ..sinks import tables
from ..sources import bronze, payloads
from . import jobs
from . import news as news_plan
from . import prices as price_plan
from . import sample_tables as sample

Query = Callable[[SparkSession, str], DataFrame]

LINE_ORDER = ["l_orderkey", "l_linenumber", "l_partkey"]
LABELS = ("positive", "negative", "neutral")
# The sample tickers all have more than the usual 200 days; at this limit some drop out.
SAMPLE_MIN_BARS = 530
TODAY = "2001-11-10"
REFRESH_FROM = "1998-06-01"
CORRECTED_FROM = "1997-03-10"
KEY = ["ticker", "date"]

QUERIES: dict[str, Query] = {}


def query(build: Query) -> Query:
    QUERIES[build.__name__] = build
    return build


def rounded(df: DataFrame, places: int = 4) -> DataFrame:
    return clean.round_numbers(df, places)


# Ratios of small whole numbers often end in a 5, where two ways of adding may round apart; more places
# keep clear of that.
RATIO_PLACES = {"volume_vwap": 8}


def _register_features() -> None:
    groups = {
        "price_change": features.price_change,
        "sma": features.sma,
        "ema": features.ema,
        "volatility": features.volatility,
        "volume_vwap": features.volume,
        "rsi": features.rsi,
        "momentum": features.momentum,
        "bollinger": features.bollinger,
        "macd": features.macd,
        "returns_sharpe": features.returns,
        "drawdown": features.drawdown,
        "candle_patterns": features.candles,
        "support_resistance": features.support_resistance,
    }
    for name, make in groups.items():

        def build(spark: SparkSession, folder: str, name=name, make=make) -> DataFrame:
            # Columns need a running session, so the group is made only now.
            out = features.compute(sample.bars(spark, folder), [make()])
            return rounded(out.drop("open", "high", "low", "close", "volume"), RATIO_PLACES.get(name, 4))

        QUERIES[name] = build


_register_features()


# Prices ---------------------------------------------------------------------------------------------


@query
def completeness(spark, folder):
    return qualify.completeness(sample.dirty_bars(spark, folder), "symbol")


@query
def date_range(spark, folder):
    return qualify.date_range(sample.dirty_bars(spark, folder))


@query
def qualified_bars(spark, folder):
    return rounded(qualify.qualified(sample.bars(spark, folder), SAMPLE_MIN_BARS))


@query
def one_ticker(spark, folder):
    """The slice itself is the operator: the filter reaches the scan from above the windows."""
    out = features.compute(sample.bars(spark, folder), [features.sma()])
    return rounded(out.where("ticker = 'SRC7'"))


@query
def sma_min_periods(spark, folder):
    out = features.compute(sample.bars(spark, folder), [features.sma((5, 50), min_periods=5)])
    return rounded(out.select(*KEY, "sma_5", "sma_50"))


@query
def macd_ema_signal(spark, folder):
    out = features.macd_with_ema_signal(sample.bars(spark, folder))
    return rounded(out.select(*KEY, "macd", "macd_signal", "macd_histogram"))


@query
def sorted_prices(spark, folder):
    """In (ticker, date) order, which takes a range shuffle."""
    out = features.compute(sample.bars(spark, folder), [features.drawdown()])
    return rounded(out.select(*KEY, "close", "drawdown").orderBy(*KEY))


@query
def silver_prices(spark, folder):
    return price_plan.silver_prices(sample.bars(spark, folder), SAMPLE_MIN_BARS, stamp=False)


@query
def price_features_all(spark, folder):
    """All columns the feature chain makes, helper averages included, without a history limit."""
    bars = sample.bars(spark, folder, price_plan.feature_tasks(spark))
    return price_plan.silver_prices(bars, 1, keep_intermediate=True, stamp=False, dealt=True)


@query
def raw_to_silver(spark, folder):
    """Repeated and broken bars through cleaning and features."""
    out = price_plan.raw_to_silver(sample.dirty_bars(spark, folder), LINE_ORDER, SAMPLE_MIN_BARS)
    return out.drop("ingestion_timestamp")


@query
def refreshed_prices(spark, folder):
    """The table of all but the last days, brought up to date; tickers that reach the history limit only now are added."""
    bars = sample.bars(spark, folder)
    old = price_plan.silver_prices(bars.where(F.col("date") < F.lit(REFRESH_FROM).cast("date")), SAMPLE_MIN_BARS, stamp=False)
    now = price_plan.silver_prices(bars, SAMPLE_MIN_BARS, stamp=False)
    due = price_plan.refreshed(now, old.select("ticker"), F.lit(REFRESH_FROM).cast("date"))
    return tables.merged(due, old, KEY, [F.col("_new").desc()])


@query
def prices_from_states(spark, folder):
    """The table of all but the last days, brought up to date from its month-end states.

    Every third ticker also gets an old day and all that follow corrected.
    """
    bars = sample.bars(spark, folder)
    corrected = F.substring("ticker", 4, 9).cast("int") % 3 == 0
    since = F.when(corrected, CORRECTED_FROM).otherwise(REFRESH_FROM).cast("date")
    wrong = F.when(F.col("date") >= since, F.col("close") * 1.5).otherwise(F.col("close"))
    before = bars.where(F.col("date") < F.lit(REFRESH_FROM).cast("date")).withColumn("close", wrong)
    old = price_plan.silver_prices(before, SAMPLE_MIN_BARS, stamp=False, states=True)
    new = carry.first_days(bars.where(F.col("date") >= since))
    starts = carry.starting_points(carry.states_of(old), new)
    due = price_plan.silver_from_states(bars, new, starts, SAMPLE_MIN_BARS, stamp=False)
    return tables.merged(due.drop(features.STATE), old.drop(features.STATE), KEY, [F.col("_new").desc()])


@query
def merged_fields(spark, folder):
    """A month table whose second load brings one more column; it begins within a month of the first load."""
    bars = sample.bars(spark, folder).select(*KEY, "close", "volume")
    later = F.col("date") >= F.lit("1998-06-15").cast("date")
    path = shared_folder(spark, "merged-fields")
    for part in (bars.where(~later).drop("volume"), bars.where(later)):
        tables.merge_months(part, path, KEY, [F.col("_new").desc()])
    return rounded(tables.read_months(spark, path).select(*KEY, "close", "volume"))


@query
def bars_of_loads(spark, folder):
    """A table of three loads, compacted after the second: bars of all days, some corrected, and the last month again."""
    bars = sample.bars(spark, folder).select(F.col("ticker").alias("symbol"), "date", "close")
    path = shared_folder(spark, "loads")
    again = F.month("date") == 3
    jobs.add_bars(bars.withColumn("close", F.when(again, -1.0).otherwise(F.col("close"))), path)
    jobs.add_bars(bars.where(again), path)
    jobs.compact_bars(spark, path)
    last = bars.where(F.col("date") >= F.lit(REFRESH_FROM).cast("date"))
    jobs.add_bars(last.withColumn("close", F.col("close") * 2), path)
    return rounded(jobs.added_bars(spark, path).select("symbol", "date", "close"))


@query
def bars_dedup(spark, folder):
    return rounded(clean.one_bar_per_day(sample.dirty_bars(spark, folder), LINE_ORDER, "symbol"))


@query
def ohlc_violations(spark, folder):
    labels = list(ohlc.violation_labels())
    out = clean.ohlc_violations(sample.dirty_bars(spark, folder))
    return rounded(out.select("symbol", "date", *LINE_ORDER, "open", "high", "low", "close", *labels))


@query
def ohlc_repair(spark, folder):
    out = clean.repair_ohlc(sample.dirty_bars(spark, folder))
    return rounded(out.select("symbol", "date", *LINE_ORDER, "open", "high", "low", "close"))


@query
def zero_negative(spark, folder):
    """Price flaws of hourly event values, some of which are zero."""
    return quality.price_flaws(_event_bars(spark, folder))


def _event_bars(spark, folder):
    value = F.col("value") - 5.0
    return sample.table(spark, folder, "events").select(
        F.col("event_type").alias("ticker"),
        F.to_date("ts").alias("date"),
        value.alias("open"),
        F.col("value").alias("high"),
        value.alias("low"),
        F.when(F.col("user_id") % 50 != 0, value).alias("close"),
        F.floor(F.col("value") - 1).alias("volume"),
    )


@query
def null_critical_rows(spark, folder):
    return rounded(_event_bars(spark, folder).where(ohlc.any_null("ticker", "date", "close")).select("ticker", "date", "open"))


@query
def bars_in_range(spark, folder):
    return rounded(clean.in_range(sample.bars(spark, folder), "1996-03-01", "1996-04-15").select(*KEY, "close"))


@query
def bars_of_tickers(spark, folder):
    return rounded(clean.only_tickers(sample.bars(spark, folder), ["SRC1", "SRC5", "NONE"]).select(*KEY, "close"))


@query
def price_summary(spark, folder):
    return rounded(summaries.price_summary(sample.bars(spark, folder)))


# Data quality ---------------------------------------------------------------------------------------


@query
def null_profile(spark, folder):
    return rounded(summaries.null_profile(sample.news(spark, folder)))


@query
def unique_counts(spark, folder):
    return summaries.distinct_counts(sample.news(spark, folder), ["ticker", "query_date", "url"])


@query
def repeated_keys(spark, folder):
    return summaries.repeated_keys(sample.dirty_bars(spark, folder), "symbol", "date")


@query
def repeated_url_count(spark, folder):
    return summaries.repeated_key_count(sample.news(spark, folder), "url")


@query
def dup_profile(spark, folder):
    return rounded(summaries.duplicate_profile(sample.dirty_bars(spark, folder), ["symbol", "date"]))


@query
def dup_profile_null_keys(spark, folder):
    return rounded(summaries.duplicate_profile(sample.news(spark, folder), ["ticker", "url"]))


@query
def dup_sample(spark, folder):
    return summaries.duplicate_sample(sample.dirty_bars(spark, folder), ["symbol", "date"])


@query
def exact_dups(spark, folder):
    """Bars alike in ticker, day, prices and volume."""
    bars = sample.dirty_bars(spark, folder).drop(*LINE_ORDER)
    # Each bar is there twice where its line number is even, as the small sample has no exact copies of its own.
    again = sample.dirty_bars(spark, folder).where("l_linenumber % 2 = 0").drop(*LINE_ORDER)
    return rounded(summaries.repeated_keys(bars.union(again), *bars.columns))


@query
def date_gaps(spark, folder):
    return windows.date_gaps(sample.dirty_bars(spark, folder), 7, ticker="symbol")


@query
def news_gaps(spark, folder):
    return windows.date_gaps(sample.news(spark, folder), 1, date="query_date")


@query
def price_report(spark, folder):
    bars = sample.dirty_bars(spark, folder).withColumnRenamed("symbol", "ticker")
    return rounded(quality.price_report(bars))


@query
def price_verdict(spark, folder):
    return quality.verdict(quality.price_report(_checked_bars(spark, folder)))


def _checked_bars(spark, folder):
    return price_plan.clean_bars(sample.dirty_bars(spark, folder), LINE_ORDER)


@query
def news_report(spark, folder):
    return rounded(quality.news_report(sample.news(spark, folder)))


@query
def news_verdict(spark, folder):
    return quality.verdict(quality.news_report(sample.news(spark, folder)))


@query
def news_metrics(spark, folder):
    return quality.news_metrics(sample.news(spark, folder), TODAY)


@query
def dataset_summary(spark, folder):
    bars = sample.dirty_bars(spark, folder).withColumnRenamed("symbol", "ticker")
    return rounded(quality.dataset_summary(bars))


# News -----------------------------------------------------------------------------------------------


@query
def news_valid(spark, folder):
    return clean.valid_articles(sample.news(spark, folder)).select("doc_id", "ticker", "query_date", "title")


@query
def news_clean(spark, folder):
    return sample.news(spark, folder).select(
        "doc_id", text.clean_text(F.col("title")).alias("title_clean"), text.clean_text(F.col("text")).alias("text_clean")
    )


@query
def sentiment_text(spark, folder):
    return news_plan.transform(sample.news(spark, folder)).select("doc_id", "ticker", "date_key", "sentiment_text")


@query
def article_dedup(spark, folder):
    out = clean.dedup_articles(sample.news(spark, folder), ["ticker", "query_date"], ["doc_id"])
    return out.select("doc_id", "ticker", "query_date", "url")


@query
def article_dedup_quirk(spark, folder):
    out = clean.dedup_articles_by_url_then_title(sample.news(spark, folder), ["ticker"], "doc_id", ["doc_id"])
    return out.select("doc_id", "ticker", "title", "url")


@query
def lexicon_sentiment(spark, folder):
    articles = news_plan.transform(sample.news(spark, folder))
    return rounded(sentiment.lexicon_scores(articles, sample.lexicon(spark), ["doc_id"]), 8)


@query
def emphatic_sentiment(spark, folder):
    texts, words = sample.emphatic_texts(spark, folder), sample.lexicon(spark)
    return rounded(emphasis.emphatic_scores(texts, words, sample.shifters(spark), ["doc_id"]), 8)


def _probabilities(spark, folder):
    """The first three numbers of each embedding as logits."""
    logits = F.transform(F.slice("embedding", 1, 3), lambda x: x.cast("double") * 5)
    vectors = sample.table(spark, folder, "embeddings")
    key = vectors.columns[0]
    return sentiment.probability_scores(vectors.select(F.col(key).alias("vec_id"), logits.alias("logits")), "logits", LABELS)


@query
def prob_sentiment(spark, folder):
    return rounded(_probabilities(spark, folder).drop("logits"))


def _letter_model():
    """Stands in for a model: logits from letter frequencies.

    Functions made inside a function travel to the workers whole, which then need not have this package.
    """

    def load():
        def model(texts):
            n = texts.str.len()
            return list(zip(*[texts.str.count(letter) / n * 10 for letter in "eao"]))

        return model

    return load


def _scored_news(spark, folder):
    """Silver-like news: transformed, scored by both methods."""
    articles = news_plan.transform(sample.news(spark, folder))
    words = sentiment.lexicon_scores(articles, sample.lexicon(spark), ["doc_id"])
    return sentiment.model_scores(articles.join(words, "doc_id"), _letter_model(), LABELS)


@query
def model_sentiment(spark, folder):
    articles = news_plan.transform(sample.news(spark, folder))
    out = sentiment.model_scores(articles, _letter_model(), LABELS)
    return rounded(out.select("doc_id", "finbert_score", "finbert_label"))


@query
def silver_news(spark, folder):
    out = news_plan.silver_news(sample.news(spark, folder), sample.lexicon(spark), ["doc_id"], _letter_model(), LABELS)
    return rounded(out.drop("ingestion_timestamp", "sentiment_timestamp"), 8)


@query
def merged_news(spark, folder):
    """A second load merged into a first one: of an article in both, the row of the second stays."""
    news, second = sample.news(spark, folder), F.col("doc_id") % 3 == 0

    def load(part):
        return news_plan.silver_news(part, sample.lexicon(spark), ["doc_id"], _letter_model(), LABELS)

    out = news_plan.merged_news(load(news.where(second)), load(news.where(~second)))
    return rounded(out.drop("ingestion_timestamp", "sentiment_timestamp"), 8)


@query
def attached_scores(spark, folder):
    """Stored scores joined back by (ticker, date_key, url)."""
    articles = news_plan.transform(sample.news(spark, folder))
    scored = articles.select("ticker", "date_key", "url", F.length("title").alias("title_length"))
    return sentiment.attach_scores(articles.select("doc_id", "ticker", "date_key", "url"), scored)


@query
def label_distribution(spark, folder):
    articles = news_plan.transform(sample.news(spark, folder))
    return rounded(sentiment.label_distribution(sentiment.model_scores(articles, _letter_model(), LABELS)))


@query
def text_length_stats(spark, folder):
    return rounded(sentiment.text_lengths(news_plan.transform(sample.news(spark, folder))))


@query
def articles_per_ticker(spark, folder):
    return summaries.articles_per_ticker(sample.news(spark, folder))


@query
def article_totals(spark, folder):
    return rounded(summaries.article_totals(sample.news(spark, folder)))


@query
def news_summary(spark, folder):
    return rounded(summaries.news_summary(_scored_news(spark, folder)))


# Article selection ----------------------------------------------------------------------------------


@query
def term_match(spark, folder):
    out = candidates.matched_terms(sample.candidates(spark, folder), sample.tickers(spark, folder))
    return out.select("rank", "ticker", "term", "term_matched", "ticker_in_both")


@query
def candidate_cascade(spark, folder):
    out = candidates.select_articles(sample.candidates(spark, folder), sample.tickers(spark, folder))
    columns = ["ticker", "date", "position", "rank", "search_source", "endpoint_used", "search_terms_used", "company_name"]
    return out.select(*columns)


@query
def top_articles(spark, folder):
    news = sample.candidates(spark, folder).select("ticker", "date", "rank", "title")
    return candidates.top_articles(news, ["rank"])


@query
def search_source_mix(spark, folder):
    found = sample.candidates(spark, folder).select("ticker", F.when(F.col("rank") % 5 != 0, F.col("term")).alias("search_source"))
    return rounded(summaries.search_source_mix(found))


@query
def company_names(spark, folder):
    articles = sample.candidates(spark, folder).select("rank", "ticker")
    return articles.join(sample.tickers(spark, folder), "ticker").select("rank", "ticker", "company_name", "abbrev1", "abbrev2")


# Incremental loads ----------------------------------------------------------------------------------


@query
def incremental_ranges(spark, folder):
    return incremental.pending_range(sample.bars(spark, folder), TODAY)


@query
def first_load_range(spark, folder):
    """Nothing was loaded yet: no bar has a negative price, so the lookback applies."""
    return incremental.pending_range(sample.bars(spark, folder).where("close < 0"), TODAY)


def _ranges(spark, folder):
    bars = sample.bars(spark, folder).select("ticker", "date")
    tickers = bars.select("ticker").union(bars.select(F.concat(F.lit("NEW"), F.col("ticker")).alias("ticker")))
    return incremental.pending_ranges_by_ticker(tickers, bars, TODAY)


@query
def ticker_ranges(spark, folder):
    return _ranges(spark, folder)


@query
def day_spine(spark, folder):
    return incremental.day_spine(_ranges(spark, folder))


@query
def missing_days(spark, folder):
    bars = sample.bars(spark, folder).select("ticker", "date")
    held = bars.groupBy("ticker").agg(F.min("date").alias("start_date"), F.max("date").alias("end_date"))
    return incremental.missing_days(incremental.day_spine(held), bars)


# Payloads -------------------------------------------------------------------------------------------


@query
def chart_json_bars(spark, folder):
    return rounded(payloads.chart_bars(sample.chart_payloads(spark, folder)))


@query
def chart_outcomes(spark, folder):
    """Every answer is either read or refused for a reason."""
    return payloads.outcomes(payloads.chart_answers(sample.mixed_chart_payloads(spark, folder)))


@query
def refused_news(spark, folder):
    answers = payloads.news_answers(sample.mixed_news_payloads(spark, folder), keep=("doc_id",))
    return payloads.refused(answers).select("doc_id", "outcome")


@query
def article_dates(spark, folder):
    """Dates as the services write them; what cannot be read is told apart from what is missing."""
    rows = sample.written_dates(spark, folder)
    return rows.select("doc_id", clean.as_date(rows, "date").alias("day"), clean.unread_date(rows, "date").alias("unread"))


@query
def news_json(spark, folder):
    out = payloads.articles(sample.news_payloads(spark, folder), keep=("doc_id",))
    return out.select("doc_id", "title", "text", "date", "url", "source")


@query
def union_of_sources(spark, folder):
    documents = sample.table(spark, folder, "documents").select("doc_id", "lang", F.length("text").alias("size"))
    pages = sample.table(spark, folder, "pages").select(F.col("page_id").alias("doc_id"), "url")
    return bronze.union_all(documents, pages)


# Gold -----------------------------------------------------------------------------------------------


def _daily(spark, folder):
    """Daily sentiment of articles assigned to sample tickers."""
    scored = _scored_news(spark, folder)
    renamed = F.concat(F.lit("SRC"), (F.col("doc_id") % 20 + 1).cast("string"))
    return gold.daily_sentiment(scored.withColumn("ticker", renamed))


def _priced(spark, folder):
    bars = features.compute(sample.bars(spark, folder), [features.price_change()])
    return gold.sentiment_prices(bars, _daily(spark, folder))


@query
def daily_sentiment(spark, folder):
    return rounded(_daily(spark, folder))


@query
def sentiment_price(spark, folder):
    return rounded(_priced(spark, folder).drop("date", "open", "high", "low", "volume"))


@query
def trading_days(spark, folder):
    """Articles with the day of the next prices of their ticker."""
    name = F.concat(F.lit("SRC"), (F.col("doc_id") % 20 + 1).cast("string"))
    articles = sample.news(spark, folder).select("doc_id", name.alias("ticker"), F.col("query_date").alias("date_key"))
    return gold.on_trading_days(articles, sample.bars(spark, folder).select("ticker", "date"))


@query
def sentiment_price_corr(spark, folder):
    return rounded(gold.sentiment_correlation(_priced(spark, folder)))


@query
def sentiment_trend(spark, folder):
    out = gold.sentiment_trend(_daily(spark, folder))
    return rounded(out.select("ticker", "date_key", "sentiment_trend"))


@query
def ml_features(spark, folder):
    parts = [features.price_change(), features.sma(), features.returns(), features.rsi()]
    priced = gold.sentiment_prices(features.compute(sample.bars(spark, folder), parts), _daily(spark, folder))
    columns = ["ticker", "date_key", "close", "price_change_pct", "sma_20", "log_return", "rsi_14", "articles", "avg_vader_compound"]
    return rounded(gold.training_rows(priced.select(*columns)))


def entry(spark: SparkSession, folder: str) -> DataFrame:
    return silver_prices_of_all(spark, folder)


@query
def silver_prices_of_all(spark: SparkSession, folder: str) -> DataFrame:
    """The Silver price table for every ticker, however short its history."""
    return price_plan.silver_prices(sample.bars(spark, folder), 1, stamp=False)
