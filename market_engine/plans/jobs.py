"""Jobs that write the layers. Each may be repeated without changing its result."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import carry, clean, features, gold, qualify, quality, summaries
from ..schemas import SILVER_NEWS, SILVER_PRICES
from ..session import ensure_checkpoint_dir
from ..sinks import deltas, tables
from ..sources import bronze
from ..sources import payloads as payload
from . import news as news_plan
from . import prices as price_plan


def store_bars(bars: DataFrame, path: str, order: Sequence = ()) -> None:
    """Add bars, as chart answers give them, to the Bronze price table; stored days stay.

    A new bar replaces that of the same symbol and day; ``order`` decides among several new ones.
    """
    tables.merge_months(bars, path, ["symbol", "date"], [F.col("_new").desc(), *order], ticker="symbol")


def store_news(articles: DataFrame, path: str, order: Sequence = ()) -> None:
    """Add articles to the Bronze news table by the month of the day asked for; stored articles stay.

    A new article replaces that of the same ticker, day and url, or title without a url.
    """
    keys = ["ticker", "query_date", *clean.article_identity()]
    tables.merge_months(tables.prepare_news(articles), path, keys, [F.col("_new").desc(), *order], date="query_date")


BAR_KEYS = ("symbol", "date")


def add_bars(bars: DataFrame, path: str, order: Sequence = ()) -> int:
    """Like ``store_bars`` for the loads of single days: writes the new bars only; see ``deltas``."""
    return deltas.add(bars, path, BAR_KEYS, order or ["close"], ticker="symbol")


def added_bars(spark: SparkSession, path: str) -> DataFrame | None:
    """The bars of such a table, one per symbol and day."""
    return deltas.read(spark, path, BAR_KEYS)


def compact_bars(spark: SparkSession, path: str) -> list[str]:
    return deltas.compact(spark, path, BAR_KEYS, ticker="symbol")


def article_keys() -> list:
    return ["ticker", "query_date", *clean.article_identity()]


def add_news(articles: DataFrame, path: str, order: Sequence = ()) -> int:
    """Like ``store_news`` for the loads of single days."""
    return deltas.add(tables.prepare_news(articles), path, article_keys(), order or ["title"], date="query_date")


def added_news(spark: SparkSession, path: str) -> DataFrame | None:
    return deltas.read(spark, path, article_keys())


def compact_news(spark: SparkSession, path: str) -> list[str]:
    return deltas.compact(spark, path, article_keys(), date="query_date")


def store_chart_answers(payloads: DataFrame, path: str, refused_path: str, zone: str = "UTC") -> DataFrame:
    """Add the bars of chart answers (symbol, asked, payload) to Bronze and the refused answers to a table of their own.

    An answer is parsed once. The result has the number of answers by outcome; they add up to the payloads.
    """
    ensure_checkpoint_dir(payloads.sparkSession)
    rows = payloads.withColumn("_key", F.struct("symbol", "asked"))
    answers = payload.chart_answers(rows, symbol="_key").checkpoint()
    bars = payload.bars_of(answers, "_key", zone)
    latest = [F.col("_key.asked").desc()]
    keyed = bars.select(F.col("_key.symbol").alias("symbol"), "date", *payload.FIELDS, "_key")
    tables.merge_months(clean.first_per_key(keyed, ["symbol", "date"], latest).drop("_key"), path, ["symbol", "date"], [F.col("_new").desc()], ticker="symbol")
    held = payload.refused(answers).select("_key.*", "outcome", "excerpt").withColumnRenamed("asked", "date")
    tables.merge_months(held, refused_path, ["symbol", "date", "outcome"], [F.col("_new").desc()], ticker="symbol")
    return payload.outcomes(answers)


def store_news_answers(payloads: DataFrame, path: str, refused_path: str) -> DataFrame:
    """The same for news answers (ticker, query_date, payload)."""
    ensure_checkpoint_dir(payloads.sparkSession)
    keys = ("ticker", "query_date")
    answers = payload.news_answers(payloads, keep=keys).checkpoint()
    store_news(payload.articles_of(answers, keys), path, ["title", "text"])
    refused = tables.prepare_news(payload.refused(answers)).withColumnRenamed("query_date", "date")
    tables.merge_months(refused, refused_path, ["ticker", "date", "outcome"], [F.col("_new").desc()])
    return payload.outcomes(answers)


def mark_processed(days: DataFrame, path: str) -> None:
    """Note (ticker, date) as asked for, with or without articles, for ``incremental.missing_days``."""
    tables.merge_months(days.select("ticker", "date"), path, ["ticker", "date"], [F.col("_new").desc()])


def load_prices(
    raw: DataFrame, table: str, order: list, min_bars: int = qualify.MIN_BARS, more: Sequence[str] = (), strict: bool = False
) -> DataFrame:
    """All of Bronze into the Silver price table; the result has the figures of the stored table.

    ``more`` names further Bronze columns to carry along; the table gets those it lacks, unless ``strict``.
    """
    tables.create_table(raw.sparkSession, table, SILVER_PRICES)
    tables.load_table(price_plan.raw_to_silver(raw, order, min_bars, more), table, SILVER_PRICES, strict=strict)
    return summaries.price_summary(raw.sparkSession.table(table))


def refresh_prices(history: DataFrame, new: DataFrame, path: str, order: list, min_bars: int = qualify.MIN_BARS) -> None:
    """Bring the Silver months that new bars touch up to date.

    Averages reach back over the whole history, so tickers with new bars are worked out in full. Of tickers
    in the table only the days from the first new one on are written. Other tickers keep their rows.
    ``refresh_prices_from_states`` does the same without the whole history.
    """
    since = new.agg(F.min(clean.as_date(new, "date"))).first()[0]
    if since is None:
        return
    touched = clean.only_tickers(history, new.select("symbol"), "symbol")
    silver = price_plan.raw_to_silver(touched, order, min_bars)
    stored = tables.read_months(history.sparkSession, path)
    if stored is not None:
        silver = price_plan.refreshed(silver, stored, since)
    tables.merge_months(silver, path, ["ticker", "date"], [F.col("_new").desc()])


def refresh_prices_from_states(
    history: DataFrame,
    new: DataFrame,
    path: str,
    states_path: str,
    order: list,
    min_bars: int = qualify.MIN_BARS,
    more: Sequence[str] = (),
) -> None:
    """Like ``refresh_prices``, going on from the state each ticker had at the end of an earlier month.

    ``history`` is Bronze and holds the new bars too. Of tickers in the Silver table with a state it is read from
    the earliest starting point on, of others in full. Both tables then hold what a load of the whole history
    would give, also where a new bar corrects an old day. Tickers that are not in ``new`` are not read.
    """
    spark = history.sparkSession
    ensure_checkpoint_dir(spark)
    bars = history.withColumnRenamed("symbol", "ticker") if "symbol" in history.columns else history
    fresh = new.withColumnRenamed("symbol", "ticker") if "symbol" in new.columns else new
    since = carry.first_days(fresh).checkpoint()
    states, stored = tables.read_months(spark, states_path), tables.read_months(spark, path)
    if states is None or stored is None:
        starts = since.withColumn(features.CARRY, F.lit(None).cast(features.state_type())).limit(0)
    else:
        known = clean.only_tickers(states.drop(tables.MONTH), stored.select("ticker"))
        starts = carry.starting_points(known, since).checkpoint()
    first = starts.agg(F.min(f"{features.CARRY}.date")).first()[0]
    parts = [clean.only_tickers(bars, since.join(starts, "ticker", "left_anti"))]
    if first is not None:
        recent = bars.where(clean.as_date(bars, "date") > F.lit(first))
        if tables.MONTH in bars.columns:
            # The folder names prune what the dates cannot.
            recent = recent.where(F.col(tables.MONTH).cast("string") >= first.strftime("%Y-%m"))
        parts.append(clean.only_tickers(recent, starts))
    clean_bars = price_plan.clean_bars(bronze.union_all(*parts), order).select(*price_plan.BAR, *more)
    rows = price_plan.silver_from_states(clean_bars, since, starts, min_bars).checkpoint()
    month_end = ["ticker", F.last_day("date")]
    tables.merge_months(rows.drop(features.STATE), path, ["ticker", "date"], [F.col("_new").desc()])
    tables.merge_months(carry.states_of(rows), states_path, month_end, [F.col("_new").desc()])


def load_news(
    raw: DataFrame,
    table: str,
    lexicon: DataFrame,
    order: list,
    load_model: Callable | None = None,
    labels: Sequence[str] = (),
    shifters: DataFrame | None = None,
) -> DataFrame:
    """Add Bronze articles to the Silver news table; of an article that is there already the new row stays.

    The result has the figures of the stored table.

    The deduplicated articles feed both the word scores and the table. They are stored meanwhile in the
    folder all executors share.
    """
    spark = raw.sparkSession
    tables.create_table(spark, table, SILVER_NEWS)
    ensure_checkpoint_dir(spark)
    unique = news_plan.deduplicated(raw, order).checkpoint()
    scored = news_plan.scored(unique, lexicon, load_model, labels, shifters)
    tables.merge_table(scored, table, SILVER_NEWS, news_plan.article_key(), [F.col("_new").desc()])
    return summaries.news_summary(spark.table(table))


def load_gold(prices: DataFrame, news: DataFrame, path: str, next_trading_day: bool = False) -> None:
    """Daily sentiment beside the price features of the same day, or of the next day with prices."""
    news = gold.on_trading_days(news, prices) if next_trading_day else news
    joined = gold.sentiment_prices(prices, gold.daily_sentiment(news))
    tables.write_months(joined, path, "date_key")


def validate_prices(raw: DataFrame, order: list, root: str, day: str) -> bool:
    """Write the check report of cleaned bars; True if all critical checks passed.

    The counts before cleaning stand beside it as checks that are not critical, their names starting with raw_.
    """
    bars = raw.withColumnRenamed("symbol", "ticker") if "symbol" in raw.columns else raw
    before = quality.price_report(bars).withColumns(
        {"check": F.concat(F.lit("raw_"), "check"), "critical": F.lit(False)}
    )
    report = quality.price_report(price_plan.clean_bars(raw, order)).unionByName(before)
    return _published(report, root, day, "prices")


def validate_news(raw: DataFrame, root: str, day: str) -> bool:
    return _published(quality.news_report(raw), root, day, "news")


def _published(report: DataFrame, root: str, day: str, source: str) -> bool:
    spark = report.sparkSession
    written = spark.read.schema(report.schema).json(tables.write_report(report, root, day, source))
    return quality.verdict(written).first()[0] == "PASS"
