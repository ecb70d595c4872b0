"""Bronze bars to the Silver price table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import carry, clean, features, qualify
from ..operators.joins import lookup_table
from ..schemas import SILVER_PRICES


BAR = ("ticker", "date", "open", "high", "low", "close", "volume")


def clean_bars(raw: DataFrame, order: list) -> DataFrame:
    """One repaired bar per ticker and day; ``order`` decides which of several bars of a day counts."""
    bars = raw.withColumnRenamed("symbol", "ticker") if "symbol" in raw.columns else raw
    bars = clean.one_bar_per_day(clean.parse_date(bars), order)
    return clean.repair_ohlc(bars.withColumn("volume", F.col("volume").cast("double")))


def feature_tasks(spark: SparkSession) -> int:
    """Bars are few bytes for the work they take: without a number, adaptive execution makes a few large tasks of them."""
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def silver_prices(
    bars: DataFrame,
    min_bars: int = qualify.MIN_BARS,
    keep_intermediate: bool = False,
    stamp: bool = True,
    carried: bool = False,
    states: bool = False,
    dealt: bool = False,
) -> DataFrame:
    """Features of qualified tickers, rounded, in the order of the Silver table.

    Further columns of the bars follow those of the table. For ``carried`` and ``states`` see ``features.compute``;
    a ticker that goes on from a state has qualified before. Bars that are ``dealt`` out by ticker to ``feature_tasks``
    stay where they are.
    """
    spread = bars if dealt else bars.repartition(feature_tasks(bars.sparkSession), "ticker")
    enough = qualify.qualified(spread, min_bars, features.CARRY if carried else None)
    keyed = features.compute(enough, features.all_features(), keep_intermediate, carried, states)
    rounded = clean.round_numbers(keyed.withColumn("date_key", F.col("date")))
    result = clean.columns_first(rounded, [c for c in SILVER_PRICES.fieldNames() if c != "ingestion_timestamp"])
    return result.withColumn("ingestion_timestamp", F.current_timestamp()) if stamp else result


def raw_to_silver(raw: DataFrame, order: list, min_bars: int = qualify.MIN_BARS, more: Sequence[str] = ()) -> DataFrame:
    """Bronze bars to the Silver table; ``more`` names further Bronze columns to carry along."""
    return silver_prices(clean_bars(raw, order).select(*BAR, *more), min_bars)


def refreshed(silver: DataFrame, stored: DataFrame, since) -> DataFrame:
    """The rows a refresh writes: days from ``since`` on, and all days of tickers that the table lacks.

    ``silver`` is worked out over the whole history of the tickers with new bars. A ticker that reaches the
    history limit only now has no stored row, so it is written in full.
    """
    known = lookup_table(stored, ["ticker"], F.lit(True).alias("_stored"))
    due = F.col("_stored").isNull() | (F.col("date") >= F.lit(since))
    return silver.join(known, "ticker", "left").where(due).drop("_stored")


def silver_from_states(
    bars: DataFrame, since: DataFrame, starts: DataFrame, min_bars: int = qualify.MIN_BARS, stamp: bool = True
) -> DataFrame:
    """Silver rows, with the state column, that follow from new bars of the days from ``since`` on.

    ``bars`` are clean and reach back to the starting points at least; see ``carry``.
    """
    tail = carry.bars_to_read(bars, since, starts)
    return carry.due(silver_prices(tail, min_bars, stamp=stamp, carried=True, states=True)).drop("since")
