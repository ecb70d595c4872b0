"""Going on from stored states, so that new bars of a ticker do not need all of its earlier ones.

A state is what the features remember of a ticker's bars up to the last one of a month. Averages and running
sums go on from it exactly; windows need the bars themselves. So a ticker with new bars from some day on starts
from the last state that leaves the longest window of bars before that day, and only rows from that day on are
right and taken. A changed old bar is a new bar of its day: all later rows and states follow.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .clean import as_date
from .features import CARRY, LONGEST_FRAME, STATE
from .joins import lookup_table


def first_days(bars: DataFrame) -> DataFrame:
    """ticker, since: the first day of each ticker's bars."""
    dated = bars.select("ticker", as_date(bars, "date").alias("date")).where("ticker IS NOT NULL AND date IS NOT NULL")
    return dated.groupBy("ticker").agg(F.min("date").alias("since"))


def starting_points(states: DataFrame, since: DataFrame, frame: int = LONGEST_FRAME) -> DataFrame:
    """ticker, since and the state to start from, for tickers that have one.

    States count the bars before them, so the last state before ``since`` tells which earlier ones have ``frame``
    bars after them. A ticker has one state a month.
    """
    ticker = Window.partitionBy("ticker")
    before = states.join(since, "ticker").where(F.col("date") < F.col("since"))
    early = before.withColumn("_last", F.max("rows").over(ticker)).where(
        (F.col("rows") <= F.col("_last") - frame) & (F.col("rows") >= frame)
    )
    fields = F.struct(*[F.col(c) for c in states.columns if c != "ticker"])
    return early.groupBy("ticker").agg(F.min("since").alias("since"), F.max_by(fields, "rows").alias(CARRY))


def bars_to_read(bars: DataFrame, since: DataFrame, starts: DataFrame) -> DataFrame:
    """Bars of the tickers of ``since``, after their starting points, with ``CARRY`` and ``since``.

    Tickers without a starting point come with all their bars, and NULL in both. ``bars`` have one row per day.
    """
    wanted = lookup_table(since, ["ticker"])
    points = lookup_table(starts, ["ticker"], F.first(CARRY).alias(CARRY), F.min("since").alias("since"))
    joined = bars.join(wanted, "ticker", "left_semi").join(points, "ticker", "left")
    return joined.where(F.col(CARRY).isNull() | (F.col("date") > F.col(f"{CARRY}.date")))


def due(rows: DataFrame) -> DataFrame:
    """Of rows worked out after a starting point those that count."""
    return rows.where(F.col("since").isNull() | (F.col("date") >= F.col("since")))


def states_of(rows: DataFrame) -> DataFrame:
    """The states in rows that ``features.compute`` made: ticker and their fields."""
    return rows.where(F.col(STATE).isNotNull()).select("ticker", f"{STATE}.*")
