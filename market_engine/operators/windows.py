"""Windows over one ticker's daily bars.

Every function expects one row per (ticker, date) with ``date`` of type DATE, as
``clean.one_bar_per_day`` gives it. A window partition is then one ticker's calendar: at most 366
rows a year whatever the number of source rows, so no ticker can outgrow a task.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import add

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from .clean import as_date

BLOCK = "_block"
#: Rows of a part; longer frames of whole parts are put together from the parts before each row.
PART = 5


def ticker_window() -> WindowSpec:
    # BLOCK never decreases with date, so this is date order. Naming it lets windows over a ticker
    # and windows over a (ticker, block) share one sort.
    return Window.partitionBy("ticker").orderBy(BLOCK, "date")


def block_window() -> WindowSpec:
    return Window.partitionBy("ticker", BLOCK).orderBy("date").rowsBetween(Window.unboundedPreceding, 0)


def with_blocks(bars: DataFrame, days: int) -> DataFrame:
    """Number stretches of ``days`` calendar days, so a block holds at most ``days`` rows."""
    return bars.withColumn(BLOCK, F.floor(F.unix_date("date") / days).cast("int"))


def repeated_day() -> Column:
    return F.lag("date").over(ticker_window()) == F.col("date")


def checked_date(repeated: str) -> Column:
    """The date; a day that a ticker has twice stops the job."""
    message = F.concat(F.lit("two bars of ticker "), F.col("ticker"), F.lit(" on "), F.col("date").cast("string"))
    return F.when(F.col(repeated), F.raise_error(message)).otherwise(F.col("date")).alias("date")


def rolling(agg, value: Column | str, n: int, min_periods: int = 1) -> Column:
    """Aggregate over the current and the n - 1 rows before it; short frames count unless told otherwise."""
    frame = ticker_window().rowsBetween(-(n - 1), 0)
    result = agg(value).over(frame)
    if min_periods > 1:
        result = F.when(F.count(value).over(frame) >= min_periods, result)
    return result


def in_parts(n: int) -> bool:
    return n > PART and n % PART == 0


def parts(value: Column | str, name: str, kinds: Sequence[str]) -> dict[str, Column]:
    """What each row's last ``PART`` rows add up to, for ``of_parts``."""
    variance = rolling(F.var_pop, value, PART)
    found = {
        "count": rolling(F.count, value, PART),
        "sum": rolling(F.sum, value, PART),
        "min": rolling(F.min, value, PART),
        "max": rolling(F.max, value, PART),
        # A sum of equal values divided by their number need not be that value again.
        "mean": F.when(variance == 0, rolling(F.max, value, PART)).otherwise(rolling(F.avg, value, PART)),
        "var": variance,
    }
    return {f"_{kind}_{name}": found[kind] for kind in kinds}


def earlier_parts(name: str, kinds: Sequence[str], n: int) -> dict[str, Column]:
    """The parts that a frame of ``n`` rows has before each row's own."""
    return {f"_{kind}_{name}_{at}": lagged(f"_{kind}_{name}", at) for kind in kinds for at in range(PART, n, PART)}


def _frame(kind: str, name: str, n: int) -> list[Column]:
    return [F.col(f"_{kind}_{name}"), *[F.col(f"_{kind}_{name}_{at}") for at in range(PART, n, PART)]]


def _total(columns: list[Column]) -> Column:
    return reduce(add, [F.coalesce(c, F.lit(0)) for c in columns])


def sum_of_parts(name: str, n: int) -> Column:
    columns = _frame("sum", name, n)
    return F.when(F.coalesce(*columns).isNotNull(), _total(columns))


def extreme_of_parts(kind: str, name: str, n: int) -> Column:
    return (F.least if kind == "min" else F.greatest)(*_frame(kind, name, n))


def mean_of_parts(name: str, n: int, min_periods: int = 1) -> Column:
    count = _total(_frame("count", name, n))
    return F.when(count >= max(min_periods, 1), _total(_frame("sum", name, n)) / count)


def centre_of_parts(name: str, n: int) -> Column:
    """The mean, exactly the value where all values are the same."""
    counts, means = _frame("count", name, n), _frame("mean", name, n)
    base = F.coalesce(*means)
    shift = _total([c * (m - base) for c, m in zip(counts, means)])
    return F.when(base.isNotNull(), base + shift / _total(counts))


def deviation_of_parts(name: str, n: int, centre: str) -> Column:
    """The sample deviation around the mean in the column ``centre``; exactly zero where all values are the same."""
    counts, means, variances = (_frame(kind, name, n) for kind in ("count", "mean", "var"))
    squares = [c * (v + (m - F.col(centre)) * (m - F.col(centre))) for c, m, v in zip(counts, means, variances)]
    count = _total(counts)
    return F.when(count > 1, F.sqrt(_total(squares) / (count - 1)))


def cumulative(agg, value: Column | str) -> Column:
    return agg(value).over(ticker_window().rowsBetween(Window.unboundedPreceding, 0))


def lagged(value: str, n: int = 1) -> Column:
    return F.lag(value, n).over(ticker_window())


def date_gaps(df: DataFrame, min_days: int = 7, ticker: str = "ticker", date: str = "date") -> DataFrame:
    """Steps of more than ``min_days`` between consecutive distinct dates of one ticker; text that is no date is passed over."""
    days = df.select(F.col(ticker).alias("ticker"), as_date(df, date).alias("gap_end"))
    days = days.where("gap_end IS NOT NULL").distinct()
    previous = F.lag("gap_end").over(Window.partitionBy("ticker").orderBy("gap_end"))
    return (
        days.withColumn("gap_start", previous)
        .withColumn("gap_days", F.datediff("gap_end", "gap_start"))
        .where(F.col("gap_days") > min_days)
        .select("ticker", "gap_start", "gap_end", "gap_days")
    )
