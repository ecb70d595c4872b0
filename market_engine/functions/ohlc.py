"""Price-bar predicates, repair and candle patterns."""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column
from pyspark.sql import functions as F

PRICES = ("open", "high", "low", "close")

# Rule label and the columns it compares; both sides of each pair are (upper, lower).
ORDER_RULES = {
    "high < low": ("high", "low"),
    "high < open": ("high", "open"),
    "high < close": ("high", "close"),
    "low > open": ("open", "low"),
    "low > close": ("close", "low"),
}


def any_null(*columns: str) -> Column:
    return reduce(or_, [F.col(c).isNull() for c in columns])


def negative_price() -> Column:
    return reduce(or_, [F.col(c) < 0 for c in PRICES])


def order_violations() -> dict[str, Column]:
    return {label: F.col(upper) < F.col(lower) for label, (upper, lower) in ORDER_RULES.items()}


def invalid_ohlc() -> Column:
    return reduce(or_, order_violations().values())


def violation_labels() -> dict[str, Column]:
    """One label column per rule, blank where the rule holds."""
    return {
        label.replace(" < ", "_below_").replace(" > ", "_above_"): F.when(broken, F.lit(label)).otherwise(F.lit(""))
        for label, broken in order_violations().items()
    }


def repaired_high() -> Column:
    return F.when(invalid_ohlc(), F.greatest("high", "open", "close", "low")).otherwise(F.col("high"))


def repaired_low() -> Column:
    # The old high may lie below the bar and must not pull the low down with it.
    return F.when(invalid_ohlc(), F.least(F.col("low"), F.col("open"), F.col("close"), repaired_high())).otherwise(
        F.col("low")
    )


def doji() -> Column:
    relative_body = F.try_divide(F.abs(F.col("open") - F.col("close")), F.col("close"))
    return F.when(relative_body < 0.001, 1).otherwise(0)


def hammer() -> Column:
    """The lower wick is measured from the upper end of the body, the upper wick from its lower end."""
    body = F.abs(F.col("close") - F.col("open"))
    # No comparison with a NULL holds, so a NULL close or open takes the close branch.
    reference = F.when(F.col("open") > F.col("close"), F.col("open")).otherwise(F.col("close"))
    lower_wick = reference - F.col("low")
    upper_wick = F.col("high") - reference
    return F.when((lower_wick > 2 * body) & (upper_wick < 0.5 * body), 1).otherwise(0)


def engulfing(bullish: bool) -> Column:
    """Today's body covers yesterday's body, which pointed the other way."""
    if bullish:
        lower, upper = F.col("open"), F.col("close")
        previous_lower, previous_upper = F.col("prev_close"), F.col("_prev_open")
    else:
        lower, upper = F.col("close"), F.col("open")
        previous_lower, previous_upper = F.col("_prev_open"), F.col("prev_close")
    covers = (lower < upper) & (previous_lower < previous_upper) & (lower < previous_lower) & (upper > previous_upper)
    return F.when(covers, 1).otherwise(0)


def price_position() -> Column:
    spread = F.col("high") - F.col("low")
    inside = F.when(F.col("high") != F.col("low"), (F.col("close") - F.col("low")) / spread)
    return F.when(F.col("high") != F.col("low"), inside).otherwise(F.lit(0.5))
