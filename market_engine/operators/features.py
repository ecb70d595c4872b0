"""Per-ticker features of daily bars.

Each feature names the columns it adds at each dependency level. ``compute`` merges the levels of all
requested features, so however many are asked for there is one shuffle and one sort by ticker, and
unused columns are pruned by Catalyst. Input: one row per (ticker, date), see ``windows``.

What a feature remembers of all earlier bars is its state. ``compute`` can give out the states of month ends and
go on from one, so that later bars do not need the earlier ones; see ``carry``.
"""

from __future__ import annotations

import math
from collections.abc import Iterable
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import ohlc
from . import recurrence
from .recurrence import Scan
from .windows import (
    block_window,
    centre_of_parts,
    checked_date,
    cumulative,
    deviation_of_parts,
    earlier_parts,
    extreme_of_parts,
    in_parts,
    lagged,
    mean_of_parts,
    parts,
    repeated_day,
    rolling,
    sum_of_parts,
    ticker_window,
    with_blocks,
)

# Dependency levels, in order of evaluation; the recurrences are worked out before LINES. What no window needs comes
# late, so that the windows hand on few columns.
BARS, RETURNS, RETURN_WINDOWS, LINES, PIECES, PARTS, CENTRES, FRAMES, INDICATORS, SIGNAL, FINAL = range(11)

SMA_DAYS = (5, 10, 20, 50)
EMA_DAYS = (5, 10, 20, 50)
VOLATILITY_DAYS = (5, 10, 20)
VOLUME_DAYS = (5, 10, 20)
SUPPORT_DAYS = (20, 50)
SHARPE_DAYS = (20, 60)
MOMENTUM_DAYS = (5, 20)
BOLLINGER_DAYS = 20
SIGNAL_DAYS = 9
RSI_DAYS = 14
TRADING_DAYS = 252
#: Bars that the windows of all features look back on: the longest frame and the bar before it.
LONGEST_FRAME = 1 + max(
    *SMA_DAYS, *VOLATILITY_DAYS, *VOLUME_DAYS, *SUPPORT_DAYS, *SHARPE_DAYS, *MOMENTUM_DAYS, BOLLINGER_DAYS, SIGNAL_DAYS, RSI_DAYS
)
#: The state a ticker goes on from (struct), and the state after its last bar of a month.
CARRY, STATE = "_carry", "_state"


@dataclass
class Feature:
    outputs: list[str]
    levels: dict[int, dict[str, Column]] = field(default_factory=dict)
    scans: list[Scan] = field(default_factory=list)
    intermediate: list[str] = field(default_factory=list)
    #: What later bars have to know, and how columns are worked out where it is carried in.
    state: dict[str, Column] = field(default_factory=dict)
    carried: dict[int, dict[str, Column]] = field(default_factory=dict)


def _carry(name: str) -> Column:
    return F.col(f"{CARRY}.{name}")


def _added(now: Column, before: Column) -> Column:
    """A running sum on top of an earlier one; either may be NULL."""
    return F.coalesce(now + before, now, before)


def _previous_close() -> dict:
    """The close before the first bar at hand is the carried one."""
    return {BARS: {"prev_close": F.expr(f"lag(close, 1, {CARRY}.close)").over(ticker_window())}}


def _levels(*found: dict[int, dict[str, Column]]) -> dict[int, dict[str, Column]]:
    """The columns of each level together."""
    merged: dict[int, dict[str, Column]] = {}
    for levels in found:
        for level, columns in levels.items():
            merged.setdefault(level, {}).update(columns)
    return merged


def _pieces(value: Column | str, name: str, kinds: list[str], n: int) -> dict[int, dict[str, Column]]:
    return {PIECES: parts(value, name, kinds), PARTS: earlier_parts(name, kinds, n)}


def _average(name: str, value: str, n: int, min_periods: int = 1) -> dict[int, dict[str, Column]]:
    """The average of the last n bars. A long frame is not added up row by row but from its parts, as those below."""
    if not in_parts(n):
        return {PIECES: {name: rolling(F.avg, value, n, min_periods)}}
    return _levels(
        _pieces(value, value, ["count", "sum"], n), {FRAMES: {name: mean_of_parts(value, n, min_periods)}}
    )


def _sum(name: str, value: Column, label: str, n: int) -> dict[int, dict[str, Column]]:
    if not in_parts(n):
        return {PIECES: {name: rolling(F.sum, value, n)}}
    return _levels(_pieces(value, label, ["sum"], n), {FRAMES: {name: sum_of_parts(label, n)}})


def _extreme(name: str, kind: str, value: str, n: int) -> dict[int, dict[str, Column]]:
    if not in_parts(n):
        return {PIECES: {name: rolling(F.min if kind == "min" else F.max, value, n)}}
    return _levels(_pieces(value, value, [kind], n), {FRAMES: {name: extreme_of_parts(kind, value, n)}})


def _spread(deviation: str, value: str, n: int, mean: str | None = None) -> dict[int, dict[str, Column]]:
    """The sample deviation, and under the name ``mean`` the average if it is asked for."""
    if not in_parts(n):
        plain = {deviation: rolling(F.stddev_samp, value, n)}
        return {PIECES: plain | {mean: rolling(F.avg, value, n)} if mean else plain}
    centre = mean or f"_centre_{value}_{n}"
    return _levels(
        _pieces(value, value, ["count", "mean", "var"], n),
        {CENTRES: {centre: centre_of_parts(value, n)}, FRAMES: {deviation: deviation_of_parts(value, n, centre)}},
    )


def _ratio(top: Column, bottom: Column) -> Column:
    return F.try_divide(top, bottom)


def _price_change_pct() -> Column:
    change = F.col("close") - F.col("prev_close")
    return F.when(F.col("prev_close") != 0, change / F.col("prev_close") * 100)


def _log_return() -> Column:
    return F.when(F.col("prev_close") > 0, F.ln(F.col("close") / F.col("prev_close")))


def price_change() -> Feature:
    return Feature(
        ["prev_close", "price_change", "price_change_pct"],
        {
            BARS: {"prev_close": lagged("close")},
            RETURNS: {"price_change_pct": _price_change_pct()},
            INDICATORS: {"price_change": F.col("close") - F.col("prev_close")},
        },
        state={"close": F.col("close")},
        carried=_previous_close(),
    )


def sma(days: Iterable[int] = SMA_DAYS, min_periods: int = 1) -> Feature:
    days = list(days)
    return Feature([f"sma_{n}" for n in days], _levels(*[_average(f"sma_{n}", "close", n, min_periods) for n in days]))


def _ema_scan(n: int) -> Scan:
    alpha = 2.0 / (n + 1)
    seed = F.col("_closes") == 1
    step = F.when(seed, F.col("close")).otherwise(F.col("close") * alpha)
    value = F.when(F.col("close").isNotNull(), step).otherwise(0.0)
    return Scan(f"ema_{n}", "_close_steps", value, 1 - alpha, started="_closes", carry=f"ema_{n}")


def _ema_levels(days: Iterable[int]) -> dict[int, dict[str, Column]]:
    levels = {BARS: {"_closes": cumulative(F.count, "close")}}
    if 1 in days:
        # With one day the average is the price itself and decay is zero.
        levels[BARS]["ema_1"] = cumulative(lambda c: F.last(c, ignorenulls=True), "close")
    levels[RETURNS] = {"_close_steps": F.count("close").over(block_window())}
    return levels


def _ema_state(days: Iterable[int]) -> dict[str, Column]:
    return {"closes": F.col("_closes"), **{f"ema_{n}": F.col(f"ema_{n}") for n in days}}


def _ema_carried(days: Iterable[int]) -> dict[int, dict[str, Column]]:
    columns = {"_closes": cumulative(F.count, "close") + F.coalesce(_carry("closes"), F.lit(0))}
    if 1 in days:
        columns["ema_1"] = F.coalesce(cumulative(lambda c: F.last(c, ignorenulls=True), "close"), _carry("ema_1"))
    return {BARS: columns}


def ema(days: Iterable[int] = EMA_DAYS) -> Feature:
    """Seeded with the first close; a NULL close repeats the value before it."""
    days = list(days)
    return Feature(
        [f"ema_{n}" for n in days],
        _ema_levels(days),
        [_ema_scan(n) for n in days if n > 1],
        state=_ema_state(days),
        carried=_ema_carried(days),
    )


def volatility(days: Iterable[int] = VOLATILITY_DAYS) -> Feature:
    rolled = {f"volatility_{n}d": _spread(f"volatility_{n}d", "price_change_pct", n) for n in days}
    ranges = {
        "daily_range": F.col("high") - F.col("low"),
        "daily_range_pct": _ratio(F.col("high") - F.col("low"), F.col("close")) * 100,
    }
    return Feature(
        [*ranges, *rolled],
        _levels(
            {
                BARS: {"prev_close": lagged("close")},
                RETURNS: {"price_change_pct": _price_change_pct()},
                INDICATORS: ranges,
            },
            *rolled.values(),
        ),
        state={"close": F.col("close")},
        carried=_previous_close(),
    )


def volume(days: Iterable[int] = VOLUME_DAYS) -> Feature:
    averages = {f"volume_sma_{n}": _average(f"volume_sma_{n}", "volume", n) for n in [*days, 20]}
    turnover = F.col("close") * F.col("volume")
    # A NULL close still adds its volume below the line.
    sums = {"_traded": cumulative(F.sum, turnover), "_volume": cumulative(F.sum, "volume")}
    recent = [_sum("_traded_20", turnover, "turnover", 20), _sum("_volume_20", F.col("volume"), "volume", 20)]
    return Feature(
        [*averages, "volume_ratio", "vwap_cumulative", "vwap_20d"],
        _levels(
            {
                BARS: sums,
                INDICATORS: {
                    "vwap_cumulative": _ratio(F.col("_traded"), F.col("_volume")),
                    "volume_ratio": _ratio(F.col("volume"), F.col("volume_sma_20")),
                    "vwap_20d": _ratio(F.col("_traded_20"), F.col("_volume_20")),
                },
            },
            *averages.values(),
            *recent,
        ),
        state={"traded": F.col("_traded"), "volume": F.col("_volume")},
        carried={BARS: {name: _added(total, _carry(name[1:])) for name, total in sums.items()}},
    )


def momentum(days: Iterable[int] = MOMENTUM_DAYS) -> Feature:
    levels: dict[int, dict[str, Column]] = {PARTS: {}, INDICATORS: {}}
    for n in days:
        before = F.col(f"_close_{n}")
        levels[PARTS][f"_close_{n}"] = lagged("close", n)
        levels[INDICATORS][f"momentum_{n}d"] = F.col("close") - before
        levels[INDICATORS][f"momentum_{n}d_pct"] = _ratio(F.col("close") - before, before) * 100
    return Feature(list(levels[INDICATORS]), levels)


def bollinger(days: int = BOLLINGER_DAYS, width: float = 2.0) -> Feature:
    middle, std = F.col(f"sma_{days}"), F.col("bb_std")
    upper, lower = F.col("bb_upper"), F.col("bb_lower")
    return Feature(
        ["bb_middle", "bb_upper", "bb_lower", "bb_width", "bb_percent_b"],
        _levels(
            # The middle band is the simple average, under the name the averages use so that both share it.
            _average(f"sma_{days}", "close", days),
            _spread("bb_std", "close", days),
            {
                INDICATORS: {"bb_middle": middle, "bb_upper": middle + width * std, "bb_lower": middle - width * std},
                SIGNAL: {
                    "bb_width": upper - lower,
                    "bb_percent_b": F.when(upper != lower, (F.col("close") - lower) / (upper - lower)),
                },
            },
        ),
        intermediate=["bb_std"],
    )


def macd(fast: int = 12, slow: int = 26, signal_days: int = SIGNAL_DAYS) -> Feature:
    """The signal line is a simple average of the MACD line; ``macd_with_ema_signal`` has the exponential one."""
    return Feature(
        ["macd", "macd_signal", "macd_histogram"],
        {
            **_ema_levels([fast, slow]),
            LINES: {"macd": F.col(f"ema_{fast}") - F.col(f"ema_{slow}")},
            PIECES: {"macd_signal": rolling(F.avg, "macd", signal_days)},
            FINAL: {"macd_histogram": F.col("macd") - F.col("macd_signal")},
        },
        [_ema_scan(fast), _ema_scan(slow), _ema_scan(signal_days)],
        intermediate=[f"ema_{signal_days}", f"ema_{fast}", f"ema_{slow}"],
        state=_ema_state([fast, slow, signal_days]),
        carried=_ema_carried([fast, slow, signal_days]),
    )


def macd_with_ema_signal(bars: DataFrame, fast: int = 12, slow: int = 26, signal_days: int = SIGNAL_DAYS) -> DataFrame:
    """MACD whose signal is an exponential average, a second pass over the same partitions."""
    lines = compute(bars, [macd(fast, slow, signal_days)]).drop("macd_signal", "macd_histogram")
    # The averages work on a column named close.
    as_close = lines.withColumnsRenamed({"close": "_price", "macd": "close"})
    smooth = compute(as_close, [ema([signal_days])])
    named = smooth.withColumnsRenamed({"close": "macd", "_price": "close", f"ema_{signal_days}": "macd_signal"})
    return named.withColumn("macd_histogram", F.col("macd") - F.col("macd_signal"))


def rsi(days: int = RSI_DAYS) -> Feature:
    """Wilder averages of gains and losses; NULL where nothing was lost so far."""
    change = F.col("close") - F.col("prev_close")
    gain = F.when(change > 0, change).otherwise(0.0)
    loss = F.when(change < 0, -change).otherwise(0.0)

    def scan(side: str) -> Scan:
        settled = F.when(F.col("_row") > days, F.col(f"_{side}") / days).otherwise(0.0)
        value = F.when(F.col("_row") == days, F.col(f"_{side}_mean")).otherwise(settled)
        return Scan(f"_{side}_scan", "_wilder_steps", value, 1 - 1 / days, carry=side)

    def average(side: str) -> Column:
        return F.when(F.col("_row") < days, F.col(f"_{side}_mean")).otherwise(F.col(f"_{side}_scan"))

    strength = F.when(average("loss") != 0, average("gain") / average("loss"))
    name = f"rsi_{days}"
    return Feature(
        [name],
        {
            BARS: {"prev_close": lagged("close"), "_row": F.row_number().over(ticker_window())},
            RETURNS: {
                "_gain": gain,
                "_loss": loss,
                "_wilder_steps": F.count(F.when(F.col("_row") >= days, 1)).over(block_window()),
            },
            # Plain averages are used up to row `days` only, and there the frame reaches back to the first row.
            RETURN_WINDOWS: {f"_{side}_mean": cumulative(F.avg, f"_{side}") for side in ("gain", "loss")},
            LINES: {name: 100 - 100 / (1 + strength)},
        },
        [scan("gain"), scan("loss")],
        # The averages of a ticker with fewer bars than `days` cannot go on; `carry` does not start from such a state.
        state={"rows": F.col("_row"), "close": F.col("close"), "gain": F.col("_gain_scan"), "loss": F.col("_loss_scan")},
        carried={
            BARS: {
                **_previous_close()[BARS],
                "_row": F.row_number().over(ticker_window()) + F.coalesce(_carry("rows"), F.lit(0)),
            }
        },
    )


def returns(sharpe_days: Iterable[int] = SHARPE_DAYS) -> Feature:
    levels = {
        BARS: {"prev_close": lagged("close")},
        RETURNS: {"log_return": _log_return()},
        RETURN_WINDOWS: {"cumulative_return": cumulative(F.sum, "log_return")},
        INDICATORS: {},
    }
    for n in sharpe_days:
        mean, std = F.col(f"_return_mean_{n}"), F.col(f"_return_std_{n}")
        levels = _levels(levels, _spread(f"_return_std_{n}", "log_return", n, f"_return_mean_{n}"))
        levels[INDICATORS][f"sharpe_ratio_{n}d"] = F.when(std != 0, mean / std * math.sqrt(TRADING_DAYS))
    total = _added(cumulative(F.sum, "log_return"), _carry("log_return"))
    return Feature(
        ["log_return", "cumulative_return", *levels[INDICATORS]],
        levels,
        state={"close": F.col("close"), "log_return": F.col("cumulative_return")},
        carried={**_previous_close(), RETURN_WINDOWS: {"cumulative_return": total}},
    )


def drawdown() -> Feature:
    peak = F.col("running_max")
    fall = _ratio(F.col("close") - peak, peak)
    return Feature(
        ["drawdown", "drawdown_pct"],
        {BARS: {"running_max": cumulative(F.max, "close")}, INDICATORS: {"drawdown": fall, "drawdown_pct": fall * 100}},
        intermediate=["running_max"],
        state={"peak": peak},
        carried={BARS: {"running_max": F.greatest(cumulative(F.max, "close"), _carry("peak"))}},
    )


def candles() -> Feature:
    patterns = {
        "is_doji": ohlc.doji(),
        "is_hammer": ohlc.hammer(),
        "is_bullish_engulfing": ohlc.engulfing(bullish=True),
        "is_bearish_engulfing": ohlc.engulfing(bullish=False),
        "price_position": ohlc.price_position(),
    }
    return Feature(
        list(patterns),
        {BARS: {"prev_close": lagged("close"), "_prev_open": lagged("open")}, INDICATORS: patterns},
        state={"close": F.col("close")},
        carried=_previous_close(),
    )


def support_resistance(days: Iterable[int] = SUPPORT_DAYS) -> Feature:
    levels: dict[int, dict[str, Column]] = {INDICATORS: {}}
    outputs = []
    for n in days:
        support, resistance = f"support_{n}d", f"resistance_{n}d"
        levels = _levels(levels, _extreme(support, "min", "low", n), _extreme(resistance, "max", "high", n))
        close = F.col("close")
        levels[INDICATORS][f"distance_to_{support}"] = _ratio(close - F.col(support), close) * 100
        levels[INDICATORS][f"distance_to_{resistance}"] = _ratio(F.col(resistance) - close, close) * 100
        outputs += [support, resistance, f"distance_to_{support}", f"distance_to_{resistance}"]
    return Feature(outputs, levels)


def all_features() -> list[Feature]:
    """In the column order of the Silver price table."""
    return [
        price_change(),
        sma(),
        ema(),
        volatility(),
        volume(),
        rsi(),
        momentum(),
        bollinger(),
        macd(),
        returns(),
        drawdown(),
        candles(),
        support_resistance(),
    ]


def compute(
    bars: DataFrame, features: list[Feature], keep_intermediate: bool = False, carried: bool = False, states: bool = False
) -> DataFrame:
    """Bars plus the columns of ``features``.

    ``date`` must be a DATE: together with one row per ticker and day this is what bounds a window. A day that is
    there twice for a ticker stops the job, as its rows would have no order.

    With ``carried`` the bars have a column ``CARRY``, the state each ticker goes on from or NULL. With ``states``
    the result has a column ``STATE``, the state after a ticker's last bar of a month, NULL on other rows.
    """
    if dict(bars.dtypes).get("date") != "date":
        raise TypeError("features need daily bars with a column date of type DATE")
    scans = list({s.name: s for f in features for s in f.scans}.values())
    levels: list[dict[str, Column]] = [{} for _ in range(FINAL + 1)]
    for feature in features:
        for level, columns in feature.levels.items():
            levels[level].update(columns)
    if carried:
        for feature in features:
            for level, columns in feature.carried.items():
                levels[level].update(columns)
    outputs = list(dict.fromkeys(c for f in features for c in f.outputs))
    if keep_intermediate:
        extra = (c for f in features for c in f.intermediate)
        outputs = list(dict.fromkeys([*outputs, *extra]))
    df = with_blocks(bars, recurrence.block_days([s.decay for s in scans]))
    levels[BARS]["_repeated"] = repeated_day()
    if scans:
        levels[BARS]["_block_end"] = recurrence.block_end()
    for level in (BARS, RETURNS, RETURN_WINDOWS):
        df = _extend(df, levels[level])
    if scans:
        df = df.withColumns(recurrence.local_values(scans))
        df = df.withColumns(recurrence.finished_blocks(scans))
        df = df.withColumns(recurrence.results(scans, CARRY if carried else None))
    for level in (LINES, PIECES, PARTS, CENTRES, FRAMES, INDICATORS, SIGNAL, FINAL):
        df = _extend(df, levels[level])
    if states:
        df = df.withColumn(STATE, _month_end_state(features))
    kept = [c for c in bars.columns if c != CARRY]
    front = [checked_date("_repeated") if c == "date" else c for c in kept]
    return df.select(*front, *[c for c in outputs if c not in kept], *([STATE] if states else []))


def state_type() -> str:
    """The type of the state of all features, as SQL writes it."""
    names = dict.fromkeys(name for f in all_features() for name in f.state)
    kinds = {"rows": "int", "closes": "bigint"}
    return f"struct<date:date,{','.join(f'{n}:{kinds.get(n, "double")}' for n in names)}>"


def _month_end_state(features: list[Feature]) -> Column:
    month = F.last_day("date")
    following = F.lead(month).over(ticker_window())
    fields = {name: column for f in features for name, column in f.state.items()}
    state = F.struct(F.col("date").alias("date"), *[c.alias(name) for name, c in fields.items()])
    return F.when(F.coalesce(following != month, F.lit(True)), state)


def _extend(df: DataFrame, columns: dict[str, Column]) -> DataFrame:
    return df.withColumns(columns) if columns else df
