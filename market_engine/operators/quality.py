"""Data-quality checks as a long table: check, item, failures, percentage, critical, passed, detail.

Row checks, repeated days, date gaps and the lists of the worst of them come from one scan, counted per
(ticker, day) with map-side combining. The lists are put together in steps, per ticker, per bucket of tickers and in
all, and cut to their length in each, so none holds more than a ticker's calendar or a bucket's cut lists.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import ohlc, text
from .clean import as_date, implausible_date, unread_date

MAX_GAP_DAYS = 7
#: Entries of a list in a report, and buckets of tickers between the lists of tickers and that of all.
LISTED = 5
BUCKETS = 1024
MAX_URL = 100
REQUIRED_NEWS = ("ticker", "query_date", "title")
# Type families each column is expected to have.
PRICE_TYPES = {
    "ticker": "string",
    "date": "date",
    "open": "floating",
    "high": "floating",
    "low": "floating",
    "close": "floating",
    "volume": "integer",
}
NEWS_TYPES = {
    "ticker": "string",
    "query_date": "date",
    "title": "string",
    "text": "string",
    "url": "string",
    "date_key": "string",
}
FAMILIES = {
    "string": "string",
    "date": "date",
    "timestamp": "date",
    "timestamp_ntz": "date",
    "double": "floating",
    "float": "floating",
    "bigint": "integer",
    "int": "integer",
    "smallint": "integer",
    "tinyint": "integer",
}
CHECK_COLUMNS = ["check", "item", "failures", "percentage", "critical", "passed", "detail"]


def require_columns(df: DataFrame, columns: Sequence[str] = REQUIRED_NEWS) -> DataFrame:
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise ValueError(f"missing required columns: {missing}")
    return df


def news_metrics(news: DataFrame, today) -> DataFrame:
    """Counts of NULL and empty fields, implausible dates and repeated urls (or title and date)."""
    require_columns(news)
    keys = ["url"] if "url" in news.columns else ["title", "query_date"]
    metric = "duplicate_urls" if keys == ["url"] else "duplicate_title_date"
    repeated = news.groupBy(*keys).count().where("count > 1").agg(F.count("*").alias("n")).scalar()
    return news.agg(
        F.count_if(F.col("ticker").isNull()).alias("null_ticker"),
        F.count_if(F.col("query_date").isNull()).alias("null_date"),
        F.count_if(F.col("title").isNull()).alias("null_title"),
        F.count_if(text.blank(F.col("title"))).alias("empty_title"),
        F.count_if(implausible_date("query_date", today)).alias("invalid_dates"),
    ).withColumn(metric, repeated)


def price_flaws(bars: DataFrame) -> DataFrame:
    """One row of counts: zero, negative and non-positive values and broken price order."""
    return bars.agg(
        F.count("*").alias("records"),
        F.count_if(ohlc.negative_price()).alias("negative_prices"),
        *[F.count_if(F.col(c) <= 0).alias(f"non_positive_{c}") for c in ohlc.PRICES],
        F.count_if(ohlc.invalid_ohlc()).alias("invalid_ohlc"),
        F.count_if(F.col("volume") == 0).alias("zero_volume"),
        F.count_if(F.col("volume") < 0).alias("negative_volume"),
        F.count_if(ohlc.any_null("ticker", "date", "close")).alias("null_critical"),
    )


def type_checks(df: DataFrame, expected: dict[str, str]) -> list[tuple[str, str, str, bool]]:
    """Column, expected family, actual type, passed; columns that are absent are not checked."""
    actual = dict(df.dtypes)
    return [(c, want, actual[c], FAMILIES.get(actual[c]) == want) for c, want in expected.items() if c in actual]


#: A check: name, item, failures as an aggregate, critical, percentage given, detail.
Check = tuple[str, str, Column, bool, bool, Column | None]


def _report(totals: DataFrame, checks: list[Check], lists: Sequence[Column] = ()) -> DataFrame:
    """One row per check from the single row of ``totals``, whose ``_rows`` the percentages refer to.

    ``lists`` are arrays of (check, item, failures, detail), which give a row for each entry.
    """
    rows = []
    for name, item, failures, critical, share, detail in checks:
        count = F.coalesce(failures.cast("long"), F.lit(0).cast("long"))
        part = F.coalesce(F.try_divide(count * 100.0, F.col("_rows")), F.lit(0.0)) if share else F.lit(None).cast("double")
        rows.append(_row(F.lit(name), F.lit(item), count, part, critical, F.lit(None) if detail is None else detail))
    listed = [
        F.transform(entries, lambda e: _row(e["check"], e["item"], e["failures"], F.lit(None).cast("double"), False, e["detail"]))
        for entries in lists
    ]
    return totals.select(F.inline(F.concat(F.array(*rows), *listed))).select(*CHECK_COLUMNS)


def _row(check: Column, item: Column, failures: Column, percentage: Column, critical: bool, detail: Column) -> Column:
    return F.struct(
        check.alias("check"),
        item.alias("item"),
        failures.cast("long").alias("failures"),
        percentage.alias("percentage"),
        F.lit(critical).alias("critical"),
        (failures == 0).alias("passed"),
        detail.cast("string").alias("detail"),
    )


def _entries(column: str, check: str, failures, detail) -> Column:
    """A list of the totals as numbered rows of the report."""
    return F.transform(
        F.col(column),
        lambda e, i: F.struct(
            F.lit(check).alias("check"),
            (i + 1).cast("string").alias("item"),
            failures(e).cast("long").alias("failures"),
            detail(e).cast("string").alias("detail"),
        ),
    )


def _summary(rows_name: str) -> list[Column]:
    """Rows without failures that tell how much there is."""
    average = F.coalesce(F.try_divide(F.col("_rows"), F.col("_tickers")), F.lit(0.0))
    values = {
        "unique_tickers": F.col("_tickers"),
        "unique_dates": F.size("_days"),
        rows_name: F.round(average, 1).cast("decimal(20,1)"),
        "date_range_days": F.datediff("_last", "_first"),
    }
    none = F.lit(0).cast("long").alias("failures")
    return [
        F.array(F.struct(F.lit("summary").alias("check"), F.lit(k).alias("item"), none, v.cast("string").alias("detail")))
        for k, v in values.items()
    ]


def _type_rows(df: DataFrame, expected: dict[str, str]) -> list[Check]:
    """A wrong type is one failure, with or without rows."""
    return [
        ("column_types", c, F.lit(int(not passed)), False, False, F.lit(f"expected {want}, found {actual}"))
        for c, want, actual, passed in type_checks(df, expected)
    ]


def _null_dates(df: DataFrame, columns: Sequence[str]) -> list[tuple[str, str, Column, bool]]:
    """Text that is no date counts as NULL, and once more as what it is."""
    held = [c for c in columns if c in df.columns]
    texts = [c for c in held if dict(df.dtypes)[c] == "string"]
    missing = [("null_dates", c, as_date(df, c).isNull(), True) for c in held]
    return missing + [("unread_dates", c, unread_date(df, c), False) for c in texts]


def _smallest(column: str, n: int = LISTED) -> Column:
    """The first entries of all the lists in a column."""
    return F.slice(F.array_sort(F.flatten(F.collect_list(column))), 1, n).alias(column)


def _per_day(df: DataFrame, date: str, checks: list[tuple[str, str, Column, bool]], exact: Sequence[str]) -> DataFrame:
    """Rows and failing rows of each ticker and day; with ``exact`` also groups of rows alike in these columns, and
    the first row of the day that is broken."""
    counts = [f"_{i}" for i in range(len(checks))]
    failing = [F.count_if(condition).alias(name) for name, (_, _, condition, _) in zip(counts, checks)]
    keys = ["ticker", F.col(date).alias("_date")]
    if not exact:
        return df.groupBy(*keys).agg(F.count("*").alias("_n"), *failing)
    alike = df.groupBy(*keys, *exact).agg(F.count("*").alias("_n"), *failing)
    whole = ~ohlc.any_null("ticker", "_date", *exact)
    labels = F.concat_ws(", ", *[F.when(broken, F.lit(label)) for label, broken in ohlc.order_violations().items()])
    broken = F.when(ohlc.invalid_ohlc(), F.struct(*ohlc.PRICES, labels.alias("labels")))
    return alike.groupBy("ticker", "_date").agg(
        F.sum("_n").alias("_n"),
        *[F.sum(c).alias(c) for c in counts],
        F.count_if(whole & (F.col("_n") > 1)).alias("_alike"),
        F.min(broken).alias("_broken"),
    )


def _totals(
    df: DataFrame, date: str, checks: list[tuple[str, str, Column, bool]], more: dict[str, Column], exact: Sequence[str] = ()
) -> DataFrame:
    """Failing rows of each check, gaps between a ticker's days and the longest lists of both, from one scan.

    Only narrow counts meet in the window over a ticker's calendar. ``more`` are further counts of its days.
    """
    groups = _per_day(df, date, checks, exact)
    days = groups.withColumn("_day", as_date(groups, "_date"))
    previous = F.lag("_day").over(Window.partitionBy("ticker").orderBy("_day"))
    days = days.withColumn("_before", previous).withColumn("_gap", F.datediff("_day", "_before"))
    gap = F.struct((-F.col("_gap")).alias("days"), "ticker", F.col("_before").alias("start"), F.col("_day").alias("end"))
    repeated = F.struct("ticker", F.col("_date").cast("string").alias("date"), F.col("_n").alias("n"))
    complete = F.col("ticker").isNotNull() & F.col("_date").isNotNull()
    lists = {
        "_gap_list": F.when(F.col("_gap") > MAX_GAP_DAYS, gap),
        "_repeated_list": F.when(complete & (F.col("_n") > 1), repeated),
    }
    sums = {f"_{i}": F.sum(f"_{i}") for i in range(len(checks))}
    sums |= {
        "_rows": F.sum("_n"),
        "_repeated": F.sum(F.when(F.col("_n") > 1, F.col("_n"))),
        "_groups": F.count_if(F.col("_n") > 1),
        "_tickers": F.max(F.col("ticker").isNotNull().cast("int")),
        **more,
    }
    if exact:
        lists["_broken_list"] = F.when(
            F.col("_broken").isNotNull(), F.struct("ticker", F.col("_date").cast("string").alias("date"), F.col("_broken").alias("row"))
        )
        sums["_alike"] = F.sum("_alike")
    tops = {"_largest": F.max("_n"), "_longest": F.max("_gap"), "_last": F.max("_day")}
    per_ticker = days.groupBy("ticker").agg(
        *[column.alias(name) for name, column in (sums | tops).items()],
        F.min("_day").alias("_first"),
        F.collect_set("_day").alias("_days"),
        *[F.slice(F.array_sort(F.collect_list(entry)), 1, LISTED).alias(name) for name, entry in lists.items()],
    )
    folded = [
        *[F.sum(name).alias(name) for name in sums],
        *[F.max(name).alias(name) for name in tops],
        F.min("_first").alias("_first"),
        F.array_distinct(F.flatten(F.collect_list("_days"))).alias("_days"),
        *[_smallest(name) for name in lists],
    ]
    buckets = per_ticker.groupBy(F.pmod(F.xxhash64("ticker"), F.lit(BUCKETS))).agg(*folded)
    totals = buckets.agg(*folded)
    return totals.withColumns({name: F.coalesce(name, F.lit(0)) for name in ("_rows", "_tickers")}).withColumn(
        "_range", F.concat_ws(" to ", F.col("_first").cast("string"), F.col("_last").cast("string"))
    )


def _rows_of(checks: list[tuple[str, str, Column, bool]], date: str) -> list[Check]:
    span = F.concat("_range", F.lit(", "), F.size("_days").cast("string"), F.lit(" days"))
    return [
        (name, item, F.col(f"_{i}"), critical, True, span if (name, item) == ("null_dates", date) else None)
        for i, (name, item, _, critical) in enumerate(checks)
    ]


def _group_detail(groups: str, largest: str, rows: str) -> Column:
    average = F.round(F.coalesce(F.try_divide(F.col(rows), F.col(groups)), F.lit(0.0)), 1).cast("decimal(20,1)")
    return F.concat(
        F.coalesce(F.col(groups), F.lit(0)).cast("string"),
        F.lit(" groups, at most "),
        F.coalesce(F.col(largest), F.lit(0)).cast("string"),
        F.lit(" rows, "),
        average.cast("string"),
        F.lit(" on average"),
    )


def _gap_detail() -> Column:
    return F.concat(F.lit("longest "), F.coalesce(F.col("_longest"), F.lit(0)).cast("string"), F.lit(" days"))


def _gap_entries() -> Column:
    return _entries("_gap_list", "longest_gap", lambda e: -e["days"], lambda e: F.concat_ws(" ", e["ticker"], e["start"], F.lit("to"), e["end"]))


def _broken_entries() -> Column:
    def detail(e: Column) -> Column:
        prices = [F.coalesce(F.round(e["row"][c], 4).cast("decimal(28,4)").cast("string"), F.lit("none")) for c in ohlc.PRICES]
        named = [part for c, price in zip(ohlc.PRICES, prices) for part in (F.lit(c), price)]
        return F.concat(F.concat_ws(" ", e["ticker"], e["date"], *named), F.lit(": "), e["row"]["labels"])

    return _entries("_broken_list", "broken_row", lambda e: F.size(F.split(e["row"]["labels"], ", ")), detail)


def price_report(bars: DataFrame) -> DataFrame:
    """Checks of bars, their longest gaps, the first repeated days and broken rows, and a summary."""
    checks = _null_dates(bars, ("date", "date_key"))
    checks += [("prices_positive", c, F.col(c) <= 0, True) for c in ohlc.PRICES]
    checks += [("volume_non_negative", "volume", F.col("volume") < 0, True)]
    checks += [("ohlc_order", "all", ohlc.invalid_ohlc(), True)]
    totals = _totals(bars, "date", checks, {"_gaps": F.count_if(F.col("_gap") > MAX_GAP_DAYS)}, (*ohlc.PRICES, "volume"))
    rows = _rows_of(checks, "date") + _type_rows(bars, PRICE_TYPES)
    rows += [
        ("duplicates", "ticker,date", F.col("_repeated"), True, False, _group_detail("_groups", "_largest", "_repeated")),
        ("duplicates", "all_columns", F.col("_alike"), False, False, F.lit("groups of rows alike in prices and volume")),
        ("date_gaps", f"over_{MAX_GAP_DAYS}_days", F.col("_gaps"), False, False, _gap_detail()),
    ]
    repeated = _entries("_repeated_list", "repeated_day", lambda e: e["n"], lambda e: F.concat_ws(" ", e["ticker"], e["date"]))
    return _report(totals, rows, [_gap_entries(), repeated, _broken_entries(), *_summary("records_per_ticker")])


def news_report(news: DataFrame) -> DataFrame:
    """One scan for the rows and days, one for repeated urls and titles and the first groups of them."""
    checks = _null_dates(news, ("date", "query_date", "article_date", "query_date_parsed", "date_key"))
    title = F.col("title")
    checks += [
        ("required_fields", "title", title.isNull() | (text.strip(title) == ""), True),
        ("required_fields", "ticker", F.col("ticker").isNull(), True),
    ]
    more = {"_gaps": F.count_if(F.col("_gap") > 1), "_long_gaps": F.count_if(F.col("_gap") > MAX_GAP_DAYS)}
    totals = _totals(news, "query_date", checks, more)
    rows = _rows_of(checks, "query_date") + _type_rows(news, NEWS_TYPES)
    rows += [
        ("date_gaps", "over_1_day", F.col("_gaps"), False, False, _gap_detail()),
        ("date_gaps", f"over_{MAX_GAP_DAYS}_days", F.col("_long_gaps"), False, False, _gap_detail()),
    ]
    report = _report(totals, rows, [_gap_entries(), *_summary("articles_per_ticker")])

    url = next((c for c in ("url", "news_url") if c in news.columns), None)
    names = [c for c in (url, "title") if c]
    values = F.array(*[F.struct(F.lit(c).alias("name"), F.col(c).cast("string").alias("value")) for c in names])
    keys = ["ticker", "query_date", "name", "value"]
    repeated = news.select("ticker", "query_date", F.inline(values)).groupBy(*keys).count().where("count > 1")
    # Only the first groups of a bucket are put in lists, whatever number it has.
    bucket = F.pmod(F.xxhash64("ticker", "query_date"), F.lit(BUCKETS)).alias("_bucket")
    complete = F.col("ticker").isNotNull() & F.col("query_date").isNotNull() & F.col("value").isNotNull()
    order = Window.partitionBy("_bucket", "name").orderBy(complete.desc(), "ticker", "query_date", "value")
    ranked = repeated.select("*", bucket).withColumn("_rank", F.row_number().over(order))
    shown = F.when(F.length("value") > MAX_URL, F.concat(F.substring("value", 1, MAX_URL), F.lit("..."))).otherwise(F.col("value"))
    entry = F.struct(
        "ticker", F.col("query_date").cast("string").alias("date"), "value", F.col("count").alias("n"), shown.alias("shown")
    )
    sums, tops, lists = {}, {}, {}
    for i, c in enumerate(names):
        mine = F.col("name") == c
        sums |= {f"_repeated{i}": F.sum(F.when(mine, F.col("count"))), f"_groups{i}": F.count_if(mine)}
        tops |= {f"_largest{i}": F.max(F.when(mine, F.col("count")))}
        lists |= {f"_list{i}": F.collect_list(F.when(mine & complete & (F.col("_rank") <= LISTED), entry))}
    buckets = ranked.groupBy("_bucket").agg(*[column.alias(name) for name, column in (sums | tops | lists).items()])
    folded = buckets.agg(
        *[F.sum(c).alias(c) for c in sums], *[F.max(c).alias(c) for c in tops], *[_smallest(c) for c in lists]
    )
    doubles = [
        (
            "duplicates",
            f"ticker,query_date,{c}",
            F.col(f"_repeated{i}"),
            False,
            False,
            _group_detail(f"_groups{i}", f"_largest{i}", f"_repeated{i}"),
        )
        for i, c in enumerate(names)
    ]
    listed = [
        _entries(f"_list{i}", f"repeated_{c}", lambda e: e["n"], lambda e: F.concat_ws(" ", e["ticker"], e["date"], e["shown"]))
        for i, c in enumerate(names)
    ]
    return report.unionByName(_report(folded, doubles, listed))


def verdict(report: DataFrame) -> DataFrame:
    """PASS if every critical check passed."""
    passed = F.coalesce(F.bool_and(F.when(F.col("critical"), F.col("passed"))), F.lit(True))
    return report.agg(F.when(passed, F.lit("PASS")).otherwise(F.lit("FAIL")).alias("overall_status"))


def dataset_summary(df: DataFrame, date: str = "date") -> DataFrame:
    tickers = F.countDistinct("ticker")
    return df.agg(
        tickers.alias("unique_tickers"),
        F.countDistinct(date).alias("unique_dates"),
        F.coalesce(F.try_divide(F.count("*"), tickers), F.lit(0.0)).alias("records_per_ticker"),
    )
