"""Row-level cleaning and deduplication of bars and articles."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import ohlc, text
from .joins import lookup_table


# Zones that RFC 2822 names, as offsets.
ZONES = {
    "GMT": "+0000",
    "UTC": "+0000",
    "UT": "+0000",
    "Z": "+0000",
    "EST": "-0500",
    "EDT": "-0400",
    "CST": "-0600",
    "CDT": "-0500",
    "MST": "-0700",
    "MDT": "-0600",
    "PST": "-0800",
    "PDT": "-0700",
}


def first_per_key(df: DataFrame, keys: Sequence[str | Column], order: Sequence[str | Column]) -> DataFrame:
    """The first row of each key in ``order``.

    Spark applies the rank limit before the shuffle as well, so a key with many copies leaves each map
    task with a single row.
    """
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn("_rank", rank).where("_rank = 1").drop("_rank")


def one_bar_per_day(bars: DataFrame, order: Sequence[str | Column], ticker: str = "ticker") -> DataFrame:
    return first_per_key(bars, [ticker, "date"], order)


def _written_date(text: Column) -> Column:
    """A date in words, as mail and news services write it, as a timestamp: ``Fri, 25 Oct 2024 16:00:00 -0400``.

    The name of the day does not count, seconds and the zone may be missing. Names of zones are those of RFC 2822.
    """
    plain = F.regexp_replace(F.trim(text), r"^[A-Za-z]{3,9}\.?,?\s+(?=\d)", "")
    numbered = plain
    for name, offset in ZONES.items():
        numbered = F.regexp_replace(numbered, rf"(?i)\s+{name}$", f" {offset}")
    # The first form that fits counts; a zone of its own places the time, without one it is UTC.
    forms = ("d MMM yyyy HH:mm:ss xx", "d MMM yyyy HH:mm xx", "d MMM yyyy HH:mm:ss", "d MMM yyyy HH:mm", "d MMM yyyy", "M/d/yyyy")
    return F.coalesce(*[F.try_to_timestamp(numbered, F.lit(form)) for form in forms])


def as_timestamp(df: DataFrame, column: str) -> Column:
    """The column as a timestamp; text may be ISO 8601 or a date in words. NULL where a text is none."""
    if dict(df.dtypes)[column] != "string":
        return F.col(column).cast("timestamp")
    return F.coalesce(F.try_to_timestamp(column), _written_date(F.col(column)))


def as_date(df: DataFrame, column: str) -> Column:
    """The column as a date, with or without a time of day; NULL where a text is none. See ``as_timestamp``."""
    if dict(df.dtypes)[column] != "string":
        return F.col(column).cast("date")
    return F.coalesce(F.try_to_date(column, "yyyy-MM-dd"), as_timestamp(df, column).cast("date"))


def unread_date(df: DataFrame, column: str) -> Column:
    """Whether the column holds text that is no date."""
    return as_date(df, column).isNull() & ~text.blank(F.col(column).cast("string"))


def parse_date(df: DataFrame, column: str = "date") -> DataFrame:
    """Turn text into a date, NULL where it is none; other types are only cast."""
    return df.withColumn(column, as_date(df, column))


def repair_ohlc(bars: DataFrame) -> DataFrame:
    """Widen high and low where the price order is broken; NULL prices stay NULL."""
    return bars.withColumns({"high": ohlc.repaired_high(), "low": ohlc.repaired_low()})


def ohlc_violations(bars: DataFrame) -> DataFrame:
    return bars.where(ohlc.invalid_ohlc()).withColumns(ohlc.violation_labels())


def in_range(df: DataFrame, start, end, column: str = "date") -> DataFrame:
    return df.where(F.col(column).between(F.lit(start).cast("date"), F.lit(end).cast("date")))


def only_tickers(df: DataFrame, tickers: Sequence[str] | DataFrame, column: str = "ticker") -> DataFrame:
    if isinstance(tickers, DataFrame):
        return df.join(lookup_table(tickers, [column]), column, "left_semi")
    return df.where(F.col(column).isin(list(tickers)))


def valid_articles(news: DataFrame) -> DataFrame:
    return news.where(
        F.col("ticker").isNotNull() & F.col("query_date").isNotNull() & ~text.blank(F.col("title"))
    )


def implausible_date(column: str, today, days: int = 730) -> Column:
    day = F.lit(today).cast("date")
    return (F.col(column) < F.date_sub(day, days)) | (F.col(column) > day)


def _rounded(name: str, places: int) -> Column:
    """``F.round`` of a double, half up as its shortest decimal form reads, mostly without decimal arithmetic.

    Away from a half the nearest whole number of the smallest unit is the same either way. The limits leave several times the
    error of one product; NaN, infinities and what comes near a half fail them and are rounded as decimals. That rare
    case stands in a lambda, which keeps its code and that of the whole projection in small methods.
    """
    value, unit = F.col(name), 10.0**places
    scaled = value * unit
    above = scaled - F.floor(scaled)
    clear = (F.abs(scaled) < 1e15) & (F.abs(above - 0.5) > F.abs(scaled) * 1e-15)
    as_decimal = F.get(F.transform(F.array(value), lambda v: F.round(v, places)), 0)
    return F.when(clear, F.floor(scaled + 0.5) / unit).when(value.isNotNull(), as_decimal)


def round_numbers(df: DataFrame, places: int = 4) -> DataFrame:
    """Round every fractional column in one projection."""

    def rounded(name: str, kind: str) -> Column:
        if kind == "double" and 0 <= places <= 15:
            return _rounded(name, places).alias(name)
        return F.round(name, places).alias(name) if kind.startswith(("double", "float", "decimal")) else F.col(name)

    return df.select(*[rounded(name, kind) for name, kind in df.dtypes])


def columns_first(df: DataFrame, names: Sequence[str]) -> DataFrame:
    front = [n for n in names if n in df.columns]
    return df.select(*front, *[c for c in df.columns if c not in front])


def conform(df: DataFrame, schema, strict: bool = False) -> DataFrame:
    """Exactly the columns of ``schema``, cast; missing ones become typed NULLs. Names match in any case."""
    extra = unknown_columns(df, schema)
    if strict and extra:
        raise ValueError(f"unknown columns: {extra}")
    held = {c.lower(): c for c in df.columns}
    return df.select(
        *[
            (F.col(held[f.name.lower()]) if f.name.lower() in held else F.lit(None)).cast(f.dataType).alias(f.name)
            for f in schema.fields
        ]
    )


def unknown_columns(df: DataFrame, schema) -> list[str]:
    known = {name.lower() for name in schema.fieldNames()}
    return [c for c in df.columns if c.lower() not in known]


IDENTITY = ("_no_url", "_identity")


def article_identity() -> tuple[Column, Column]:
    """Whether there is no url, and the url or else the title."""
    no_url = text.blank(F.col("url"))
    identity = F.when(no_url, text.strip(F.col("title"))).otherwise(F.col("url"))
    return no_url, F.coalesce(identity, F.lit(""))


def dedup_articles(
    news: DataFrame, keys: Sequence[str], order: Sequence[str | Column], keep_identity: bool = False
) -> DataFrame:
    """One article per key and url; articles without a url are told apart by title.

    With ``keep_identity`` the columns that, after ``keys``, identify an article stay in the result. Rows are
    partitioned by all of them.
    """
    tagged = news.withColumns(dict(zip(IDENTITY, article_identity())))
    single = first_per_key(tagged, [*keys, *IDENTITY], order)
    return single if keep_identity else single.drop(*IDENTITY)


def dedup_articles_by_url_then_title(
    news: DataFrame, group: Sequence[str], row_key: str, order: Sequence[str]
) -> DataFrame:
    """Keep the first article of a url, and any other article whose title is new among those others.

    A repeated url thus survives once per title. Both rules are decided on narrow rows and come back to
    the articles through ``row_key``, which is unique, so neither a popular url nor a popular title gathers
    in one task.
    """
    narrow = news.select(
        row_key,
        *group,
        *[c for c in order if c not in (row_key, *group)],
        F.col("url").alias("_url"),
        text.strip(F.coalesce("title", F.lit(""))).alias("_title"),
    )
    with_url = narrow.where("_url IS NOT NULL AND _url != ''")
    by_url = first_per_key(with_url, [*group, "_url"], order).select(row_key)
    others = narrow.where("_title != ''").join(by_url, row_key, "left_anti")
    by_title = first_per_key(others, [*group, "_title"], order).select(row_key)
    return news.join(by_url.unionAll(by_title), row_key, "left_semi")
