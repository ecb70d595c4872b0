"""Rows out of raw JSON answers.

Each answer is parsed once, to what it holds and how that went. What is stored and what is refused are then two
views of the same rows, so together they account for every answer.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructType

from ..schemas import CHART, NEWS_PAYLOAD

FIELDS = ("open", "high", "low", "close", "volume")
#: Outcomes of parsing. In an answer read in part some values have another type than expected and are NULL.
READ, PARTLY, EMPTY, BROKEN, NO_RESULT = "read", "read in part", "empty", "broken", "no result"
_CORRUPT = "_corrupt"
#: Characters of a refused answer that are shown.
EXCERPT = 200


def _parsed(body: Column, schema: StructType) -> Column:
    """The JSON by the schema, with the text itself in ``_CORRUPT`` where something could not be read."""
    return F.from_json(body, StructType([*schema.fields]).add(_CORRUPT, StringType()), {"columnNameOfCorruptRecord": _CORRUPT})


def _outcome(text: Column, parsed: str, result: Column, error: Column) -> Column:
    broken = F.col(parsed).isNull() | F.col(f"{parsed}.{_CORRUPT}").isNotNull()
    return (
        F.when(F.coalesce(F.trim(text), F.lit("")) == "", EMPTY)
        .when(result.isNotNull() & broken, PARTLY)
        .when(result.isNotNull(), READ)
        .when(broken, BROKEN)
        .otherwise(F.concat_ws(": ", F.lit(NO_RESULT), error))
    )


def chart_answers(payloads: DataFrame, column: str = "payload", symbol: str = "symbol") -> DataFrame:
    """A row per chart answer: symbol, answer (struct), outcome, excerpt.

    The JSON may be wrapped in other text. An answer without a result says why where the service does.
    """
    body = F.regexp_extract(column, r"(?s)(\{.*\})", 1)
    parsed = payloads.select(symbol, F.col(column).alias("_text"), _parsed(body, CHART).alias("_parsed"))
    answer = F.get("_parsed.chart.result", 0)
    outcome = _outcome(F.col("_text"), "_parsed", answer, F.col("_parsed.chart.error.code"))
    return parsed.select(
        symbol, answer.alias("answer"), outcome.alias("outcome"), F.substring("_text", 1, EXCERPT).alias("excerpt")
    )


def news_answers(payloads: DataFrame, column: str = "payload", keep: tuple[str, ...] = ()) -> DataFrame:
    """A row per news answer: the columns to keep, entries (array of structs), outcome, excerpt."""
    parsed = payloads.select(*keep, F.col(column).alias("_text"), _parsed(F.col(column), NEWS_PAYLOAD).alias("_parsed"))
    entries = F.col("_parsed.data")
    outcome = _outcome(F.col("_text"), "_parsed", entries, F.col("_parsed.message"))
    return parsed.select(
        *keep, entries.alias("entries"), outcome.alias("outcome"), F.substring("_text", 1, EXCERPT).alias("excerpt")
    )


def refused(answers: DataFrame) -> DataFrame:
    """The answers that give no rows, with the reason."""
    shown = [c for c in answers.columns if c not in ("answer", "entries")]
    return answers.where(~F.col("outcome").isin(READ, PARTLY)).select(*shown)


def outcomes(answers: DataFrame) -> DataFrame:
    """How many answers were read and how many refused, by reason."""
    return answers.groupBy("outcome").agg(F.count("*").alias("answers"))


def bars_of(answers: DataFrame, symbol: str = "symbol", zone: str = "UTC") -> DataFrame:
    """Daily bars from chart answers.

    Quote arrays go with the time stamps by position; where an array is shorter the value is NULL. ``zone`` is the
    exchange's time zone. Answers without a result give no rows.
    """
    parsed = answers.select(
        symbol, F.col("answer.timestamp").alias("time"), F.get("answer.indicators.quote", 0).alias("_quote")
    )
    arrays = [F.coalesce(F.col(f"_quote.{f}"), F.array()).alias(f) for f in FIELDS]
    rows = (
        parsed.select(symbol, F.col("time"), F.size("time").alias("_n"), *arrays)
        .where("_n > 0")
        .select(symbol, F.slice(F.arrays_zip("time", *FIELDS), 1, F.col("_n")).alias("_rows"))
        .select(symbol, F.inline("_rows"))
    )
    # Days counted from shifted seconds do not depend on the session's own time zone.
    local = F.unix_seconds(F.from_utc_timestamp(F.timestamp_seconds("time"), zone))
    return rows.select(symbol, F.date_from_unix_date(F.floor(local / 86400).cast("int")).alias("date"), *FIELDS)


def articles_of(answers: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """One row per entry of the news answers; answers without entries give no rows."""
    return answers.select(*keep, F.inline("entries"))


def chart_bars(payloads: DataFrame, column: str = "payload", symbol: str = "symbol", zone: str = "UTC") -> DataFrame:
    """Daily bars straight from payloads; see ``chart_answers`` and ``bars_of``."""
    return bars_of(chart_answers(payloads, column, symbol), symbol, zone)


def articles(payloads: DataFrame, column: str = "payload", keep: tuple[str, ...] = ()) -> DataFrame:
    """Articles straight from payloads; see ``news_answers`` and ``articles_of``."""
    return articles_of(news_answers(payloads, column, keep), keep)
