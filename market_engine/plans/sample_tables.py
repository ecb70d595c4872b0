"""Market-shaped views over the generated sample tables.

Suppliers play tickers, shipped lines play trades, documents play articles. The square root of a price
keeps rounded results away from decimal ties.
"""

from __future__ import annotations

import string

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def bars(spark: SparkSession, folder: str, tasks: int | None = None) -> DataFrame:
    """Daily bars: first, highest, lowest and last price of a supplier's lines on one ship date.

    With ``tasks`` the lines themselves are dealt out by ticker to so many tasks. Windows over a ticker then need no
    shuffle of their own, but the lines of a day are not added up before the shuffle.
    """
    price = F.sqrt("l_extendedprice")
    position = F.struct("l_orderkey", "l_linenumber", "l_partkey")
    ticker = F.concat(F.lit("SRC"), F.col("l_suppkey").cast("string")).alias("ticker")
    day = F.col("l_shipdate").cast("date").alias("date")
    lines = table(spark, folder, "lineitem")
    # Grouping by the number rather than the name keeps sort and shuffle keys short.
    keys = ["l_suppkey", day]
    if tasks:
        # The same expression as the key of the windows, or Spark would shuffle once more.
        lines, keys = lines.repartition(tasks, ticker), [ticker, day]
    days = lines.groupBy(*keys).agg(
        F.min_by(price, position).alias("open"),
        F.max(price).alias("high"),
        F.min(price).alias("low"),
        F.max_by(price, position).alias("close"),
        F.sum("l_quantity").cast("double").alias("volume"),
    )
    return days.select("ticker" if tasks else ticker, "date", "open", "high", "low", "close", "volume")


def dirty_bars(spark: SparkSession, folder: str) -> DataFrame:
    """One bar per line: repeated days and broken price order."""
    price = F.sqrt("l_extendedprice")
    return table(spark, folder, "lineitem").select(
        F.concat(F.lit("SRC"), F.col("l_suppkey").cast("string")).alias("symbol"),
        F.col("l_shipdate").cast("date").alias("date"),
        price.alias("open"),
        (price * (0.99 + F.col("l_tax") / 2)).alias("high"),
        (price * (1 - F.col("l_tax"))).alias("low"),
        (price * (1 - F.col("l_discount"))).alias("close"),
        F.col("l_quantity").cast("double").alias("volume"),
        "l_orderkey",
        "l_linenumber",
        "l_partkey",
    )


def news(spark: SparkSession, folder: str) -> DataFrame:
    """Articles with missing urls, missing texts and repeated urls; doc_id is the arrival order."""
    return table(spark, folder, "documents").select(
        "doc_id",
        F.col("source").alias("ticker"),
        F.date_add(F.lit("1995-01-02").cast("date"), (F.col("doc_id") % 2400).cast("int")).alias("query_date"),
        F.substring_index("text", "\n", 1).alias("title"),
        F.when(F.col("doc_id") % 11 != 0, F.col("text")).alias("text"),
        F.when(F.col("doc_id") % 17 != 0, F.concat(F.lit("http://n/"), F.md5("text"))).alias("url"),
    )


def tickers(spark: SparkSession, folder: str) -> DataFrame:
    """One ticker per document source, named by two letters so that some texts mention it."""
    letter = F.chr(97 + F.expr("cast(substring(source, 4) as int)"))
    number = F.expr("cast(substring(source, 4) as int)")
    return (
        table(spark, folder, "documents")
        .select("source")
        .distinct()
        .select(
            F.concat(F.lit("E"), F.upper(letter)).alias("ticker"),
            F.concat(F.lit("o"), letter).alias("company_name"),
            F.when(number % 3 != 0, F.concat(F.lit("u"), letter)).alias("abbrev1"),
            F.when(number % 4 != 0, F.lit("tion")).alias("abbrev2"),
        )
    )


def candidates(spark: SparkSession, folder: str) -> DataFrame:
    """Documents as answers to searches; 400 consecutive documents make up a day."""
    doc, day = F.col("doc_id"), F.floor(F.col("doc_id") / 400).cast("int")
    # Every second day most answers come from the advanced search.
    slot = doc % 10 - F.when(day % 2 == 1, 4).otherwise(0)
    term = F.when(slot == 5, "company_name").when(slot == 6, "abbrev1").when(slot == 7, "abbrev2").otherwise("ticker")
    page = F.when(slot >= 8, 2 + F.floor(doc / 10) % 2).otherwise(1)
    endpoint = F.when((slot < 3) | (slot == 8), "advanced").otherwise("regular")
    return table(spark, folder, "documents").select(
        F.concat(F.lit("E"), F.upper(F.chr(97 + F.expr("cast(substring(source, 4) as int)")))).alias("ticker"),
        F.date_add(F.lit("1995-01-02").cast("date"), day).alias("date"),
        endpoint.alias("endpoint"),
        term.alias("term"),
        page.cast("int").alias("page"),
        doc.alias("rank"),
        F.substring_index("text", "\n", 1).alias("title"),
        "text",
        F.when(doc % 17 != 0, F.concat(F.lit("http://n/"), (doc % 350).cast("string"))).alias("url"),
        (doc % 37 == 0).alias("failed"),
    )


def chart_payloads(spark: SparkSession, folder: str) -> DataFrame:
    """Chart answers per ticker and year; the open prices of each lack the last day."""
    day = bars(spark, folder).withColumn("year", F.year("date"))
    ordered = F.array_sort(F.collect_list(F.struct("date", "open", "high", "low", "close", "volume")))
    answers = day.groupBy("ticker", "year").agg(ordered.alias("days"))

    def values(name: str):
        return F.transform("days", lambda d: d[name])

    times = F.transform("days", lambda d: F.unix_date(d["date"]).cast("bigint") * 86400 + 43200)
    quote = F.struct(
        F.slice(values("open"), 1, F.size("days") - 1).alias("open"),
        values("high").alias("high"),
        values("low").alias("low"),
        values("close").alias("close"),
        F.transform("days", lambda d: d["volume"].cast("bigint")).alias("volume"),
    )
    result = F.struct(times.alias("timestamp"), F.struct(F.array(quote).alias("quote")).alias("indicators"))
    body = F.to_json(F.struct(F.struct(F.array(result).alias("result")).alias("chart")))
    return answers.select(
        F.col("ticker").alias("symbol"), "year", F.concat(F.lit("<pre>"), body, F.lit("</pre>")).alias("payload")
    )


def news_payloads(spark: SparkSession, folder: str) -> DataFrame:
    """One answer per document; every thirteenth has no data entry."""
    article = F.struct(
        F.substring_index("text", "\n", 1).alias("title"),
        F.col("text"),
        F.lit("2024-01-02").alias("date"),
        F.concat(F.lit("http://n/"), F.md5("text")).alias("url"),
        F.col("source"),
    )
    full = F.to_json(F.struct(F.array(article).alias("data")))
    return table(spark, folder, "documents").select(
        "doc_id", F.when(F.col("doc_id") % 13 == 0, F.lit('{"message": "none"}')).otherwise(full).alias("payload")
    )


def lexicon(spark: SparkSession) -> DataFrame:
    """A small word list for trying out the lexicon scores."""
    return spark.sql(
        "SELECT * FROM VALUES ('the', 0.5D), ('and', -0.3D), ('of', 1.2D), ('is', -1.1D), ('that', 0.8D) AS t(word, valence)"
    )


def shifters(spark: SparkSession) -> DataFrame:
    """Frequent words of the sample as boosters, negations and words of contrast."""
    return spark.sql(
        "SELECT * FROM VALUES ('to', 'booster', 0.293D), ('on', 'booster', -0.293D), ('in', 'negation', 0D), ('that', 'negation', 0D), "
        "('with', 'contrast', 0D) AS t(word, kind, amount)"
    )


def emphatic_texts(spark: SparkSession, folder: str) -> DataFrame:
    """Articles whose titles are in capitals, and which end in exclamation and question marks; some have no text."""
    doc = F.col("doc_id")
    marks = F.concat(F.repeat(F.lit("!"), (doc % 6).cast("int")), F.repeat(F.lit("?"), (doc % 5).cast("int")))
    # Letters outside ASCII have no capitals that all engines agree on.
    title = F.translate(F.substring_index("text", "\n", 1), string.ascii_lowercase, string.ascii_uppercase)
    whole = F.concat_ws(" ", title, F.col("text"), marks)
    return table(spark, folder, "documents").select("doc_id", F.when(doc % 13 != 0, whole).alias("sentiment_text"))


def mixed_chart_payloads(spark: SparkSession, folder: str) -> DataFrame:
    """The chart answers; some are cut off, absent or without a result."""
    answers = chart_payloads(spark, folder)
    kind = F.pmod(F.expr("cast(substring(symbol, 4) as int)") + F.col("year"), F.lit(7))
    payload = (
        F.when(kind == 0, F.expr("substring(payload, 1, length(payload) div 2)"))
        .when(kind == 1, F.lit(None))
        .when(kind == 2, '{"chart": {"result": null, "error": {"code": "Not Found"}}}')
        .when(kind == 3, '{"chart": {"result": []}}')
        .when(kind == 4, "<html>busy</html>")
        .otherwise(F.col("payload"))
    )
    return answers.withColumn("payload", payload)


def mixed_news_payloads(spark: SparkSession, folder: str) -> DataFrame:
    """The news answers; some more are cut off or blank."""
    cut = F.when(F.col("doc_id") % 7 == 1, F.expr("substring(payload, 1, length(payload) - 5)"))
    return news_payloads(spark, folder).withColumn("payload", cut.when(F.col("doc_id") % 7 == 2, " ").otherwise(F.col("payload")))


def written_dates(spark: SparkSession, folder: str) -> DataFrame:
    """Days written in the ways the sources write them; every sixth is none."""
    day = F.date_add(F.lit("1995-01-02").cast("date"), (F.col("doc_id") % 2400).cast("int"))
    kind = F.col("doc_id") % 6
    # Ten in the evening, four hours behind, is the next day.
    written = (
        F.when(kind == 0, day.cast("string"))
        .when(kind == 1, F.concat(F.lit("Mon, "), F.date_format(day, "dd MMM yyyy"), F.lit(" 22:00:00 -0400")))
        .when(kind == 2, F.concat(day.cast("string"), F.lit("T08:30:00Z")))
        .when(kind == 3, F.date_format(day, "M/d/yyyy"))
        .when(kind == 4, F.concat(F.date_format(day, "d MMM yyyy"), F.lit(" 23:30 EST")))
        .otherwise("soon")
    )
    return table(spark, folder, "documents").select("doc_id", written.alias("date"))
