"""One key holds a third of the rows: the work must leave the map side small, or be split."""

import re

import pytest
from frames import plan_of
from pyspark.sql import functions as F

from market_engine.operators import candidates, clean, gold, sentiment, summaries, windows
from market_engine.operators.joins import lookup_table
from market_engine.plans import news as news_plan

ROWS = 60_000


@pytest.fixture(scope="module")
def hot(spark, tmp_path_factory):
    """Articles of which a third share ticker, day and url."""
    path = str(tmp_path_factory.mktemp("hot") / "articles")
    third = F.col("id") % 3 == 0
    spark.range(0, ROWS, 1, 6).select(
        F.col("id"),
        F.when(third, "HOT").otherwise(F.concat(F.lit("T"), (F.col("id") % 500).cast("string"))).alias("ticker"),
        F.when(third, F.lit("2024-01-02")).otherwise(F.date_add(F.lit("2024-01-01").cast("date"), (F.col("id") % 90).cast("int")).cast("string")).cast("date").alias("query_date"),
        F.when(third, "same").otherwise(F.concat(F.lit("u"), F.col("id").cast("string"))).alias("url"),
        F.concat(F.lit("title "), (F.col("id") % 7).cast("string")).alias("title"),
        F.lit("good words here").alias("text"),
    ).write.parquet(path)
    return spark.read.parquet(path)


def ranks_before_shuffle(df):
    """Rank limits below the first exchange, counted from the scan upwards."""
    plan = plan_of(df)
    return len(re.findall(r"WindowGroupLimit [^\n]*Partial", plan))


def test_first_per_key_is_limited_on_the_map_side(hot):
    out = clean.dedup_articles(hot, ["ticker", "query_date"], ["id"])
    assert ranks_before_shuffle(out) == 1
    assert out.where("ticker = 'HOT'").count() == 1
    assert out.count() == 1 + ROWS * 2 // 3


def test_bars_of_a_day_are_limited_on_the_map_side(hot):
    out = clean.one_bar_per_day(hot.withColumnRenamed("query_date", "date"), ["id"])
    assert ranks_before_shuffle(out) == 1
    assert [r.id for r in out.where("ticker = 'HOT'").collect()] == [0]


def test_title_fallback_with_a_hot_url(hot):
    out = clean.dedup_articles_by_url_then_title(hot, ["ticker", "query_date"], "id", ["id"])
    assert ranks_before_shuffle(out) >= 2
    # The first article of the url, and one for each of the titles among the rest.
    assert out.where("ticker = 'HOT'").count() == 8


def test_selection_with_a_hot_day(spark, hot):
    rows = hot.select(
        "ticker",
        F.col("query_date").alias("date"),
        F.when(F.col("id") % 2 == 0, "advanced").otherwise("regular").alias("endpoint"),
        F.lit("ticker").alias("term"),
        F.when(F.col("id") % 2 == 0, 1 + F.col("id") % 4).otherwise(1).cast("int").alias("page"),
        F.col("id").alias("rank"),
        "title",
        "text",
        "url",
        (F.col("id") < 0).alias("failed"),
    )
    names = rows.select("ticker").distinct().selectExpr("ticker", "'x' company_name", "cast(null as string) abbrev1", "cast(null as string) abbrev2")
    out = candidates.select_articles(rows, names)
    assert ranks_before_shuffle(out) >= 2
    chosen = sorted(r.rank for r in out.where("ticker = 'HOT'").collect())
    # The first page of the advanced search has plenty, so its first ten are taken as they come.
    assert chosen == [i * 12 for i in range(10)]


def test_top_articles_are_limited_on_the_map_side(hot):
    out = candidates.top_articles(hot.withColumnRenamed("query_date", "date"), ["id"])
    assert ranks_before_shuffle(out) == 1
    assert out.where("ticker = 'HOT'").count() == 10


@pytest.fixture
def small_partitions(spark):
    """Make the adaptive rules treat test data like large data."""
    conf = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "10KB",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20KB",
        "spark.sql.adaptive.coalescePartitions.parallelismFirst": "false",
        "spark.sql.shuffle.partitions": "16",
    }
    before = {k: spark.conf.get(k, None) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_score_join_is_split(hot, small_partitions):
    articles = hot.withColumnRenamed("query_date", "date_key").withColumn("x", F.md5(F.col("id").cast("string"))).drop("text")
    scores = articles.select("ticker", "date_key", "url", F.lit(1.0).alias("score"))
    out = sentiment.attach_scores(articles, scores)
    assert "skew=true" in plan_of(out, run=True)
    assert out.where("score = 1").count() == ROWS


def test_company_join_is_split(hot, small_partitions):
    names = lookup_table(hot, ["ticker"], F.min("title").alias("company_name"))
    out = hot.select("id", "ticker", F.md5("url").alias("x")).join(names, "ticker")
    assert "skew=true" in plan_of(out, run=True)
    listed = clean.only_tickers(hot.select("id", "ticker", F.md5("url").alias("x")), names)
    assert "skew=true" in plan_of(listed, run=True)
    assert listed.count() == ROWS


def test_hot_word_is_split(spark, hot, small_partitions):
    lexicon = spark.createDataFrame([("good", 1.0)], "word string, valence double")
    # One word in three is the same.
    articles = hot.select("id", F.concat_ws(" ", F.lit("good"), F.translate(F.md5("url"), "0123456789", " "), "text").alias("sentiment_text"))
    out = sentiment.lexicon_scores(articles, lexicon, ["id"])
    assert "skew=true" in plan_of(out, run=True)
    assert out.where("vader_compound > 0").count() == ROWS


def test_counts_combine_before_the_shuffle(hot):
    for out in (
        summaries.articles_per_ticker(hot),
        summaries.search_source_mix(hot.withColumn("search_source", F.lit("ticker"))),
        windows.date_gaps(hot, date="query_date"),
        gold.daily_sentiment(hot.selectExpr("ticker", "query_date date_key", "1D finbert_score", "'positive' finbert_label", "1D vader_compound")),
    ):
        plan = plan_of(out)
        scan_side = plan[plan.rindex("Exchange") :]
        assert "partial_" in scan_side or "HashAggregate(keys=[ticker" in scan_side, plan


def test_silver_news_moves_no_text_after_deduplication(spark, hot):
    lexicon = spark.sql("SELECT * FROM VALUES ('good', 1.0D) AS t(word, valence)")
    unique = news_plan.deduplicated(hot, ["id"])
    plan = plan_of(news_plan.scored(unique, lexicon))
    # One shuffle for each reading of the articles; scores and articles meet where they lie.
    assert len(re.findall(r"Exchange hashpartitioning\((?:ticker|upper)", plan)) == 2, plan
