import math
from datetime import date

import pytest
from pyspark.sql import functions as F

from market_engine.functions import scores, text
from market_engine.operators import clean, gold, sentiment
from market_engine.plans import news as plan
from market_engine.schemas import SILVER_NEWS

DAY = date(2024, 1, 2)
LABELS = ("positive", "negative", "neutral")


@pytest.fixture(scope="module")
def lexicon(spark):
    return spark.createDataFrame([("good", 2.0), ("bad", -1.5), ("good", 1.0)], "word string, valence double")


def scored(spark, lexicon, *texts):
    df = spark.createDataFrame(list(enumerate(texts)), "id int, sentiment_text string")
    rows = sentiment.lexicon_scores(df, lexicon, ["id"]).orderBy("id").collect()
    return [tuple(r)[1:] for r in rows]


def test_lexicon_scores(spark, lexicon):
    plain, none, empty, symbols = scored(spark, lexicon, "Good news, BAD news", None, "", "123 !")
    total = 2.0 - 1.5
    mass = 3.0 + 2.5 + 2
    for got, want in zip(plain, (total / math.sqrt(total**2 + 15), 3.0 / mass, 2 / mass, 2.5 / mass)):
        assert math.isclose(got, want)
    assert none == empty == (None,) * 4
    assert symbols == (0.0,) * 4


def test_lexicon_scores_without_broadcast(spark, lexicon):
    texts = ["good " * 500 + "x" * i for i in range(20)]
    with_broadcast = scored(spark, lexicon, *texts)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", "-1")
    try:
        assert scored(spark, lexicon, *texts) == with_broadcast
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.unset("spark.sql.adaptive.autoBroadcastJoinThreshold")


def length_model():
    # Made inside a function so that workers receive it whole.
    def load():
        return lambda texts: [[float(len(t)), 0.0, 1.0] for t in texts]

    return load


def test_model_scores(spark):
    df = spark.createDataFrame([(1, "abc"), (2, None), (3, ""), (4, "x" * 600)], "id int, sentiment_text string")
    rows = {r.id: r for r in sentiment.model_scores(df, length_model(), LABELS).collect()}
    total = math.exp(3) + 1 + math.e
    assert math.isclose(rows[1].finbert_score, (math.exp(3) - 1) / total)
    assert rows[1].finbert_label == "positive"
    assert rows[2].finbert_score is None and rows[3].finbert_label is None
    # Large logits stay finite.
    assert rows[4].finbert_score == 1.0


def test_model_sees_the_whole_text_unless_limited(spark):
    df = spark.createDataFrame([("x" * 600,)], "sentiment_text string")

    def load():
        return lambda texts: [[1.0 if len(t) > 512 else 0.0, 0.5, 0.0] for t in texts]

    assert sentiment.model_scores(df, load, LABELS).first().finbert_label == "positive"
    assert sentiment.model_scores(df, load, LABELS, max_chars=512).first().finbert_label == "negative"


def test_label_order_and_ties(spark):
    df = spark.createDataFrame([([1.0, 1.0, 0.0],), ([0.0, 1.0, 2.0],)], "logits array<double>")
    rows = sentiment.probability_scores(df, "logits", ("neutral", "positive", "negative")).collect()
    assert [r.finbert_label for r in rows] == ["neutral", "negative"]
    assert rows[1].finbert_score < 0


def test_attached_scores_do_not_multiply(spark):
    df = spark.createDataFrame([("A", DAY, "u", 1), ("A", DAY, "u", 2), ("A", DAY, None, 3)], "ticker string, date_key date, url string, n int")
    scores_df = df.select("ticker", "date_key", "url", F.col("n").alias("score"))
    out = sentiment.attach_scores(df, scores_df)
    assert sorted((r.n, r.score) for r in out.collect() if r.score) == [(1, 1), (2, 1)]
    assert out.count() == 3


def test_text_functions(spark):
    df = spark.createDataFrame([("Hi, AAPL!", " ", None)], "title string, blank string, missing string")
    row = df.select(
        text.clean_text(F.col("title")).alias("a"),
        text.clean_text(F.col("missing")).alias("b"),
        text.sentiment_text(F.col("title"), F.col("blank")).alias("c"),
        text.term_in_either(F.col("title"), F.col("missing"), F.lit("aapl")).alias("d"),
        text.term_in_both(F.col("title"), F.col("missing"), F.lit("aapl")).alias("e"),
        text.search_terms(F.array().cast("array<string>")).alias("f"),
        text.search_terms(F.array(F.lit("x"), F.lit("y"))).alias("g"),
    ).first()
    assert tuple(row) == ("hi aapl", "", "Hi, AAPL!", True, False, "ticker", "x, y")


def test_compound_is_bounded(spark):
    row = spark.range(1).select(scores.compound(F.lit(1e6)).alias("a"), scores.compound(F.lit(0.0)).alias("b")).first()
    assert 0.99 < row.a <= 1 and row.b == 0


def test_clean_dedup(spark):
    rows = [("A", "u", "x", 2), ("A", "u", "y", 1), ("A", None, "x", 3), ("A", "", "x", 4), ("B", "u", "x", 5)]
    df = spark.createDataFrame(rows, "ticker string, url string, title string, n int")
    assert sorted(r.n for r in clean.dedup_articles(df, ["ticker"], ["n"]).collect()) == [1, 3, 5]


def test_silver_news(spark, lexicon):
    rows = [
        ("aapl", "2024-01-02", "Good day", None, None, "u1", 1),
        ("aapl", "2024-01-02", "Good day again", "bad", None, "u1", 2),
        ("aapl", "2024-01-02", "No url", "", None, None, 3),
        ("aapl", "2024-01-02", "  ", "x", None, "u3", 4),
        ("aapl", None, "No date", "x", None, "u4", 5),
    ]
    df = spark.createDataFrame(rows, "ticker string, query_date string, title string, text string, url string, news_url string, n int")
    out = plan.silver_news(df, lexicon, ["n"], length_model(), LABELS)
    assert [(f.name, f.dataType) for f in out.schema] == [(f.name, f.dataType) for f in SILVER_NEWS]
    got = {r.title: r for r in out.collect()}
    assert set(got) == {"Good day", "No url"}
    assert got["Good day"].url == "u1" and got["Good day"].ticker == "AAPL" and got["Good day"].date_key == DAY
    assert got["Good day"].vader_compound > 0 and got["No url"].vader_neu == 1.0
    assert got["No url"].finbert_label == "positive"


def test_daily_sentiment_and_join(spark, make_bars):
    rows = [("T", date(2020, 1, 1), 1.0, "positive", 0.5), ("T", date(2020, 1, 1), None, None, 0.1)]
    news = spark.createDataFrame(rows, "ticker string, date_key date, finbert_score double, finbert_label string, vader_compound double")
    daily = gold.daily_sentiment(news)
    row = daily.first()
    assert (row.articles, row.avg_finbert_score, row.positive_count, row.negative_count) == (2, 1.0, 1, 0)
    joined = gold.sentiment_prices(make_bars([1.0, 2.0]), daily).orderBy("date").collect()
    assert [(r.articles, r.positive_count) for r in joined] == [(2, 1), (0, None)]
    labelled = gold.training_rows(gold.sentiment_prices(make_bars([1.0, 2.0, 1.0]), daily)).orderBy("date").collect()
    assert [(r.next_change_pct, r.next_up) for r in labelled] == [(100.0, 1), (-50.0, 0), (None, None)]


def test_correlation_with_lag(spark):
    rows = [("T", date(2024, 1, i), float(i % 3), float((i - 1) % 3)) for i in range(1, 15)]
    df = spark.createDataFrame(rows, "ticker string, date_key date, avg_vader_compound double, price_change_pct double")
    assert math.isclose(gold.sentiment_correlation(df, lag_days=1).first().correlation, 1.0)
    flat = df.withColumn("price_change_pct", F.lit(1.0))
    assert gold.sentiment_correlation(flat).first().correlation is None


def test_model_runs_on_pandas_batches(spark):
    def load():
        def model(batch):
            assert type(batch).__name__ == "Series"
            return [[0.0, 1.0, 0.0]] * len(batch)

        return model

    df = spark.range(10).select(F.col("id").cast("string").alias("sentiment_text"))
    assert {r.finbert_label for r in sentiment.model_scores(df, load, LABELS).collect()} == {"negative"}


def test_strip_takes_all_white_space(spark):
    from market_engine.functions import text

    row = spark.createDataFrame([("\u00a0 a\u00a0b\t\u2003\n",)], "t string").select(text.strip(F.col("t")).alias("t")).first()
    assert row.t == "a\u00a0b"


def test_articles_move_to_the_next_trading_day(spark):
    day = lambda d: date(2024, 1, d)
    prices = spark.createDataFrame([("A", day(d)) for d in (5, 8, 9)] + [("B", day(6))], "ticker string, date date")
    rows = [("A", day(5), 1), ("A", day(6), 2), ("A", day(7), 3), ("A", day(7), 4), ("A", day(10), 5), ("B", day(1), 6), ("C", day(1), 7), ("A", None, 8)]
    news = spark.createDataFrame(rows, "ticker string, date_key date, n int")
    out = {r.n: (r.date_key, r.article_day) for r in gold.on_trading_days(news, prices).collect()}
    assert {n: d.day if d else None for n, (d, _) in out.items()} == {1: 5, 2: 8, 3: 8, 4: 8, 5: 10, 6: 6, 7: 1, 8: None}
    assert out[3][1] == day(7) and len(out) == len(rows)
