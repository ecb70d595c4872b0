"""Article scores: word valences from a lexicon table, and a user-supplied model."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import scores
from .joins import lookup_table

TOKEN = "[a-z]+"
LEXICON_COLUMNS = ("vader_compound", "vader_pos", "vader_neu", "vader_neg")


def lexicon_scores(articles: DataFrame, lexicon: DataFrame, keys: Sequence[str], column: str = "sentiment_text") -> DataFrame:
    """Scores per ``keys``, which must identify an article; ``lexicon`` holds (word, valence).

    The lexicon join carries no hint. If Spark broadcasts the table, tokens are folded into one row per article
    before anything is shuffled; otherwise both sides are shuffled by word, a row per token, and the partitions of
    frequent words are split. ``emphasis`` looks up each word of an article once. NULL or empty text gives NULL scores.
    """
    # An empty array still has to yield a row, hence the outer explode.
    tokens = F.regexp_extract_all(F.lower(F.col(column)), F.lit(TOKEN), F.lit(0))
    words = articles.select(*keys, (F.coalesce(F.col(column), F.lit("")) == "").alias("_empty"), F.explode_outer(tokens).alias("word"))
    # A word listed twice would count twice; the largest entry wins.
    valences = lookup_table(lexicon, ["word"], F.max("valence").cast("double").alias("valence"))
    valence = F.coalesce("valence", F.lit(0.0))
    sums = (
        words.join(valences, "word", "left")
        .groupBy(*keys)
        .agg(
            F.bool_or("_empty").alias("_empty"),
            F.sum(valence).alias("_total"),
            # One is added per scored word so that words outweigh neutral ones by their strength.
            F.sum(F.when(valence > 0, valence + 1).otherwise(0.0)).alias("_up"),
            F.sum(F.when(valence < 0, 1 - valence).otherwise(0.0)).alias("_down"),
            F.count(F.when(F.col("word").isNotNull() & (valence == 0), 1)).alias("_flat"),
        )
    )
    mass = F.col("_up") + F.col("_down") + F.col("_flat")

    def share(part: str):
        return F.when(~F.col("_empty"), F.coalesce(F.try_divide(F.col(part), mass), F.lit(0.0)))

    return sums.select(
        *keys,
        F.when(~F.col("_empty"), scores.compound(F.col("_total"))).alias("vader_compound"),
        share("_up").alias("vader_pos"),
        share("_flat").alias("vader_neu"),
        share("_down").alias("vader_neg"),
    )


def model_scores(
    articles: DataFrame,
    load_model: Callable[[], Callable[[pd.Series], Sequence[Sequence[float]]]],
    labels: Sequence[str],
    column: str = "sentiment_text",
    max_chars: int | None = None,
) -> DataFrame:
    """Add ``finbert_score`` and ``finbert_label`` from a model that gives one logit per label.

    ``load_model`` runs once per task and returns a function from a batch of texts to their logits.
    ``labels`` is the model's own label order. The model receives whole texts; pass ``max_chars=512`` for
    models that must not see more.
    """

    def predict(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        model = load_model()
        for texts in batches:
            filled = texts.notna() & (texts != "")
            logits = pd.Series([None] * len(texts), index=texts.index, dtype=object)
            if filled.any():
                # One array of a row per text; its rows go on without a Python number in between.
                rows = np.asarray(model(texts[filled]), dtype="float64").reshape(int(filled.sum()), -1)
                logits[filled] = pd.Series(list(rows), index=texts.index[filled])
            yield logits

    scorer = F.pandas_udf(predict, "array<double>")
    text = F.col(column) if max_chars is None else F.substring(column, 1, max_chars)
    return probability_scores(articles.withColumn("_logits", scorer(text)), "_logits", labels).drop("_logits")


def probability_scores(df: DataFrame, logits: str, labels: Sequence[str]) -> DataFrame:
    return (
        df.withColumn("_probabilities", scores.softmax(F.col(logits)))
        .withColumns(
            {
                "finbert_score": scores.score_of(F.col("_probabilities"), labels),
                "finbert_label": scores.label_of(F.col("_probabilities"), labels),
            }
        )
        .drop("_probabilities")
    )


def attach_scores(articles: DataFrame, scored: DataFrame, keys: Sequence[str] = ("ticker", "date_key", "url")) -> DataFrame:
    """Left join of separately stored scores; a repeated key takes one score row, so nothing multiplies."""
    columns = [c for c in scored.columns if c not in keys]
    single = lookup_table(scored, keys, F.min(F.struct(*columns)).alias("_scores"))
    return articles.join(single.select(*keys, "_scores.*"), list(keys), "left")


def label_distribution(df: DataFrame, label: str = "finbert_label") -> DataFrame:
    """Count and percentage per label, among rows that have one.

    Each row is scored once: the total is a sum over the few counts, and the rows without a label drop out
    by their count, which, unlike a filter on the label, does not reach below the model.
    """
    counts = df.groupBy(label).agg(F.count(label).alias("articles")).where("articles > 0")
    total = F.sum("articles").over(Window.partitionBy(F.lit(0)))
    return counts.withColumn("percentage", F.col("articles") * 100.0 / total)


def text_lengths(df: DataFrame, column: str = "sentiment_text") -> DataFrame:
    """Distribution of text lengths; equal lengths are counted before the quantiles are taken."""
    lengths = df.where(F.col(column).isNotNull()).groupBy(F.length(column).alias("n")).agg(F.count("*").alias("f"))
    # Moments come from sums over the counted lengths, in exact integers as far as possible.
    total, weight = F.sum(F.col("n") * F.col("f")), F.sum("f")
    squares = F.sum(F.col("n").cast("decimal(20,0)") * F.col("n") * F.col("f"))
    mean = total / weight
    stats = lengths.agg(
        weight.alias("count"),
        mean.alias("mean"),
        total.alias("_total"),
        squares.alias("_squares"),
        F.min("n").alias("min"),
        *[F.percentile("n", F.lit(q), F.col("f")).alias(name) for q, name in ((0.25, "q25"), (0.5, "median"), (0.75, "q75"))],
        F.max("n").alias("max"),
    )
    count = F.col("count").cast("double")
    spread = F.col("_squares").cast("double") - F.col("_total").cast("double") * F.col("_total") / count
    return stats.select(
        "count",
        "mean",
        F.when(F.col("count") > 1, F.sqrt(F.greatest(spread, F.lit(0.0)) / (count - 1))).alias("std"),
        "min",
        "q25",
        "median",
        "q75",
        "max",
    )
