"""Lexicon scores that take in what stands around a word: negation, boosters, capitals, contrast, exclamation.

The rules are those of Hutto and Gilbert (2014). Which words have a valence and which shift that of others are
two tables given by the caller. The rules need the order of the words, the tables only the words: so each
article's different words are looked up, a row for each, and those found come back as one small map, in which the
rules then find what they need in the order of the text. Words that no table holds are never shuffled twice.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import scores
from .joins import lookup_table

TOKEN = r"[A-Za-z]+(?:'[A-Za-z]+)?"
#: Kinds of shifters. Only boosters have an amount: how much they add to a positive word after them.
NEGATION, BOOSTER, CONTRAST = "negation", "booster", "contrast"

# Fixed values of the published rules.
CAPITALS = 0.733
NEGATED = -0.74
#: A booster one, two or three words before counts so much.
NEARNESS = (1.0, 0.95, 0.9)
BEFORE_CONTRAST, AFTER_CONTRAST = 0.5, 1.5
EXCLAMATION, MOST_EXCLAMATIONS = 0.292, 4
QUESTION, FEW_QUESTIONS, MANY_QUESTIONS = 0.18, 3, 0.96

_MEANING = "struct<valence:double,known:boolean,boost:double,negates:boolean,contrasts:boolean>"


def word_table(lexicon: DataFrame, shifters: DataFrame) -> DataFrame:
    """word, meaning: one row per word of either table.

    Of several valences the largest counts, of several boosters the largest amount. A booster has no valence.
    """
    valences = lexicon.select(F.lower("word").alias("word"), F.col("valence").cast("double").alias("valence"))
    kinds = shifters.select(F.lower("word").alias("word"), "kind", F.col("amount").cast("double").alias("amount"))
    rows = valences.unionByName(kinds, allowMissingColumns=True)
    boost = F.max(F.when(F.col("kind") == BOOSTER, F.coalesce("amount", F.lit(0.0))))
    meaning = F.struct(
        F.when(boost.isNull(), F.coalesce(F.max("valence"), F.lit(0.0))).otherwise(0.0).alias("valence"),
        F.max("valence").isNotNull().alias("known"),
        F.coalesce(boost, F.lit(0.0)).alias("boost"),
        F.coalesce(F.bool_or(F.col("kind") == NEGATION), F.lit(False)).alias("negates"),
        F.coalesce(F.bool_or(F.col("kind") == CONTRAST), F.lit(False)).alias("contrasts"),
    )
    return lookup_table(rows, ["word"], meaning.alias("meaning"))


def emphatic_scores(
    articles: DataFrame, lexicon: DataFrame, shifters: DataFrame, keys: Sequence[str], column: str = "sentiment_text"
) -> DataFrame:
    """Scores per ``keys``, which must identify an article and not be NULL.

    ``lexicon`` holds (word, valence), ``shifters`` (word, kind, amount). A word's valence is raised in capitals,
    if not all of the text is in capitals; shifted by boosters and turned by negations among the three words before
    it, unless they have a valence themselves; and weighed by whether it stands before or after the first word of
    contrast. NULL or empty text gives NULL scores.
    """
    tokens = F.regexp_extract_all(F.col(column), F.lit(TOKEN), F.lit(0))
    different = F.array_distinct(F.transform(tokens, F.lower))
    words = articles.select(*keys, F.explode(different).alias("word"))
    found = words.join(word_table(lexicon, shifters), "word")
    entries = F.collect_list(F.struct("word", "meaning"))
    maps = found.groupBy(*keys).agg(F.map_from_entries(entries).alias("_meanings"))
    texts = articles.select(*keys, F.col(column).alias("_text"), tokens.alias("_words"))
    scored = texts.join(maps, list(keys), "left").withColumn("_tokens", _tokens()).withColumn("_values", _values())
    return _shares(scored.withColumn("_scaled", _contrasted()), keys)


def _once(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with the value worked out once, also where it stands inside the function of an array."""
    return F.get(F.transform(F.array(value), use), 0)


def _tokens() -> Column:
    """Each word's meaning and whether it is in capitals."""
    none = F.struct(
        F.lit(0.0).alias("valence"),
        F.lit(False).alias("known"),
        F.lit(0.0).alias("boost"),
        F.lit(False).alias("negates"),
        F.lit(False).alias("contrasts"),
    ).cast(_MEANING)

    def token(word: Column, mixed: Column) -> Column:
        return F.struct(
            F.coalesce(F.element_at("_meanings", F.lower(word)), none).alias("m"),
            F.when(mixed & (word == F.upper(word)), CAPITALS).otherwise(0.0).alias("capitals"),
        )

    in_capitals = F.size(F.filter("_words", lambda w: w == F.upper(w)))
    mixed = _once(in_capitals, lambda n: (n > 0) & (n < F.size("_words")))
    return _once(mixed, lambda m: F.transform("_words", lambda w: token(w, m)))


def _values() -> Column:
    """The shifted valence of each word, in order."""

    def before(tokens: Column, value: Column, place: Column, back: Column) -> Column:
        token = F.get(tokens, place - back)
        nearness = F.element_at(F.array(*[F.lit(n) for n in NEARNESS]), back)
        boosted = token["m"]["boost"] != 0
        push = F.when(boosted, (token["m"]["boost"] + token["capitals"]) * nearness).otherwise(0.0)
        turn = F.when(token["m"]["negates"], NEGATED).otherwise(1.0)
        return F.when(token["m"]["known"], value).otherwise((value + F.signum(value) * push) * turn)

    def shifted(tokens: Column, token: Column, place: Column) -> Column:
        valence = token["m"]["valence"]
        start = valence + F.signum(valence) * token["capitals"]
        backs = F.filter(F.array(*[F.lit(k + 1) for k in range(len(NEARNESS))]), lambda k: k <= place)
        return F.when(valence == 0, 0.0).otherwise(F.aggregate(backs, start, lambda v, back: before(tokens, v, place, back)))

    return _once(F.col("_tokens"), lambda tokens: F.transform(tokens, lambda token, place: shifted(tokens, token, place)))


def _contrasted() -> Column:
    first = F.array_position(F.transform("_tokens", lambda t: t["m"]["contrasts"]), True)

    def weight(i: Column, place: Column) -> Column:
        return F.when(i < place, BEFORE_CONTRAST).when(i > place, AFTER_CONTRAST).otherwise(1.0)

    # Without a word of contrast the place is NULL, and no comparison with it holds.
    place = F.nullif(first, F.lit(0)) - 1
    return _once(place, lambda p: F.transform("_values", lambda v, i: v * weight(i, p)))


def _shares(scored: DataFrame, keys: Sequence[str]) -> DataFrame:
    def total(entry) -> Column:
        return F.aggregate("_scaled", F.lit(0.0), lambda acc, v: acc + entry(v))

    questions = F.regexp_count("_text", F.lit(r"\?"))
    asked = F.when(questions > FEW_QUESTIONS, MANY_QUESTIONS).when(questions > 1, questions * QUESTION).otherwise(0.0)
    stressed = F.least(F.regexp_count("_text", F.lit("!")), F.lit(MOST_EXCLAMATIONS)) * EXCLAMATION + asked
    sums = scored.select(
        *keys,
        (F.coalesce("_text", F.lit("")) == "").alias("_empty"),
        stressed.alias("_stress"),
        total(lambda v: v).alias("_total"),
        # One is added per scored word so that words outweigh neutral ones by their strength.
        total(lambda v: F.when(v > 0, v + 1).otherwise(0.0)).alias("_up"),
        total(lambda v: F.when(v < 0, 1 - v).otherwise(0.0)).alias("_down"),
        total(lambda v: F.when(v == 0, 1.0).otherwise(0.0)).alias("_flat"),
    )
    sums = sums.withColumns(
        {
            "_total": F.col("_total") + F.signum("_total") * F.col("_stress"),
            "_up": F.col("_up") + F.when(F.col("_up") > F.col("_down"), F.col("_stress")).otherwise(0.0),
            "_down": F.col("_down") + F.when(F.col("_down") > F.col("_up"), F.col("_stress")).otherwise(0.0),
        }
    )
    mass = F.col("_up") + F.col("_down") + F.col("_flat")

    def share(part: str) -> Column:
        return F.when(~F.col("_empty"), F.coalesce(F.try_divide(F.col(part), mass), F.lit(0.0)))

    return sums.select(
        *keys,
        F.when(~F.col("_empty"), scores.compound(F.col("_total"))).alias("vader_compound"),
        share("_up").alias("vader_pos"),
        share("_flat").alias("vader_neu"),
        share("_down").alias("vader_neg"),
    )
