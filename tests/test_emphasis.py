"""Emphatic scores against a plain version of the rules."""

import math
import re

import pytest

from market_engine.operators import emphasis
from market_engine.plans import jobs

from frames import plan_of

LEXICON = {"good": 1.9, "bad": -2.5, "fine": 0.8, "no": -1.2, "very": 0.4, "don't": -0.1}
SHIFTERS = [
    ("very", "booster", 0.293),
    ("really", "booster", 0.293),
    ("slightly", "booster", -0.293),
    ("not", "negation", None),
    ("no", "negation", None),
    ("isn't", "negation", None),
    ("but", "contrast", None),
]
BOOST = {w: a for w, kind, a in SHIFTERS if kind == "booster"}
NEGATES = {w for w, kind, _ in SHIFTERS if kind == "negation"}


def plain(text):
    if not text:
        return (None,) * 4
    words = re.findall(r"[A-Za-z]+(?:'[A-Za-z]+)?", text)
    capitals = [w == w.upper() for w in words]
    mixed = 0 < sum(capitals) < len(words)
    caps = [0.733 if mixed and c else 0.0 for c in capitals]
    lower = [w.lower() for w in words]
    valence = [0.0 if w in BOOST else LEXICON.get(w, 0.0) for w in lower]
    values = []
    for i, v in enumerate(valence):
        if v:
            v += math.copysign(caps[i], v)
            for k, near in ((1, 1.0), (2, 0.95), (3, 0.9)):
                if i < k or lower[i - k] in LEXICON:
                    continue
                before = lower[i - k]
                if before in BOOST:
                    v += math.copysign(1, v) * (BOOST[before] + caps[i - k]) * near
                if before in NEGATES:
                    v *= -0.74
        values.append(v)
    if "but" in lower:
        at = lower.index("but")
        values = [v * (0.5 if i < at else 1.5 if i > at else 1) for i, v in enumerate(values)]
    asked = text.count("?")
    stress = min(text.count("!"), 4) * 0.292 + (0.96 if asked > 3 else asked * 0.18 if asked > 1 else 0)
    total = sum(values)
    total += math.copysign(stress, total) if total else 0
    up, down = sum(v + 1 for v in values if v > 0), sum(1 - v for v in values if v < 0)
    up, down = up + (stress if up > down else 0), down + (stress if down > up else 0)
    mass = up + down + values.count(0.0)
    return (total / math.sqrt(total * total + 15), *[x / mass if mass else 0.0 for x in (up, values.count(0.0), down)])


@pytest.fixture
def word_lists(spark):
    lexicon = spark.createDataFrame(list(LEXICON.items()) + [("good", 0.1)], "word string, valence double")
    return lexicon, spark.createDataFrame(SHIFTERS, "word string, kind string, amount double")


def scores(spark, rows, word_lists):
    articles = spark.createDataFrame(rows, "id int, sentiment_text string")
    out = emphasis.emphatic_scores(articles, *word_lists, ["id"])
    return {r.id: tuple(r)[1:] for r in out.collect()}, out


def test_random_texts(spark, word_lists):
    import random

    rng = random.Random(5)
    words = ["good", "bad", "fine", "no", "very", "really", "slightly", "not", "isn't", "but", "don't", "day", "x", "'", "ist"]
    rows = []
    for i in range(400):
        n = rng.choice([0, 1, 2, 5, 20, 60])
        text = [rng.choice([w, w, w.upper(), w.title()]) for w in rng.choices(words, k=n)]
        rows.append((i, rng.choice([" ", "  ", ", "]).join(text) + rng.choice(["", "!", "!!!!!!", "?", "??", "?????"])))
    rows += [(1000, None), (1001, ""), (1002, "123 !?"), (1003, "GOOD"), (1004, "GOOD NOT"), (1005, "good " * 5000)]
    found, out = scores(spark, rows, word_lists)
    assert len(found) == len(rows)
    for i, text in rows:
        assert found[i] == pytest.approx(plain(text), nan_ok=True), text
    assert "Python" not in plan_of(out)


@pytest.mark.parametrize(
    "weak, strong",
    [("good", "really good"), ("good", "GOOD day"), ("slightly good", "good"), ("not good", "good"), ("good!", "good!!"), ("good but bad", "bad but good")],
)
def test_order_of_texts(spark, word_lists, weak, strong):
    found, _ = scores(spark, [(1, weak), (2, strong)], word_lists)
    assert found[1][0] < found[2][0]


def test_empty_tables(spark, word_lists):
    lexicon, shifters = word_lists
    found, _ = scores(spark, [(1, "good")], (lexicon.limit(0), shifters.limit(0)))
    assert found == {1: (0.0, 0.0, 1.0, 0.0)}
    articles = spark.createDataFrame([], "id int, sentiment_text string")
    assert emphasis.emphatic_scores(articles, lexicon, shifters, ["id"]).count() == 0


def test_load_with_shifters(spark, word_lists):
    lexicon, shifters = word_lists
    rows = [("a", "2024-01-01", "not good", "u1", 1), ("a", "2024-01-01", "good", "u2", 1)]
    news = spark.createDataFrame(rows, "ticker string, query_date string, title string, url string, n int")
    jobs.load_news(news, "emphatic_news", lexicon, ["n"], shifters=shifters)
    found = {r.url: r.vader_compound for r in spark.table("emphatic_news").collect()}
    spark.sql("DROP TABLE emphatic_news")
    assert found["u1"] < 0 < found["u2"]
