"""The selection against a direct simulation of the rule, one day at a time."""

import random
from collections import defaultdict
from datetime import date

import pytest

from market_engine.operators import candidates, clean

DAY = date(2024, 1, 2)
SCHEMA = (
    "ticker string, date date, endpoint string, term string, page int, rank long, title string, text string, "
    "url string, failed boolean"
)
NAMES = "ticker string, company_name string, abbrev1 string, abbrev2 string"


def distinct(articles):
    urls, titles, kept = set(), set(), []
    for a in articles:
        title = (a["title"] or "").strip()
        if a["url"] and a["url"] not in urls:
            urls.add(a["url"])
            kept.append(a)
        elif title and title not in titles:
            titles.add(title)
            kept.append(a)
    return kept


def simulate(rows, ticker, names):
    """The day's choice as (ranks, endpoint, terms)."""
    answers, failed = defaultdict(list), set()
    for r in sorted(rows, key=lambda r: r["rank"]):
        key = (r["endpoint"], r["term"], r["page"])
        failed.add(key) if r["failed"] else answers[key].append(r)

    def ask(endpoint, term, page=1):
        return None if (endpoint, term, page) in failed else answers[(endpoint, term, page)]

    def has(article, term, both=False):
        found = [term.upper() in (article[f] or "").upper() for f in ("title", "text")]
        return all(found) if both else any(found)

    held, endpoint, used = [], None, []
    answer = ask("advanced", "ticker")
    if answer is None:
        held = [a for a in ask("regular", "ticker") or [] if has(a, ticker, both=True)]
        endpoint = "regular" if held else None
    else:
        held = list(answer)
        endpoint = "advanced" if held else None
    if held:
        used.append(f"ticker:{ticker}")
    searches = [("ticker", ticker, "ticker")]
    searches += [(t, names[t], label) for t, label in (("company_name", "company"), ("abbrev1", "abbrev1"), ("abbrev2", "abbrev2"))]
    for term, words, label in searches:
        if len(held) >= 10:
            break
        if len(held) >= 7 or not words or (term == "ticker" and endpoint == "regular"):
            continue
        urls = {a["url"] for a in held if a["url"]}
        matches = [a for a in ask("regular", term) or [] if has(a, words) or has(a, ticker)]
        new = [a for a in matches if a["url"] not in urls]
        held += new
        if new:
            endpoint = "regular"
            if f"{label}:{words}" not in used:
                used.append(f"{label}:{words}")
    if len(held) < 10:
        held = distinct(held)
        for page in range(2, 11):
            if len(held) >= 10:
                break
            answer = ask(endpoint or "advanced", "ticker", page)
            if not answer:
                break
            if endpoint == "regular":
                answer = [a for a in answer if has(a, ticker)]
            held = distinct(held + answer)
    return [a["rank"] for a in held[:10]], endpoint or "none", ", ".join(used) or "ticker"


def random_day(rnd, ticker, ranks, crowded):
    rows = []
    size = rnd.choice([3, 8, 14])
    urls = [f"u{i}" for i in range(rnd.choice([2, 6, 40]))]
    titles = ["", " a", "a", "b", f"{ticker} news", "Acme wins", "co up"][: rnd.choice([2, 4, 7])]
    searches = [("advanced", "ticker", 1)] + [("regular", t, 1) for t in ("ticker", "company_name", "abbrev1", "abbrev2")]
    searches += [(e, "ticker", p) for e in ("advanced", "regular") for p in range(2, rnd.choice([2, 4, 6, 12]))]
    for endpoint, term, page in searches:
        if rnd.random() < 0.2:
            continue
        count = rnd.randint(0, size) * (20 if crowded else 1)
        failed = rnd.random() < 0.15
        for _ in range(max(count, 1) if failed else count):
            url = rnd.choice([None, "", *urls])
            text = rnd.choice([None, "", f"about {ticker}", "acme and co", "nothing"])
            rows.append((ticker, DAY, endpoint, term, page, next(ranks), rnd.choice([None, *titles]), text, url, failed))
    return rows


@pytest.mark.parametrize("crowded", [False, True])
def test_matches_simulation(spark, crowded):
    rnd = random.Random(17 + crowded)
    ranks = iter(range(10**9))
    names, rows = [], []
    for i in range(25 if crowded else 120):
        ticker = f"T{i:03d}X"
        rows += random_day(rnd, ticker, ranks, crowded)
        names.append((ticker, "Acme", rnd.choice([None, "co"]), rnd.choice([None, "", "news"])))
    columns = [c.split()[0] for c in SCHEMA.split(", ")]
    expected = {}
    for ticker, *others in names:
        day = [dict(zip(columns, r)) for r in rows if r[0] == ticker]
        expected[ticker] = simulate(day, ticker, dict(zip(("company_name", "abbrev1", "abbrev2"), others)))
    out = candidates.select_articles(
        spark.createDataFrame(rows, SCHEMA), spark.createDataFrame(names, NAMES)
    ).collect()
    got = defaultdict(list)
    for r in out:
        got[r.ticker].append((r.position, r.rank, r.endpoint_used, r.search_terms_used))
    for ticker, (ranks_wanted, endpoint, terms) in expected.items():
        day = sorted(got.get(ticker, []))
        assert [d[1] for d in day] == ranks_wanted, ticker
        assert all(d[2:] == (endpoint, terms) for d in day), ticker
    assert len({e[1] for e in expected.values()}) >= 2


def test_full_first_answer_keeps_repeats(spark):
    rows = [("AB", DAY, "advanced", "ticker", 1, i, "t", "x", "same", False) for i in range(12)]
    out = candidates.select_articles(
        spark.createDataFrame(rows, SCHEMA), spark.createDataFrame([("AB", "Acme", None, None)], NAMES)
    )
    assert sorted(r.rank for r in out.collect()) == list(range(10))


def test_title_fallback_rule(spark):
    rows = [("u1", "A1"), ("u2", "A2"), ("u1", "A1 Duplicate"), (None, "A3"), (None, "A3"), ("v", "T"), ("v", "T"), ("v", "T")]
    df = spark.createDataFrame([(i, "g", u, t) for i, (u, t) in enumerate(rows)], "seq long, g string, url string, title string")
    out = clean.dedup_articles_by_url_then_title(df, ["g"], "seq", ["seq"])
    assert sorted(r.seq for r in out.collect()) == [0, 1, 2, 3, 5, 6]


@pytest.mark.parametrize("seed", range(3))
def test_title_fallback_matches_simulation(spark, seed):
    rnd = random.Random(seed)
    rows = [
        (i, rnd.choice("gh"), rnd.choice([None, "", "a", "b", "c"]), rnd.choice([None, "", " ", "x", " x", "y", "z"]))
        for i in range(200)
    ]
    df = spark.createDataFrame(rows, "seq long, g string, url string, title string").repartition(5)
    out = clean.dedup_articles_by_url_then_title(df, ["g"], "seq", ["seq"])
    want = []
    for g in "gh":
        want += [a["seq"] for a in distinct([{"seq": r[0], "url": r[2], "title": r[3]} for r in rows if r[1] == g])]
    assert sorted(r.seq for r in out.collect()) == sorted(want)
