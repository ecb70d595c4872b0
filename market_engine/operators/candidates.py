"""Choosing the articles of a ticker's day from the answers to several searches.

A candidate row is one article of one answer: (ticker, date, endpoint, term, page, rank, title, text, url,
failed). ``endpoint`` is "advanced" or "regular", ``term`` says what was searched for ("ticker",
"company_name", "abbrev1", "abbrev2"), ``rank`` orders an answer. A row with ``failed`` true stands for a
search that gave an error.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import text
from .joins import lookup_table
from .summaries import SEARCH_SOURCES

# Fixed values of the selection rule.
TARGET_ARTICLES = 10
FALLBACK_THRESHOLD = 7
MAX_PAGES = 10

DAY = ["ticker", "date"]
ANSWER = [*DAY, "endpoint", "term", "page"]
ROW = [*ANSWER, "rank"]


def top_articles(news: DataFrame, order: list[str], n: int = TARGET_ARTICLES) -> DataFrame:
    """The first ``n`` articles of each (ticker, date) with their position."""
    position = F.row_number().over(Window.partitionBy(*DAY).orderBy(*order))
    return news.withColumn("position", position).where(F.col("position") <= n)


def _one_per_ticker(tickers: DataFrame) -> DataFrame:
    """A ticker listed several times takes one of its rows, so that no article multiplies."""
    names = F.min(F.struct("company_name", "abbrev1", "abbrev2")).alias("_names")
    return lookup_table(tickers, ["ticker"], names).select("ticker", "_names.*")


def matched_terms(candidates: DataFrame, tickers: DataFrame) -> DataFrame:
    """Candidates of known tickers with the searched text and what the article mentions."""
    known = candidates.join(_one_per_ticker(tickers), "ticker")
    searched = F.col("ticker")
    for name in SEARCH_SOURCES[1:]:
        searched = F.when(F.col("term") == name, F.col(name)).otherwise(searched)

    def mentions(rule, term: Column) -> Column:
        return F.coalesce(rule(F.col("title"), F.col("text"), term), F.lit(False))

    by_ticker = mentions(text.term_in_either, F.col("ticker"))
    return known.withColumns(
        {
            "searched": searched,
            "term_matched": mentions(text.term_in_either, searched) | by_ticker,
            "ticker_in_both": mentions(text.term_in_both, F.col("ticker")),
        }
    )


def select_articles(
    candidates: DataFrame,
    tickers: DataFrame,
    target: int = TARGET_ARTICLES,
    threshold: int = FALLBACK_THRESHOLD,
    max_pages: int = MAX_PAGES,
) -> DataFrame:
    """At most ``target`` articles per ticker and day.

    The advanced search comes first. While fewer than ``threshold`` articles are held, the regular searches
    for ticker, company name and abbreviations follow in turn, each adding articles with new urls. With
    ``target`` articles the day is done. Otherwise the list is deduplicated and continued with the further
    pages of the ticker search up to the first missing or failed page.
    """
    tagged = matched_terms(candidates.withColumn("failed", F.coalesce("failed", F.lit(False))), tickers)
    lists = _short_answers(tagged, target, threshold, max_pages)
    per_day = lists.groupBy(*DAY).agg(
        F.array_sort(F.collect_list(F.struct("lane", "page", "rank", "url", "title", "term", "endpoint"))).alias("items")
    )
    chosen = _choose(_answers(tagged, max_pages).join(per_day, DAY, "left"), target, threshold, max_pages)
    names = _one_per_ticker(tickers)
    picked = (
        chosen.select(*DAY, "endpoint_used", "used", F.posexplode("chosen").alias("_at", "_item"))
        .select(*DAY, "endpoint_used", "used", (F.col("_at") + 1).alias("position"), "_item.endpoint", "_item.term", "_item.page", "_item.rank")
        .join(names, "ticker")
        .withColumn("search_source", F.col("term"))
        .withColumn("search_terms_used", _terms_text())
        .drop("used", "abbrev1", "abbrev2")
    )
    articles = candidates.where(~F.coalesce("failed", F.lit(False))).drop("failed")
    return articles.join(picked, ROW)


def _lanes(max_pages: int) -> Column:
    """The lists an article may enter: its own answer, and the strict check used after a failed search."""
    first, regular = F.col("page") == 1, F.col("endpoint") == "regular"
    by_ticker = F.col("term") == "ticker"
    own = F.when(by_ticker, F.col("endpoint")).otherwise(F.when(regular & first, F.col("term")))
    usable = (F.col("page") <= max_pages) & (~regular | F.col("term_matched")) & (F.coalesce("searched", F.lit("")) != "")
    strict = by_ticker & regular & first & F.col("ticker_in_both")
    lanes = F.array(F.when(usable, own), F.when(strict, F.lit("strict")))
    return F.filter(lanes, lambda lane: lane.isNotNull())


def _short_answers(tagged: DataFrame, target: int, threshold: int, max_pages: int) -> DataFrame:
    """The head of each answer, long enough for an exact choice.

    First pages: an answer is passed over only for urls already held, fewer than ``threshold`` of them. More
    than ``target`` copies of one url are never needed, so ``threshold * target`` rows always hold ``target``
    new articles if there are any. Later pages: of equal (url, title) pairs the third is always a duplicate,
    and with u urls and t titles held, u + t < ``target``, at most (u + 1)(t + 1) pairs are. Both limits are
    ranks, which Spark applies on the map side too.
    """
    rows = max(threshold * target, 2 * ((target + 1) ** 2 // 4) + target)
    heads = tagged.where(~F.col("failed")).select(
        *ROW, F.explode(_lanes(max_pages)).alias("lane"), "url", text.strip(F.coalesce("title", F.lit(""))).alias("title")
    )
    later = F.col("page") > 1
    answer = [*DAY, "lane", "page"]
    same = Window.partitionBy(*answer, F.coalesce("url", F.lit("")), F.when(later, F.col("title"))).orderBy("rank")
    heads = heads.withColumn("_copy", F.row_number().over(same))
    heads = heads.where((F.col("_copy") <= max(target, 2)) & (~later | (F.col("_copy") <= 2)))
    position = F.row_number().over(Window.partitionBy(*answer).orderBy("rank"))
    return heads.withColumn("_position", position).where(F.col("_position") <= rows)


def _answers(tagged: DataFrame, max_pages: int) -> DataFrame:
    """Per day: whether the advanced search failed, and which later pages came back."""
    answers = tagged.groupBy(*ANSWER).agg(F.bool_or("failed").alias("failed"))
    by_ticker = F.col("term") == "ticker"

    def pages(endpoint: str) -> Column:
        arrived = by_ticker & ~F.col("failed") & (F.col("endpoint") == endpoint) & F.col("page").between(2, max_pages)
        return F.collect_set(F.when(arrived, F.col("page"))).alias(f"{endpoint}_pages")

    broken = by_ticker & F.col("failed") & (F.col("endpoint") == "advanced") & (F.col("page") == 1)
    return answers.groupBy(*DAY).agg(F.bool_or(broken).alias("advanced_failed"), pages("advanced"), pages("regular"))


def _choose(days: DataFrame, target: int, threshold: int, max_pages: int) -> DataFrame:
    """The searches in turn, then the further pages; all on the bounded arrays of one day."""
    stand_in = F.col("advanced_failed")
    first = F.struct(
        F.when(stand_in, F.lit("strict")).otherwise(F.lit("advanced")).alias("lane"),
        F.lit("ticker").alias("term"),
        F.when(stand_in, F.lit("regular")).otherwise(F.lit("advanced")).alias("endpoint"),
    )
    followers = [
        F.struct(
            F.lit("regular" if term == "ticker" else term).alias("lane"),
            F.lit(term).alias("term"),
            F.lit("regular").alias("endpoint"),
        )
        for term in SEARCH_SOURCES
    ]

    def step(state: Column, search: Column) -> Column:
        # A regular search that already stood in for the failed one is not repeated.
        repeat = (search["lane"] == "regular") & (F.coalesce(state["endpoint"], F.lit("")) == "regular")
        due = (F.size(state["held"]) < min(threshold, target)) & ~repeat
        urls = F.filter(F.transform(state["held"], lambda x: x["url"]), lambda u: u != "")
        new = F.filter(
            F.col("items"),
            lambda x: due
            & (x["lane"] == search["lane"])
            & (x["page"] == 1)
            & ~F.coalesce(F.array_contains(urls, x["url"]), F.lit(False)),
        )

        def extend(found: Column) -> Column:
            grew = F.size(found) > 0
            return F.struct(
                F.concat(state["held"], found).alias("held"),
                F.when(grew, search["endpoint"]).otherwise(state["endpoint"]).alias("endpoint"),
                F.when(grew, F.array_union(state["used"], F.array(search["term"]))).otherwise(state["used"]).alias("used"),
            )

        # One-element transform, so that the new articles are worked out once.
        return F.get(F.transform(F.array(new), extend), F.lit(0))

    start = F.struct(
        F.filter("items", lambda x: F.lit(False)).alias("held"),
        F.lit(None).cast("string").alias("endpoint"),
        F.array().cast("array<string>").alias("used"),
    )
    searched = days.where("items IS NOT NULL").withColumn("_state", F.aggregate(F.array(first, *followers), start, step))
    endpoint = F.coalesce("_state.endpoint", F.lit("advanced"))
    arrived = F.when(endpoint == "regular", F.col("regular_pages")).otherwise(F.col("advanced_pages"))
    # Pages count up to the first gap.
    last_page = F.aggregate(
        F.sequence(F.lit(2), F.lit(max_pages)),
        F.lit(1),
        lambda last, page: F.when((last == page - 1) & F.array_contains(arrived, page), page).otherwise(last),
    )
    paged = searched.withColumns({"_endpoint": endpoint, "_last_page": last_page})
    further = F.filter(
        "items", lambda x: (x["lane"] == F.col("_endpoint")) & (x["page"] > 1) & (x["page"] <= F.col("_last_page"))
    )
    held = F.col("_state.held")
    chosen = F.when(F.size(held) >= target, held).otherwise(_distinct_articles(F.concat(held, further)))
    return paged.select(
        *DAY,
        F.slice(chosen, 1, target).alias("chosen"),
        F.coalesce("_state.endpoint", F.lit("none")).alias("endpoint_used"),
        F.col("_state.used").alias("used"),
    )


def _distinct_articles(items: Column) -> Column:
    """In order: articles with a new url, and others whose title is new among those others."""
    nothing = F.array().cast("array<string>")

    def step(state: Column, x: Column) -> Column:
        url, title = F.coalesce(x["url"], F.lit("")), x["title"]
        new_url = (url != "") & ~F.array_contains(state["urls"], url)
        new_title = ~new_url & (title != "") & ~F.array_contains(state["titles"], title)
        return F.struct(
            F.when(new_url | new_title, F.array_append(state["kept"], x)).otherwise(state["kept"]).alias("kept"),
            F.when(new_url, F.array_append(state["urls"], url)).otherwise(state["urls"]).alias("urls"),
            F.when(new_title, F.array_append(state["titles"], title)).otherwise(state["titles"]).alias("titles"),
        )

    start = F.struct(
        F.filter(items, lambda x: F.lit(False)).alias("kept"), nothing.alias("urls"), nothing.alias("titles")
    )
    return F.aggregate(items, start, step, lambda state: state["kept"])


def _terms_text() -> Column:
    """The searches that found something, such as "ticker:ABC, company:Some Name"."""
    texts = F.create_map(
        F.lit("ticker"), F.concat(F.lit("ticker:"), F.col("ticker")),
        F.lit("company_name"), F.concat(F.lit("company:"), F.col("company_name")),
        F.lit("abbrev1"), F.concat(F.lit("abbrev1:"), F.col("abbrev1")),
        F.lit("abbrev2"), F.concat(F.lit("abbrev2:"), F.col("abbrev2")),
    )
    return text.search_terms(F.transform("used", lambda term: F.element_at(texts, term)))
