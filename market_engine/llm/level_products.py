"""Divergence of sources from each other, priced from joint tables of count levels.

Every group (lang, source) gives each term a price that depends on nothing but the term's count there, its
level. So two groups need only their joint table: how many terms have level c in one and level d in the other.
With a row per term and a 0/1 column per (group, level), the transpose of that matrix times itself holds the joint
tables of all pairs of groups. The product is taken in blocks of terms and of columns; its entries are whole
numbers below 2^24, which single precision holds exactly. Each block's tables are priced in whole numbers at
once, so that only a sum per pair of groups leaves a block.

Terms are counted in tasks first; what is shuffled is a row per (lang, source, term) of a task. Nothing is
partitioned by lang or source alone, so a hot one spreads over all blocks.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import store, text_of

MIN_DOCUMENTS = 30
TOP_TERMS = 50
SCALE = 1_000_000_000
#: What is added to every count.
PRIOR = 5
#: Counts a task holds before it hands them on.
HELD = 400_000
#: Terms of a block, and counts of a block where there are very many sources, about.
BLOCK_TERMS, BLOCK_COUNTS = 2048, 262_144
#: Columns of the 0/1 matrices that are multiplied at a time.
BLOCK_COLUMNS = 2048

#: ASCII letters in lower case, bytes of other characters as they are, everything else a space.
_TERM_BYTES = bytes(b | 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b >= 128 else 32 for b in range(256))


# Counting -----------------------------------------------------------------------------------------------


def term_counts(docs: DataFrame, held: int = HELD) -> DataFrame:
    """lang, source, term, n (occurrences), documents: partial counts, several rows for a term.

    Each (lang, source) also gives rows with the empty term, which no text holds, so that a source without
    terms is known.
    """
    schema = "lang string, source string, term string, n long, documents long"
    kind = pa.schema([("lang", pa.string()), ("source", pa.string()), ("term", pa.string()), ("n", pa.int64()), ("documents", pa.int64())])

    def rows(key: tuple, counts: Counter, documents: Counter) -> pa.RecordBatch:
        size = len(counts) + 1
        terms = pa.array([b"", *counts], pa.binary()).cast(pa.string())
        columns = [pa.array([key[0]] * size), pa.array([key[1]] * size), terms]
        columns += [pa.array([0, *counts.values()], pa.int64()), pa.array([0, *map(documents.__getitem__, counts)], pa.int64())]
        return pa.RecordBatch.from_arrays(columns, schema=kind)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        groups: dict[tuple, tuple[Counter, Counter]] = {}
        size = 0
        for batch in batches:
            for key, text in zip(zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()), batch.column(2)):
                counts, documents = groups.setdefault(key, (Counter(), Counter()))
                before = len(counts)
                terms = text.as_py().translate(_TERM_BYTES).split()
                counts.update(terms)
                documents.update(set(terms))
                size += len(counts) - before
                if size > held:
                    yield from (rows(k, *c) for k, c in groups.items())
                    groups, size = {}, 0
        yield from (rows(k, *c) for k, c in groups.items())

    plain = docs.select(
        *[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("lang", "source")],
        text_of().cast("binary").alias("text"),
    )
    return plain.mapInArrow(count, schema)


# Prices -------------------------------------------------------------------------------------------------


def price(count: np.ndarray, total: int) -> np.ndarray:
    """1 + floor(SCALE * (count + PRIOR) / total), by long division, as the product may exceed 64 bits."""
    rest = count.astype(np.int64) + PRIOR
    found = rest // total
    for _ in range(3):
        rest = rest % total * 1000
        found = found * 1000 + rest // total
    return 1 + found


def price_of(count: Column, total: Column) -> Column:
    """The same in SQL."""
    scaled = (count + PRIOR).cast("decimal(28,0)") * F.lit(SCALE).cast("decimal(10,0)")
    return 1 + F.call_function("div", scaled, total.cast("decimal(28,0)"))


def joint_prices(counts: np.ndarray, totals: list[int], columns: int = BLOCK_COLUMNS) -> np.ndarray:
    """For every pair of groups the sum over the terms (rows) of the difference of their prices.

    `counts` has a column per group. Groups are put together to about `columns` levels at a time.
    """
    groups = counts.shape[1]
    priced = np.zeros((groups, groups), np.int64)
    if not len(counts):
        return priced
    levels, places = zip(*(np.unique(counts[:, g], return_inverse=True) for g in range(groups)))
    parts: list[list[int]] = [[]]
    for g in range(groups):
        if parts[-1] and sum(len(levels[i]) for i in parts[-1]) + len(levels[g]) > columns:
            parts.append([])
        parts[-1].append(g)

    def hot(part: list[int]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """0/1 columns of the part's levels, where each group's begin, and their prices."""
        begins = np.cumsum([0] + [len(levels[g]) for g in part])
        matrix = np.zeros((len(counts), begins[-1]), np.float32)
        for g, begin in zip(part, begins):
            matrix[np.arange(len(counts)), begin + places[g]] = 1
        return matrix, begins[:-1], np.concatenate([price(levels[g], totals[g]) for g in part])

    for i, first in enumerate(parts):
        left, left_begins, left_prices = hot(first)
        for second in parts[i:]:
            right, right_begins, right_prices = hot(second) if second is not first else (left, left_begins, left_prices)
            tables = (left.T @ right).astype(np.int64)
            tables *= np.abs(left_prices[:, None] - right_prices[None, :])
            sums = np.add.reduceat(np.add.reduceat(tables, left_begins, axis=0), right_begins, axis=1)
            priced[np.ix_(first, second)] = sums
            priced[np.ix_(second, first)] = sums.T
    return priced


# The operator -------------------------------------------------------------------------------------------


def source_pairs(kept: DataFrame, groups: DataFrame) -> DataFrame:
    """lang, a, b (numbers of sources), value: the summed difference for each ordered pair of a lang's sources.

    `kept` has lang, term, sources and counts (arrays), `groups` lang, number, total, block count `blocks`.
    """
    # A term falls into one of its lang's blocks; the lang's groups, one narrow row each, go to every block.
    blocks = groups.groupBy("lang").agg(F.max("blocks").alias("blocks"))
    terms = kept.join(blocks, "lang").select(
        "lang", F.pmod(F.xxhash64("term"), F.col("blocks")).alias("block"), "sources", "counts"
    )
    known = groups.withColumn("block", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)))
    known = known.select("lang", "block", "number", "total")

    def multiply(key: tuple, terms: pd.DataFrame, known: pd.DataFrame) -> pd.DataFrame:
        known = known.sort_values("number")
        numbers = known["number"].to_numpy()
        counts = np.zeros((len(terms), len(known)), np.int64)
        if len(terms):
            rows = np.repeat(np.arange(len(terms)), terms["sources"].map(len))
            at = np.searchsorted(numbers, np.concatenate(list(terms["sources"])))
            counts[rows, at] = np.concatenate(list(terms["counts"]))
        priced = joint_prices(counts, known["total"].tolist())
        a, b = np.nonzero(~np.eye(len(numbers), dtype=bool))
        return pd.DataFrame({"lang": key[0], "a": numbers[a], "b": numbers[b], "value": priced[a, b]})

    keys = ["lang", "block"]
    parts = terms.groupBy(*keys).cogroup(known.groupBy(*keys)).applyInPandas(multiply, "lang string, a long, b long, value long")
    return parts.groupBy("lang", "a", "b").agg(F.sum("value").cast("long").alias("value"))


def result(docs: DataFrame, min_documents: int = MIN_DOCUMENTS, top_terms: int = TOP_TERMS) -> DataFrame:
    """lang, source, part, item, value, rank: how far each source is from the others of its lang, and its own terms.

    Part `pair` has each other source of the lang with the summed difference of the prices of all kept terms;
    part `term` the terms the source prices above its lang, the first `top_terms` of them. NULL lang, source and
    text are empty strings. A source without terms prices every kept term at zero occurrences; a lang without
    kept terms gives pairs of value 0. Equal values rank by item. An empty table gives an empty result; other
    columns play no part, and repeated rows are documents of their own.
    """
    keys = ["lang", "source", "term"]
    counted = store(term_counts(docs).groupBy(*keys).agg(F.sum("n").alias("n"), F.sum("documents").alias("documents")), "terms")
    by_term = counted.where("term <> ''").groupBy("lang", "term").agg(
        F.sum("documents").alias("documents"),
        F.sum("n").cast("long").alias("n"),
        F.collect_list(F.struct("source", "n")).alias("found"),
    )
    kept = store(by_term.where(F.col("documents") >= min_documents).drop("documents"), "kept")
    # A row per lang and per (lang, source): the sums behind the prices, and numbers for the sources.
    per_lang = kept.groupBy("lang").agg(
        F.count(F.lit(1)).alias("terms"), F.sum("n").cast("long").alias("lang_n"), F.sum(F.size("found")).alias("counts")
    )
    per_source = kept.select("lang", F.inline("found")).groupBy("lang", "source").agg(F.sum("n").cast("long").alias("source_n"))
    groups = counted.where("term = ''").select("lang", "source").join(per_lang, "lang", "left").join(per_source, ["lang", "source"], "left")
    zero = F.lit(0).cast("long")
    terms = F.coalesce("terms", zero)
    blocks = F.greatest(F.ceil(terms / BLOCK_TERMS), F.ceil(F.coalesce("counts", zero) / BLOCK_COUNTS), F.lit(1))
    groups = store(
        groups.select(
            "lang",
            "source",
            (F.row_number().over(Window.partitionBy("lang").orderBy("source")) - 1).cast("long").alias("number"),
            # Without terms nothing is priced; one keeps the division defined.
            F.greatest(F.coalesce("source_n", zero) + PRIOR * terms, F.lit(1)).alias("total"),
            F.greatest(F.coalesce("lang_n", zero) + PRIOR * terms, F.lit(1)).alias("lang_total"),
            blocks.cast("long").alias("blocks"),
        ),
        "groups",
    )
    entries = kept.select("lang", "term", F.col("n").alias("lang_n"), F.inline("found"))
    numbered = entries.join(groups.select("lang", "source", "number", "total", "lang_total"), ["lang", "source"])
    numbered = store(numbered, "numbered")

    listed = numbered.groupBy("lang", "term").agg(F.collect_list(F.struct("number", "n")).alias("_found"))
    arrays = listed.select("lang", "term", F.col("_found.number").alias("sources"), F.col("_found.n").alias("counts"))
    pairs = source_pairs(arrays, groups)
    a = groups.select("lang", F.col("number").alias("a"), "source")
    b = groups.select("lang", F.col("number").alias("b"), F.col("source").alias("item"))
    pairs = pairs.join(a, ["lang", "a"]).join(b, ["lang", "b"]).select("lang", "source", F.lit("pair").alias("part"), "item", "value")

    above = (price_of(F.col("n"), F.col("total")) - price_of(F.col("lang_n"), F.col("lang_total"))).cast("long")
    own = numbered.select("lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"), above.alias("value"))
    by_value = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    rank = F.row_number().over(by_value).alias("rank")
    ranked_terms = own.where("value > 0").select("*", rank).where(F.col("rank") <= top_terms)
    return pairs.select("*", rank).unionByName(ranked_terms)


ORACLE = r"""
WITH d AS (
  SELECT coalesce(lang, '') AS lang, coalesce(source, '') AS source,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS w
  FROM documents),
f AS (SELECT lang, t FROM (SELECT lang, unnest(list_distinct(w)) AS t FROM d) GROUP BY ALL HAVING count(*) >= 30),
o AS (SELECT lang, source, t, count(*) AS c FROM (SELECT lang, source, unnest(w) AS t FROM d) GROUP BY ALL),
g AS (SELECT DISTINCT lang, source FROM d),
v AS (SELECT lang, count(*) AS v FROM f GROUP BY lang),
k AS (SELECT g.lang, g.source, f.t, coalesce(o.c, 0) AS c FROM g JOIN f USING (lang) LEFT JOIN o ON o.lang = g.lang AND o.source = g.source AND o.t = f.t),
gn AS (SELECT lang, source, sum(c) AS n FROM k GROUP BY ALL),
ln AS (SELECT lang, sum(n) AS n FROM gn GROUP BY ALL),
lt AS (SELECT lang, t, sum(c) AS c FROM k GROUP BY ALL),
p AS (
  SELECT k.lang, k.source, k.t, k.c, 1 + (1000000000::HUGEINT * (k.c + 5)) // (gn.n + 5 * v.v) AS p,
         1 + (1000000000::HUGEINT * (lt.c + 5)) // (ln.n + 5 * v.v) AS q
  FROM k JOIN gn ON gn.lang = k.lang AND gn.source = k.source JOIN v ON v.lang = k.lang JOIN ln ON ln.lang = k.lang
  JOIN lt ON lt.lang = k.lang AND lt.t = k.t),
s AS (SELECT a.lang, a.source, b.source AS item, sum(abs(a.p - b.p)) AS value FROM p a JOIN p b ON a.lang = b.lang AND a.t = b.t AND a.source <> b.source GROUP BY ALL),
r AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(s.value, 0) AS value
  FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN s ON s.lang = a.lang AND s.source = a.source AND s.item = b.source
  UNION ALL
  SELECT lang, source, 'term', t, p - q FROM p WHERE c > 0 AND p > q)
SELECT lang, source, part, item, CAST(value AS BIGINT) AS value, CAST(rank AS INTEGER) AS rank
FROM (SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS rank FROM r)
WHERE part = 'pair' OR rank <= 50
"""
