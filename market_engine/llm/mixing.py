"""Mixing sources to target weights by a low-discrepancy schedule. DataFrame functions only.

The mix is a row of slots. Slot i has the golden-ratio point frac(i * 0.618...), which falls into one
source's share of the cumulative targets; the slots of a source are ranked in their order. Each source's
documents, in a shuffled order and repeated up to the limit, form one stream of words that is cut into blocks of
equal length, as many as the source has slots, and slot r of a source takes its block r. So every source
meets its target to the word, and any stretch of the mix has nearly the target shares.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..operators.joins import lookup_table
from .common import WORD, chunk_count, chunk_of, running_total, store, text_of

#: Weights of the sources in code point order, repeating.
WEIGHTS = (5, 2, 1)
#: How often a source, and so a document, may be taken at most.
REPEATS = 3
#: Words a slot takes, about.
BLOCK = 2048
#: The golden ratio as a fraction of 2^32: i * GOLDEN mod 2^32 is the point of slot i. Fixed value.
GOLDEN = 2654435769
#: The unit interval in cells, for looking up the source of a point by an equal key.
CELL_BITS = 20


@dataclass
class Mix:
    """sizes: a row per document (doc_id, source, size, source_size, target, start). slots: (slot, source_key,
    rank). pieces: (slot, source_key, start, doc_id, epoch, offset, words)."""

    sizes: DataFrame
    slots: DataFrame
    pieces: DataFrame


def word_count(text: Column) -> Column:
    return F.regexp_count(text, F.lit(WORD)).cast("long")


def targets(rows: DataFrame) -> DataFrame:
    """A row per source: source_size, weight, target. One row per source meets in a single task.

    Without a limit a source gets its weight's share of all words. The limit binds where limit / weight is
    small; with the sources in that order, the first ones are cut to their limits for as long as the share
    of what is left would exceed them.
    """
    by_source = rows.groupBy("source_key", "source").agg(F.sum("size").cast("long").alias("source_size"))
    order = Window.orderBy(F.col("source").asc_nulls_last())
    place = (F.row_number().over(order) - 1) % len(WEIGHTS)
    weight = F.element_at(F.array(*[F.lit(w).cast("long") for w in WEIGHTS]), (place + 1).cast("int"))
    weighed = by_source.withColumn("weight", weight).withColumn("_most", F.col("source_size") * REPEATS)
    by_ratio = Window.orderBy((F.col("_most") / F.col("weight")).asc(), F.col("source").asc_nulls_last())
    before = by_ratio.rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.partitionBy()
    capped, weights = F.coalesce(F.sum("_most").over(before), F.lit(0)), F.coalesce(F.sum("weight").over(before), F.lit(0))
    filled = (
        weighed.withColumn("_all", F.sum("source_size").over(everything))
        .withColumn("_left", F.col("_all") - capped)
        .withColumn("_weights", F.sum("weight").over(everything) - weights)
        # This source is the first not cut if its share of what is left is within its limit.
        .withColumn("_fits", F.col("weight").cast("double") * F.col("_left") <= F.col("_most").cast("double") * F.col("_weights"))
    )
    level = F.first(F.when(F.col("_fits"), F.struct("_left", "_weights")), ignorenulls=True).over(
        by_ratio.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    )
    share = F.col("weight").cast("double") * F.col("_level._left") / F.col("_level._weights")
    most = F.col("_most").cast("double")
    return filled.withColumn("_level", level).select(
        "source_key", "source", "source_size", "weight", F.least(share, most).alias("target")
    )


def schedule(by_source: DataFrame, block: int) -> DataFrame:
    """slot, source_key, rank and the number of slots of each source.

    Slots are dealt by golden-ratio points. A source with a target that no point meets gets one slot at the end.
    """
    spark = by_source.sparkSession
    total = by_source.agg(F.sum("source_size")).first()[0] or 0
    slots = max(1, -(-total // block))
    grid = F.lit(float(1 << 32))
    everything = Window.orderBy(F.col("source").asc_nulls_last())
    upper = F.sum("target").over(everything.rowsBetween(Window.unboundedPreceding, 0))
    all_targets = F.sum("target").over(Window.partitionBy())
    ends = by_source.where("target > 0").withColumn("_high", F.floor(upper / all_targets * grid).cast("long"))
    last = F.lead("_high").over(everything).isNull()
    bounds = ends.select(
        "source_key",
        F.coalesce(F.lag("_high").over(everything), F.lit(0)).alias("low"),
        F.when(last, F.lit(1 << 32)).otherwise(F.col("_high")).alias("high"),
    ).where("low < high")
    cells = bounds.select(
        "*", F.explode(F.expr(f"sequence(shiftright(low, {CELL_BITS}), shiftright(high - 1, {CELL_BITS}))")).alias("cell")
    )
    point = (F.col("id") % F.lit(1 << 31)) * F.lit(GOLDEN) % F.lit(1 << 32)
    points = spark.range(slots).select(F.col("id").alias("slot"), point.alias("point"))
    points = points.withColumn("cell", F.shiftright("point", CELL_BITS))
    met = points.join(cells, "cell").where("point >= low AND point < high").select("slot", "source_key")
    met = store(met.withColumn("_chunk", F.shiftright("slot", 12)), "slots")
    ranked = running_total(met, ["source_key"], "_chunk", ["slot"], F.lit(1), "rank").select("slot", "source_key", "rank")
    counts = met.groupBy("source_key").agg(F.count(F.lit(1)).alias("slots"))
    missed = by_source.where("target > 0").join(counts, "source_key", "left_anti")
    added = missed.select(
        (F.lit(slots) + F.row_number().over(Window.orderBy("source_key")) - 1).cast("long").alias("slot"),
        "source_key",
        F.lit(0).cast("long").alias("rank"),
    )
    return ranked.unionByName(added)


def mix(docs: DataFrame, block: int = BLOCK) -> Mix:
    """Mix documents so that sources meet their targets.

    A document's size is its number of words, 0 for a NULL text; documents without words are never taken. A
    NULL source is a source of its own, last in order. The shuffled order goes by the MD5 of the doc_id (NULL
    first), then doc_id, size and a hash of the text, so reruns agree; rows alike in these are interchangeable. An empty table
    gives empty results. Other columns play no part.
    """
    source = F.col("source").cast("string")
    number = F.col("doc_id").cast("long")
    rows = store(
        docs.select(
            number.alias("doc_id"),
            source.alias("source"),
            F.coalesce(F.concat(F.lit("="), source), F.lit("")).alias("source_key"),
            word_count(text_of()).alias("size"),
            F.xxhash64(text_of()).alias("digest"),
            F.conv(F.substring(F.md5(F.coalesce(number.cast("string"), F.lit("")).cast("binary")), 1, 8), 16, 10)
            .cast("long")
            .alias("_hash"),
        ),
        "sizes",
    )
    by_source = store(targets(rows), "targets")
    slots = store(schedule(by_source, block), "schedule")

    chunked = rows.withColumn("_chunk", chunk_of(F.col("_hash"), chunk_count(rows.count()), 32))
    placed = running_total(chunked, ["source_key"], "_chunk", ["_hash", "doc_id", "size", "digest"], F.col("size"), "start")
    counts = slots.groupBy("source_key").agg(F.count(F.lit(1)).alias("slots"))
    about = by_source.join(counts, "source_key", "left").select(
        "source_key", "source_size", "target", F.floor("target").alias("_words"), F.coalesce("slots", F.lit(1)).alias("_slots")
    )
    about = about.withColumn("_block", F.greatest(F.ceil(F.col("_words") / F.col("_slots")), F.lit(1)).cast("long"))
    sizes = store(placed.join(about, "source_key"), "placed")

    begin = F.col("start") + F.col("epoch") * F.col("source_size")
    stretches = (
        sizes.where("size > 0")
        .withColumn("epoch", F.explode(F.array(*[F.lit(i) for i in range(REPEATS)])))
        .withColumn("_begin", begin)
        .withColumn("_end", F.least(F.col("_begin") + F.col("size"), F.col("_words")))
        .where("_begin < _end")
        .withColumn("rank", F.explode(F.expr("sequence(_begin div _block, (_end - 1) div _block)")))
        .withColumn("_from", F.greatest("_begin", F.col("rank") * F.col("_block")))
        .withColumn("words", F.least("_end", (F.col("rank") + 1) * F.col("_block")) - F.col("_from"))
        .withColumn("offset", F.col("_from") - F.col("_begin"))
    )
    pieces = stretches.join(slots, ["source_key", "rank"]).select(
        "slot", "source_key", "start", "doc_id", "epoch", "offset", "words"
    )
    return Mix(sizes, slots, pieces)


def taken(mixed: Mix) -> DataFrame:
    """A row per document: doc_id, source, size, source_size, target, taken (words in the mix)."""
    by_doc = mixed.pieces.groupBy("source_key", "start").agg(F.sum("words").alias("_taken"))
    by_doc = by_doc.select(F.col("source_key").alias("_source"), F.col("start").alias("_start"), "_taken")
    sizes = mixed.sizes
    # Documents without words share their start with the next one and take nothing.
    same = (F.when(sizes["size"] > 0, sizes["start"]) == F.col("_start")) & (sizes["source_key"] == F.col("_source"))
    return sizes.join(by_doc, same, "left").select(
        "doc_id", "source", "size", "source_size", "target", F.coalesce("_taken", F.lit(0)).cast("long").alias("taken")
    )


def copies(mixed: Mix) -> DataFrame:
    """How often each document goes into the mix whole: source_key, doc_id, size, digest, and `rows`, `copies` of the
    rows alike in these, together.

    A source takes at most one document in part, which counts to the nearest whole number of times. A source with
    a target takes one document at least, its first. So a source misses its target by less than one document.
    """
    by_doc = mixed.pieces.groupBy("source_key", "start").agg(F.sum("words").alias("_taken"))
    by_doc = by_doc.withColumnsRenamed({"source_key": "_source", "start": "_start"})
    sizes = mixed.sizes.where("size > 0")
    found = sizes.join(by_doc, (sizes["source_key"] == F.col("_source")) & (sizes["start"] == F.col("_start")), "left")
    whole = F.round(F.coalesce("_taken", F.lit(0)) / F.col("size"))
    # The first document of a source stands at 0, and the only one it may take is no more than that one.
    least = ((F.col("start") == 0) & (F.col("target") >= 1)).cast("int")
    found = found.withColumn("_copies", F.greatest(whole, least))
    return found.groupBy("source_key", "doc_id", "size", "digest").agg(
        F.count(F.lit(1)).alias("rows"), F.sum("_copies").cast("long").alias("copies")
    )


def mixed_documents(docs: DataFrame, block: int = BLOCK) -> DataFrame:
    """The documents, each as often as the mix takes it whole (see `copies`), with all their columns.

    Documents that the mix does not take go, and with them those without words. Rows alike in source, doc_id and text
    share what is taken of them as evenly as whole numbers allow. NULLs are values of their own; an empty table gives
    an empty one.
    """
    source = F.col("source").cast("string")
    keyed = docs.withColumns(
        {
            "_llm_id": F.coalesce(F.col("doc_id").cast("long").cast("string"), F.lit("")),
            "_llm_source": F.coalesce(F.concat(F.lit("="), source), F.lit("")),
            "_llm_size": word_count(text_of()),
            "_llm_digest": F.xxhash64(text_of()),
        }
    )
    keys = ["_llm_source", "_llm_id", "_llm_size", "_llm_digest"]
    found = copies(mix(docs, block)).where("copies > 0").select(
        F.col("source_key").alias("_llm_source"),
        F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("_llm_id"),
        F.col("size").alias("_llm_size"),
        F.col("digest").alias("_llm_digest"),
        F.floor(F.col("copies") / F.col("rows")).cast("int").alias("_llm_each"),
        (F.col("copies") % F.col("rows")).alias("_llm_more"),
    )
    joined = keyed.join(lookup_table(found, [*keys, "_llm_each", "_llm_more"]), keys)
    # Alike rows are taken equally often but for those at the end of what their source takes: one group a source.
    place = F.row_number().over(Window.partitionBy(*keys).orderBy(F.xxhash64(*[F.col(c).cast("string") for c in docs.columns])))
    uneven = joined.where("_llm_more > 0").withColumn("_llm_extra", (place <= F.col("_llm_more")).cast("int"))
    even = joined.where("_llm_more = 0").withColumn("_llm_extra", F.lit(0))
    times = even.unionByName(uneven).withColumn("_llm_times", F.col("_llm_each") + F.col("_llm_extra")).where("_llm_times > 0")
    return times.withColumn("_llm_copy", F.explode(F.sequence(F.lit(1), "_llm_times"))).select(*docs.columns)


def result(docs: DataFrame) -> DataFrame:
    return taken(mix(docs)).select("doc_id", "size", "source_size", "target", "taken")


ORACLE = r"""
WITH d AS (
  SELECT doc_id, source, CAST(coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS BIGINT) AS size,
         CAST('0x' || substr(md5(CAST(doc_id AS VARCHAR)), 1, 8) AS BIGINT) AS h
  FROM documents),
s AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM d GROUP BY source),
w AS (SELECT *, CAST([5, 2, 1][(row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1] AS BIGINT) AS weight FROM s),
-- the level at which the sources under their limits share what the others leave
c AS (
  SELECT w.*, (SELECT sum(source_size) FROM w) - coalesce(sum(3 * source_size) OVER before, 0) AS rest,
         (SELECT sum(weight) FROM w) - coalesce(sum(weight) OVER before, 0) AS weights
  FROM w WINDOW before AS (ORDER BY CAST(3 * source_size AS DOUBLE) / weight, source NULLS LAST
                           ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
l AS (SELECT rest, weights FROM c WHERE weight * rest <= 3 * source_size * weights
      ORDER BY CAST(3 * source_size AS DOUBLE) / weight, source NULLS LAST LIMIT 1),
t AS (SELECT c.source, source_size,
             least(CAST(weight * l.rest AS DOUBLE) / CAST(l.weights AS DOUBLE), CAST(3 * source_size AS DOUBLE)) AS target
      FROM c CROSS JOIN l),
p AS (
  SELECT d.*, t.source_size, t.target,
         coalesce(sum(size) OVER (PARTITION BY d.source ORDER BY h, doc_id, size
                                  ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS a
  FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source)
SELECT doc_id, size, source_size, target,
       CAST(greatest(0, least(size, floor(target) - a))
          + greatest(0, least(size, floor(target) - a - source_size))
          + greatest(0, least(size, floor(target) - a - 2 * source_size)) AS BIGINT) AS taken
FROM p
"""
