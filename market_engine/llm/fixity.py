"""Fixity audit of WARC replicas by Merkle trees over offset ranges.

A leaf is a record's digest at its offset in an archive. The nodes above cover ranges of offsets, 64 KiB on
the first level and 16 times as much on each next one, and hash their children in order of offset. Two
replicas are compared at the roots; only below nodes that differ are children compared, down to the records. No
node has more children than its range has room for, so a group is small however large an archive is.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import chunk_count, chunk_of, running_total, store

#: Bytes of a node of the first level, and children of a node above.
RANGE = 1 << 16
FANOUT = 16
#: Bytes of an archive, about.
ARCHIVE_BYTES = 1 << 26


# Records ------------------------------------------------------------------------------------------------


def warc_record(url: Column, body: Column) -> Column:
    """A response record: header lines, an empty line, the body, two line ends."""
    url, body = F.coalesce(url, F.lit("")), F.coalesce(body, F.lit(""))
    return F.concat(
        F.lit("WARC/1.0\r\nWARC-Type: response\r\nWARC-Target-URI: "),
        url,
        F.lit("\r\nContent-Length: "),
        F.octet_length(body).cast("string"),
        F.lit("\r\n\r\n"),
        body,
        F.lit("\r\n\r\n"),
    )


def place(records: DataFrame, archive_bytes: int = ARCHIVE_BYTES) -> DataFrame:
    """Give records (stored, with record_hash of 32 bits and length) an archive and an offset in it.

    Archives are ranges of the hash, in whose order records lie. Read twice, the rows must be stored.
    """
    total = records.agg(F.sum("length").alias("bytes"), F.count(F.lit(1)).alias("n")).first()
    archives = max(1, -(-(total["bytes"] or 0) // archive_bytes))
    keyed = records.withColumn("archive", chunk_of(F.col("record_hash"), archives, 32)).withColumn(
        "_chunk", chunk_of(F.col("record_hash"), chunk_count(total["n"]) * archives, 32)
    )
    order = ["record_hash", "record_id", "length", "digest"]
    return running_total(keyed, ["archive"], "_chunk", order, F.col("length"), "offset").drop("_chunk")


# Trees --------------------------------------------------------------------------------------------------


def _node(level: int) -> Column:
    return F.expr(f"offset div {RANGE * FANOUT ** (level - 1)}L")


def _digest_of(children: Column) -> Column:
    return F.sha2(F.array_join(F.transform(F.array_sort(children), lambda c: F.concat_ws(":", *[c[i] for i in ("at", "hash")])), ","), 256)


def build_tree(leaves: DataFrame, levels: int) -> list[DataFrame]:
    """Nodes (archive, node, hash) of each level, from the first to the roots. leaves: archive, offset, length, digest."""
    entry = F.struct(F.col("offset").alias("at"), F.concat_ws("/", "length", "digest").alias("hash"))
    tree = []
    for level in range(1, levels + 1):
        if level == 1:
            grouped = leaves.groupBy("archive", _node(1).alias("node"))
        else:
            grouped = tree[-1].groupBy("archive", F.expr(f"node div {FANOUT}").alias("_up")).agg(
                _digest_of(F.collect_list(F.struct(F.col("node").alias("at"), "hash"))).alias("hash")
            )
        nodes = grouped.agg(_digest_of(F.collect_list(entry)).alias("hash")) if level == 1 else grouped.withColumnRenamed("_up", "node")
        tree.append(store(nodes.select("archive", "node", "hash"), f"level{level}"))
    return tree


def level_count(leaves: DataFrame) -> int:
    """Levels until one node covers an archive."""
    last = leaves.agg(F.max("offset")).first()[0] or 0
    levels = 1
    while last >= RANGE * FANOUT ** (levels - 1):
        levels += 1
    return levels


def _differing(left: DataFrame, right: DataFrame) -> DataFrame:
    """(archive, node) where the hashes of two levels differ, or one has no such node."""
    a, b = left.withColumnRenamed("hash", "_a"), right.withColumnRenamed("hash", "_b")
    return a.join(b, ["archive", "node"], "full").where(~F.col("_a").eqNullSafe(F.col("_b"))).select("archive", "node")


def audit(first: DataFrame, second: DataFrame) -> DataFrame:
    """Records on which two replicas differ: archive, offset, record_id, length, status, first_digest, second_digest.

    Both have archive, offset, length, digest, record_id; (archive, offset) is unique. status is `changed`,
    `missing` (in the second) or `extra`; record_id and length are the first's where it has the record. Equal replicas
    and empty tables give no rows. Rows without a digest count as not there.
    """
    columns = ["archive", "offset", "length", "digest", "record_id"]
    first = store(first.select(*columns).where("digest IS NOT NULL"), "first")
    second = store(second.select(*columns).where("digest IS NOT NULL"), "second")
    levels = max(level_count(first), level_count(second))
    left, right = build_tree(first, levels), build_tree(second, levels)
    suspects = store(_differing(left[-1], right[-1]), "suspects")
    for level in range(levels - 1, 0, -1):
        up = suspects.withColumnRenamed("node", "_up")

        def below(nodes: DataFrame, up=up) -> DataFrame:
            return nodes.withColumn("_up", F.expr(f"node div {FANOUT}")).join(up, ["archive", "_up"], "left_semi").drop("_up")

        suspects = store(_differing(below(left[level - 1]), below(right[level - 1])), "suspects")

    def leaves_below(leaves: DataFrame, prefix: str) -> DataFrame:
        found = leaves.withColumn("node", _node(1)).join(suspects, ["archive", "node"], "left_semi")
        return found.select("archive", "offset", *[F.col(c).alias(f"{prefix}_{c}") for c in ("length", "digest", "record_id")])

    both = leaves_below(first, "first").join(leaves_below(second, "second"), ["archive", "offset"], "full")
    differ = ~(F.col("first_digest").eqNullSafe(F.col("second_digest")) & F.col("first_length").eqNullSafe(F.col("second_length")))
    status = F.when(F.col("second_digest").isNull(), "missing").when(F.col("first_digest").isNull(), "extra").otherwise("changed")
    have = F.col("first_digest").isNotNull()
    return both.where(differ).select(
        "archive",
        "offset",
        F.when(have, F.col("first_record_id")).otherwise(F.col("second_record_id")).alias("record_id"),
        F.when(have, F.col("first_length")).otherwise(F.col("second_length")).alias("length"),
        status.alias("status"),
        "first_digest",
        "second_digest",
    )


# The query ----------------------------------------------------------------------------------------------


def replicas(pages: DataFrame) -> DataFrame:
    """The pages as records of a sound replica and of one with known damage, by the MD5 of page_id and url: every
    97th record has another first byte of the body, every 97th is lost. NULL url or html is empty."""
    number = F.coalesce(F.col("page_id").cast("string"), F.lit(""))
    hashed = F.conv(F.substring(F.md5(F.concat_ws("|", number, F.coalesce("url", F.lit(""))).cast("binary")), 1, 8), 16, 10)
    body = F.coalesce("html", F.lit(""))
    sound = warc_record(F.col("url"), body)
    damaged = warc_record(F.col("url"), F.concat(F.lit("~"), F.substring(body, 2, 2147483647)))
    kind = F.col("record_hash") % 97
    rows = pages.select(F.col("page_id").cast("long").alias("record_id"), hashed.cast("long").alias("record_hash"), "url", "html")
    digest = F.sha2(sound.cast("binary"), 256)
    return rows.select(
        "record_id",
        "record_hash",
        F.octet_length(sound).cast("long").alias("length"),
        digest.alias("digest"),
        F.when(kind == 1, F.sha2(damaged.cast("binary"), 256)).when(kind != 2, digest).alias("second_digest"),
    )


def result(pages: DataFrame) -> DataFrame:
    placed = store(place(store(replicas(pages), "records")), "placed")
    second = placed.select("archive", "offset", "length", F.col("second_digest").alias("digest"), "record_id")
    return audit(placed, second).withColumnRenamed("record_id", "page_id")


ORACLE = rf"""
WITH r AS (
  SELECT page_id, coalesce(url, '') AS url, coalesce(html, '') AS html,
         CAST('0x' || substr(md5(coalesce(CAST(page_id AS VARCHAR), '') || '|' || coalesce(url, '')), 1, 8) AS BIGINT) AS h
  FROM pages),
p AS (
  SELECT *, 'WARC/1.0' || chr(13) || chr(10) || 'WARC-Type: response' || chr(13) || chr(10) || 'WARC-Target-URI: ' || url
            || chr(13) || chr(10) || 'Content-Length: ' AS head, chr(13) || chr(10) || chr(13) || chr(10) AS gap
  FROM r),
b AS (
  SELECT page_id, h, head || strlen(html) || gap || html || gap AS body,
         head || strlen('~' || substr(html, 2)) || gap || '~' || substr(html, 2) || gap AS bad FROM p),
d AS (
  SELECT page_id, h, strlen(body) AS length, sha256(body) AS first_digest,
         CASE WHEN h % 97 = 1 THEN sha256(bad) WHEN h % 97 <> 2 THEN sha256(body) END AS second_digest FROM b),
a AS (SELECT *, (h * CAST(ceil((SELECT sum(length) FROM d) / {ARCHIVE_BYTES}.0) AS BIGINT)) // 4294967296 AS archive FROM d),
o AS (
  SELECT *, CAST(coalesce(sum(length) OVER (PARTITION BY archive ORDER BY h, page_id, length, first_digest
                                            ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS "offset"
  FROM a)
SELECT archive, "offset", page_id, length, CASE WHEN second_digest IS NULL THEN 'missing' ELSE 'changed' END AS status,
       first_digest, second_digest
FROM o WHERE first_digest IS DISTINCT FROM second_digest
"""
