"""Exact duplicates by a minimal perfect hash over the distinct digests seen before.

The digests of earlier documents are split by hash into buckets of about a thousand. Each bucket gets a
minimal perfect hash: a digest that meets no other at its place in a level's bit set is settled there, the
rest go on to the next level (Limasset et al. 2017); its slot is the number of bits set before its own. A
slot holds the full digest and the locator of the document that stays. A digest that comes in later is
looked up in one probe, and its bytes are compared with the slot's: if equal it repeats a known text, if
not it is new and is grouped among the new ones alone.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.joins import lookup_table
from .common import SPACE, store, text_of

DIGEST_BYTES = 32
#: Digests in a bucket, on average.
BUCKET = 1024
#: Places in a level's bit set for each digest that reaches it.
GAMMA = 2

CLASS_SCHEMA = "digest binary, keep_id long, group_size long"
INDEX_SCHEMA = "bucket long, sizes array<int>, bits binary, digests binary, winners array<long>, counts array<long>"


def normalised(text: Column) -> Column:
    return F.regexp_replace(text, SPACE, " ")


def digests(docs: DataFrame) -> DataFrame:
    """doc_id and the SHA-256 of the normalised text; a NULL text counts as empty."""
    return docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.unhex(F.sha2(normalised(text_of()), 256)).alias("digest")
    )


def distinct(rows: DataFrame) -> DataFrame:
    """A row per digest: the smallest doc_id and the number of documents. Counts combine before the shuffle."""
    return rows.groupBy("digest").agg(F.min("doc_id").alias("keep_id"), F.count(F.lit(1)).alias("group_size"))


# The perfect hash of one bucket ------------------------------------------------------------------------


def _words(packed: bytes) -> np.ndarray:
    return np.frombuffer(packed, dtype="<u8").reshape(-1, DIGEST_BYTES // 8)


def _place(words: np.ndarray, level: int, size: int) -> np.ndarray:
    """Where each digest falls in a level: the digest's words, mixed with the level's number."""
    factor = np.uint64((2 * level + 1) * 0x9E3779B97F4A7C15 % (1 << 64))
    mixed = words[:, level % 4] * factor + words[:, (level + 1) % 4]
    mixed ^= mixed >> np.uint64(32)
    mixed *= np.uint64(0xD6E8FEB86659FD93)
    mixed ^= mixed >> np.uint64(29)
    return (mixed % np.uint64(size)).astype(np.int64)


def build_hash(packed: bytes) -> tuple[list[int], bytes, np.ndarray]:
    """(level sizes, their bits one after another, the slot of each digest). Digests must be distinct."""
    words = _words(packed)
    left, sizes, levels, at = np.arange(len(words)), [], [], []
    where = np.empty(len(words), dtype=np.int64)
    base = 0
    while len(left):
        size = max(8, GAMMA * len(left))
        place = _place(words[left], len(sizes), size)
        alone = np.bincount(place, minlength=size) == 1
        settled = alone[place]
        where[left[settled]] = base + place[settled]
        sizes.append(size)
        levels.append(alone)
        base += size
        left = left[~settled]
        at.append(len(left))
    bits = np.concatenate(levels) if levels else np.zeros(0, bool)
    slots = np.cumsum(bits)[where] - 1 if len(words) else where
    return sizes, np.packbits(bits).tobytes(), slots


def find_slots(packed: bytes, sizes: list[int], bits: bytes) -> np.ndarray:
    """The only slot each digest can have; -1 where no level takes it."""
    words = _words(packed)
    total = int(sum(sizes))
    flags = np.unpackbits(np.frombuffer(bits, np.uint8), count=total).astype(bool)
    rank = np.cumsum(flags) - 1
    slots = np.full(len(words), -1, dtype=np.int64)
    left, base = np.arange(len(words)), 0
    for level, size in enumerate(sizes):
        place = base + _place(words[left], level, size)
        hit = flags[place]
        slots[left[hit]] = rank[place[hit]]
        left = left[~hit]
        base += size
        if not len(left):
            break
    return slots


def _build_bucket(rows: pd.DataFrame) -> pd.DataFrame:
    packed = b"".join(rows["digest"])
    sizes, bits, slots = build_hash(packed)
    order = np.argsort(slots)
    winners = [None if pd.isna(x) else int(x) for x in rows["keep_id"].iloc[order]]
    held = b"".join(rows["digest"].iloc[order])
    counts = [int(x) for x in rows["group_size"].iloc[order]]
    return pd.DataFrame(
        {
            "bucket": [rows["bucket"].iloc[0]], "sizes": [sizes], "bits": [bits], "digests": [held],
            "winners": [winners], "counts": [counts],
        }
    )


def _smaller(a, b):
    if a is None or pd.isna(a):
        return None if b is None or pd.isna(b) else int(b)
    return int(a) if b is None or pd.isna(b) else min(int(a), int(b))


def _look_up(coming: pd.DataFrame, index: pd.DataFrame) -> pd.DataFrame:
    """The classes of one bucket: every slot with what came in for it, then the digests that are new."""
    if len(index) == 0:
        return coming[["digest", "keep_id", "group_size"]]
    entry = index.iloc[0]
    held, winners, counts = bytes(entry["digests"]), list(entry["winners"]), list(entry["counts"])
    new = []
    if len(coming):
        slots = find_slots(b"".join(coming["digest"]), list(entry["sizes"]), bytes(entry["bits"]))
        for digest, keep, size, slot in zip(coming["digest"], coming["keep_id"], coming["group_size"], slots):
            if slot >= 0 and held[slot * DIGEST_BYTES : (slot + 1) * DIGEST_BYTES] == bytes(digest):
                winners[slot] = _smaller(winners[slot], keep)
                counts[slot] += int(size)
            else:
                new.append((digest, _smaller(keep, None), int(size)))
    rows = [
        (held[i * DIGEST_BYTES : (i + 1) * DIGEST_BYTES], _smaller(winners[i], None), int(counts[i]))
        for i in range(len(winners))
    ]
    out = pd.DataFrame(rows + new, columns=["digest", "keep_id", "group_size"])
    return out.astype({"keep_id": "Int64", "group_size": "int64"})


# The operator -------------------------------------------------------------------------------------------


def build_index(history: DataFrame, buckets: int) -> DataFrame:
    """The perfect hash over a table of distinct digests (digest, keep_id, group_size), a row per bucket."""
    keyed = history.withColumn("bucket", _bucket(buckets))
    return keyed.groupBy("bucket").applyInPandas(_build_bucket, INDEX_SCHEMA)


def _bucket(buckets: int) -> Column:
    return F.pmod(F.xxhash64("digest"), F.lit(buckets).cast("long"))


def merge(coming: DataFrame, index: DataFrame, buckets: int) -> DataFrame:
    """The classes of everything in the index and everything that comes in.

    `coming` has a row per distinct digest. Both are dealt by bucket; a bucket holds distinct digests only,
    about `BUCKET` of either side, however often a text occurs.
    """
    left = coming.withColumn("bucket", _bucket(buckets)).groupBy("bucket")
    return left.cogroup(index.groupBy("bucket")).applyInPandas(_look_up, CLASS_SCHEMA)


def find_duplicates(docs: DataFrame, history: DataFrame | None = None) -> DataFrame:
    """A row per document: doc_id, keep_id, group_size, kept, digest.

    `history` holds documents that came before; without one, those up to the middle doc_id count as such. The
    result covers the documents of both. Texts are equal if identical with each run of white space as one
    space, NULL as empty. keep_id is the smallest doc_id of equal texts; NULL ids count only if there is no
    other. Rows that repeat both a text and its smallest doc_id are all reported as kept, as nothing tells
    them apart; `drop_duplicates` leaves one of them. Other columns play no part.
    """
    if history is None:
        rows = store(digests(docs), "digests")
        ends = rows.agg(F.min("doc_id").alias("low"), F.max("doc_id").alias("high")).first()
        middle = (ends["low"] + ends["high"]) // 2 if ends["low"] is not None else 0
        before = F.coalesce(F.col("doc_id") <= F.lit(middle), F.lit(False))
        old, new = rows.where(before), rows.where(~before)
    else:
        old, new = store(digests(history), "digests"), store(digests(docs), "digests")
        rows = old.unionByName(new)
    known = store(distinct(old), "known")
    buckets = max(1, -(-known.count() // BUCKET))
    index = store(build_index(known, buckets), "index")
    classes = merge(distinct(new), index, buckets)
    table = lookup_table(classes, ["digest"], F.min("keep_id").alias("keep_id"), F.sum("group_size").alias("group_size"))
    kept = F.coalesce(F.col("doc_id") == F.col("keep_id"), F.col("keep_id").isNull())
    return rows.join(table, "digest").select("doc_id", "keep_id", "group_size", kept.alias("kept"), "digest")


def drop_duplicates(docs: DataFrame) -> DataFrame:
    """The documents whose text no document with a smaller doc_id has, with all their columns."""
    keys = ["_llm_digest", "_llm_id"]
    found = find_duplicates(docs).where("kept").select(F.col("digest").alias(keys[0]), _id_key().alias(keys[1]))
    keyed = docs.select("*", F.unhex(F.sha2(normalised(text_of()), 256)).alias(keys[0]), _id_key().alias(keys[1]))
    return keyed.join(found.distinct(), keys, "left_semi").dropDuplicates(keys).select(*docs.columns)


def _id_key() -> Column:
    return F.coalesce(F.col("doc_id").cast("string"), F.lit(""))


def result(docs: DataFrame) -> DataFrame:
    found = find_duplicates(docs)
    return found.select("doc_id", "keep_id", "group_size", "kept", F.lower(F.hex("digest")).alias("text_sha256"))
