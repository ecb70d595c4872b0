"""Near duplicates by SimHash: pigeonhole blocks, then a check of the Hamming distance.

A fingerprint is cut into five blocks. Two fingerprints that differ in at most two bits agree in at least
three blocks, so each is listed under its ten choices of three blocks (38 or 39 bits each) and candidates
are joined on those. With that many bits a listing holds few unrelated fingerprints even among billions.

A listing that still holds many, as with thousands of variants of one text, is not paired up. There each
fingerprint is listed again under every way of masking two of its remaining bits; those that share such an
entry differ in these two bits only, at most four per entry. That is linear in the fingerprints and misses
no link.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.joins import lookup_table
from .common import store, text_of

SHINGLE = 3
SEED = 42
DISTANCE = 2
BLOCKS = (13, 13, 13, 13, 12)
#: Listings of more fingerprints than this are split by masks instead of paired up.
PAIR_LIMIT = 128


# Fingerprints -------------------------------------------------------------------------------------------


def fingerprint(text: str) -> int:
    """The 64-bit SimHash of a text, as a signed number; 0 for a text without words."""
    words = text.encode("utf-8", "replace").lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    if len(words) < SHINGLE:
        hashes = [xxhash.xxh64_intdigest(joined, SEED)]
    else:
        lengths = np.fromiter(map(len, words), np.int64, len(words))
        ends = np.cumsum(lengths + 1) - 1
        starts = (ends - lengths)[: 1 - SHINGLE].tolist()
        digest = xxhash.xxh64_intdigest
        hashes = [digest(joined[a:b], SEED) for a, b in zip(starts, ends[SHINGLE - 1 :].tolist())]
    bits = np.zeros(64, dtype=np.int64)
    for at in range(0, len(hashes), 65536):  # bounded memory for the longest texts
        part = np.array(hashes[at : at + 65536], dtype=">u8").view(np.uint8).reshape(-1, 8)
        bits += np.unpackbits(part, axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * bits > len(hashes)).tobytes(), "big", signed=True)


def fingerprints(docs: DataFrame) -> DataFrame:
    """doc_id and fingerprint (long) of each row."""

    @F.pandas_udf("long")
    def hashed(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            yield pd.Series([fingerprint(t) for t in texts], dtype="int64")

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), hashed(text_of()).alias("fingerprint"))


def as_hex(column: str) -> Column:
    return F.lower(F.lpad(F.hex(column), 16, "0"))


# Links --------------------------------------------------------------------------------------------------


def _choices() -> list[int]:
    """The bits kept by each choice of three blocks, as signed 64-bit masks."""
    low, masks = 0, []
    for width in BLOCKS:
        masks.append(((1 << width) - 1) << low)
        low += width
    kept = [sum(masks[i] for i in chosen) for chosen in combinations(range(len(BLOCKS)), len(BLOCKS) - DISTANCE)]
    return [_signed(m) for m in kept]


def _signed(value: int) -> int:
    return value - (1 << 64) if value >= 1 << 63 else value


def links(distinct: DataFrame, pair_limit: int = PAIR_LIMIT) -> DataFrame:
    """Pairs (a, b), a < b, that connect the same fingerprints as all pairs within the distance do.

    From listings up to `pair_limit` come all their close pairs; from larger ones, for each set of at most
    four that differ in the same two bits, the pairs of its smallest member with the others.
    """
    masks = _choices()
    entries = F.array(
        *[F.struct(F.lit(i).alias("choice"), F.col("fingerprint").bitwiseAND(F.lit(m)).alias("block")) for i, m in enumerate(masks)]
    )
    listed = distinct.select("fingerprint", F.explode(entries).alias("_entry")).select("fingerprint", "_entry.*")
    keys = ["choice", "block"]
    counts = lookup_table(listed, keys, F.count(F.lit(1)).alias("members")).where("members > 1")
    shared = store(listed.join(counts, keys), "blocks")

    few = shared.where(F.col("members") <= pair_limit)
    left = few.select(*keys, F.col("fingerprint").alias("a"))
    right = few.select(*keys, F.col("fingerprint").alias("b"))
    apart = F.bit_count(F.col("a").bitwiseXOR(F.col("b")))
    paired = left.join(right, keys).where((F.col("a") < F.col("b")) & (apart <= DISTANCE)).select("a", "b")

    free = [",".join(str(bit) for bit in range(64) if not (mask >> bit) & 1) for mask in masks]
    of_choice = " ".join(f"WHEN {choice} THEN array({bits})" for choice, bits in enumerate(free))
    pairs = "transform(_free, i -> transform(filter(_free, j -> j > i), j -> ~(shiftleft(1L, i) | shiftleft(1L, j))))"
    many = shared.where(F.col("members") > pair_limit).withColumn("_free", F.expr(f"CASE choice {of_choice} END"))
    many = many.withColumn("_cut", F.explode(F.flatten(F.expr(pairs))))
    entry = many.groupBy("choice", "_cut", F.col("fingerprint").bitwiseAND(F.col("_cut")).alias("_rest"))
    sets = entry.agg(F.collect_set("fingerprint").alias("members")).where(F.size("members") > 1)
    stars = sets.select(
        F.array_min("members").alias("a"), F.explode("members").alias("b")
    ).where("a < b")
    return paired.union(stars).distinct()


# Components ---------------------------------------------------------------------------------------------


def _state(edges: DataFrame):
    return edges.agg(
        F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(20,0)"))
    ).first()


def components(edges: DataFrame) -> DataFrame:
    """(node, label) for every node of an edge (a, b): the smallest node it is connected with.

    Alternates the two star operations (Kiveris et al. 2014) until nothing changes, which takes a number of
    rounds about the logarithm of the longest chain. A round is stored; the smallest neighbour of a node is
    an aggregate, and the join that spreads it splits where a node has very many neighbours.
    """
    edges = store(edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a <> b").distinct(), "edges")
    before = None
    while (now := _state(edges)) != before:
        before = now
        both = edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = lookup_table(both, ["a"], F.min("b").alias("_least")).withColumn("_least", F.least("a", "_least"))
        large = both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("_least").alias("b"))
        large = store(large.where("a <> b").distinct(), "large")
        least = lookup_table(large, ["a"], F.min("b").alias("_least"))
        joined = large.join(least, "a")
        small = joined.select(F.col("b").alias("a"), F.col("_least").alias("b")).union(joined.select("a", F.col("_least").alias("b")))
        edges = store(small.where("a <> b").distinct(), "edges")
    nodes = edges.select(F.col("a").alias("node"), F.col("b").alias("label"))
    return nodes.union(edges.select(F.col("b").alias("node"), F.col("b").alias("label")).distinct())


# The operator -------------------------------------------------------------------------------------------


def find_near_duplicates(docs: DataFrame, pair_limit: int = PAIR_LIMIT) -> DataFrame:
    """A row per document: doc_id, fingerprint (long), component_id.

    Documents whose fingerprints differ in at most two bits are linked; component_id is the smallest doc_id
    reachable over links. Texts without words have fingerprint 0 and are linked like any other. A NULL text
    counts as empty. A NULL doc_id links as usual and never names a component that has another id.
    """
    rows = store(fingerprints(docs), "fingerprints")
    distinct = store(rows.groupBy("fingerprint").agg(F.min("doc_id").alias("first_id")), "distinct")
    labels = store(components(links(distinct, pair_limit)), "labels")
    placed = labels.join(distinct, labels["node"] == distinct["fingerprint"]).select("node", "label", "first_id")
    named = placed.join(lookup_table(placed, ["label"], F.min("first_id").alias("component_id")), "label")
    all_named = distinct.join(named.select(F.col("node").alias("fingerprint"), "component_id"), "fingerprint", "left")
    table = lookup_table(
        all_named.select("fingerprint", F.coalesce("component_id", "first_id").alias("component_id")),
        ["fingerprint"],
        F.min("component_id").alias("component_id"),
    )
    return rows.join(table, "fingerprint").select("doc_id", "fingerprint", "component_id")


def result(docs: DataFrame) -> DataFrame:
    found = find_near_duplicates(docs)
    return found.select("doc_id", as_hex("fingerprint").alias("fingerprint"), "component_id")
