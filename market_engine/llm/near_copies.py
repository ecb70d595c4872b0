"""Near copies by SimHash, for filtering: fingerprints of 512 bits, shared blocks, Hamming distance, Jaccard.

`simhash` links fingerprints of 64 bits within two bits, which texts reach only if they are almost equal. Texts that
share four fifths of their shingles differ in about 15 % of the bits. So here a fingerprint has 512 bits in 64 blocks,
and a text is listed under 256 choices of three blocks; texts that share one are compared bit by bit, and what is
close there is compared by its shingles. Most pairs that differ in 15 % of the bits share a choice, nearly all that differ
in 10 %; the README has the recall measured.

The texts of a listing are compared in place, next to each other, and it gives each text's closest pairs only. In a large
listing, as variants of a text or a passage that many texts share make it, all are compared with a number of them (pivots),
the square root of their own number. Texts close to a pivot are linked to
it; the others are compared among those with the same nearest pivot, and among those with the same second nearest
one, again with pivots where they are many. So this work in a listing of n texts grows with the power 1.5 of n and
not with its pairs.

The closest pairs are compared by shingles first and make groups. Then comes the rest, with nothing left out: all close
pairs whose texts are not in one group yet. A listing whose texts are all in one group takes no further part; in a large
one the texts outside its largest group are compared with all others, bit by bit in tiles. A pair within a group can link
nothing new. Nor can one that is too unlike by the numbers of shingles in each bucket of their hashes: of no bucket can two
texts share more than the smaller number. So texts are compared only for pairs that are near copies or little less.
"""

from __future__ import annotations

import random
from collections.abc import Callable, Iterator, Sequence
from itertools import accumulate

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..operators.joins import lookup_table
from .common import store, text_of
from .simhash import components

SHINGLE = 5
SIMILARITY = 0.8
BLOCKS, BLOCKS_OF_CHOICE, CHOICES = 64, 3, 256
#: Bits that may differ for shingles to be compared; at the similarity above it is 78 on average, with a spread of 8.
DISTANCE = 128
#: Listings of more texts than this are compared with pivots.
PAIR_LIMIT = 16
#: Texts that one task compares together, about; a larger listing is dealt by a further block, and so is held in no task.
TOGETHER = 1 << 16
#: Texts on either side of a tile.
TILE = 2048
#: Buckets of the hashes of shingles, each with its number in a byte; a full byte says nothing.
BUCKETS, FULL = 256, 255

_rng = random.Random(1)
#: The blocks of each choice, fixed by the seed.
_CHOSEN = [sorted(_rng.sample(range(BLOCKS), BLOCKS_OF_CHOICE)) for _ in range(CHOICES)]
_PARTS = tuple(f"f{i}" for i in range(BLOCKS // 8))
# Fixed value of splitmix64, as the other two below.
_STEP = np.uint64(0x9E3779B97F4A7C15)


# Fingerprints -------------------------------------------------------------------------------------------


def shingles(text: str, size: int = SHINGLE) -> set[bytes]:
    """The different runs of so many words, in lower case; of a shorter text all of its words."""
    words = text.encode("utf-8", "replace").lower().split()
    if len(words) < size:
        return {b" ".join(words)} if words else set()
    joined = b" ".join(words)
    ends = list(accumulate(map((1).__add__, map(len, words))))
    starts = [0, *ends[: len(words) - size]]
    return {joined[a : b - 1] for a, b in zip(starts, ends[size - 1 :])}


def similar_sizes(left: np.ndarray, right: np.ndarray, similarity: float) -> np.ndarray:
    """Whether sets of so many shingles can be that similar: the smaller one may be all they share."""
    return np.minimum(left, right) / np.maximum(left, right) >= similarity


def hashes_of(found: set[bytes]) -> np.ndarray:
    return np.fromiter(map(xxhash.xxh3_64_intdigest, found), np.uint64, len(found))


def bucket_counts(hashes: np.ndarray) -> np.ndarray:
    """How many of the hashes fall into each bucket, `FULL` also for more."""
    found = np.bincount((hashes % np.uint64(BUCKETS)).astype(np.int64), minlength=BUCKETS)
    return np.minimum(found, FULL).astype(np.uint8)


def fingerprint(hashes: np.ndarray) -> np.ndarray:
    """The blocks, each a byte. A shingle's hash is mixed (splitmix64) into the 64 bits of each part."""
    bits = np.zeros(8 * BLOCKS, dtype=np.int64)
    for at in range(0, len(hashes), 16384):  # bounded memory for the longest texts
        part = hashes[at : at + 16384, None] + _STEP * np.arange(1, len(_PARTS) + 1, dtype=np.uint64)
        part = (part ^ (part >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        part = (part ^ (part >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        part ^= part >> np.uint64(31)
        bits += np.unpackbits(part.astype("<u8").view(np.uint8), axis=1).sum(axis=0, dtype=np.int64)
    return np.packbits(2 * bits > len(hashes))


def _prints(docs: DataFrame) -> DataFrame:
    """id (a hash of the text), the fingerprint in eight numbers, how many shingles and their `bucket_counts`, a row per text with words."""
    columns = [*_PARTS, "shingles"]

    @F.pandas_udf(", ".join(f"{c} bigint" for c in columns) + ", counts binary")
    def printed(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for texts in batches:
            found = [hashes_of(shingles(text)) for text in texts]
            rows = [[*fingerprint(h).view("<i8").tolist(), len(h)] if len(h) else [None] * len(columns) for h in found]
            counts = [bucket_counts(h).tobytes() if len(h) else None for h in found]
            yield pd.DataFrame(rows, columns=columns, dtype="Int64").assign(counts=pd.Series(counts, dtype=object))

    found = docs.select(F.xxhash64(text_of()).alias("id"), printed(text_of()).alias("_p")).select("id", "_p.*")
    return found.where(f"{_PARTS[0]} IS NOT NULL").groupBy("id").agg(*[F.min(c).alias(c) for c in [*columns, "counts"]])


def _listings() -> Column:
    """The numbers of a fingerprint's listings: the choice and its three blocks."""
    parts = [F.shiftrightunsigned(_PARTS[at // 8], 8 * (at % 8)).bitwiseAND(255) for at in range(BLOCKS)]
    choices = F.array(*[F.struct(F.lit(n).cast("long").alias("n"), F.array(*map(F.lit, c)).alias("at")) for n, c in enumerate(_CHOSEN)])

    def numbers(blocks: Column) -> Column:
        return F.transform(
            choices, lambda c: F.aggregate(c["at"], c["n"], lambda number, at: number * 256 + F.get(blocks, at))
        )

    # The blocks are worked out once for all choices.
    return F.get(F.transform(F.array(F.array(*parts)), numbers), 0)


# Candidates ---------------------------------------------------------------------------------------------


def differing_bits(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """The number of differing bits of each row on the left with each on the right."""
    bits = np.zeros((len(left), len(right)), np.int32)
    for part in range(left.shape[1]):
        bits += np.bitwise_count(left[:, None, part] ^ right[None, :, part])
    return bits


def differing_bits_by_row(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """The number of differing bits of each row on the left with the same row on the right."""
    return np.bitwise_count(left ^ right).sum(axis=1, dtype=np.int64)


def may_be_similar(
    left: np.ndarray, right: np.ndarray, left_sizes: np.ndarray, right_sizes: np.ndarray, similarity: float
) -> np.ndarray:
    """Whether sets of so many shingles with these `bucket_counts`, row by row, can be that similar."""
    shared = np.minimum(left, right).sum(axis=1, dtype=np.int64)
    unknown = (left == FULL).any(axis=1) & (right == FULL).any(axis=1)
    return unknown | (shared / np.maximum(left_sizes + right_sizes - shared, 1) >= similarity)


def close_pairs(ids: np.ndarray, prints: np.ndarray) -> set[tuple[int, int]]:
    """Pairs (a, b), a < b, of texts with few differing bits, by pivots; `prints` has a row of numbers per text."""
    found: set[tuple[int, int]] = set()

    def differing(rows: np.ndarray, others: np.ndarray) -> np.ndarray:
        return differing_bits(prints[rows], prints[others])

    def link(rows: np.ndarray, others: np.ndarray) -> None:
        for a, b in zip(ids[rows].tolist(), ids[others].tolist()):
            if a != b:
                found.add((min(a, b), max(a, b)))

    todo = [np.argsort(ids, kind="stable")]
    while todo:
        rows = todo.pop()
        if len(rows) <= 64:
            a, b = np.nonzero(np.triu(differing(rows, rows) <= DISTANCE, 1))
            link(rows[a], rows[b])
            continue
        count = int(len(rows) ** 0.5)
        # The order of the ids, which are hashes, is as good as chance.
        pivots, others = rows[:count], rows[count:]
        todo.append(pivots)
        nearest, second, least = (np.empty(len(others), np.int64) for _ in range(3))
        for at in range(0, len(others), 8192):
            bits = differing(others[at : at + 8192], pivots)
            two = np.argpartition(bits, 1, axis=1)[:, :2]
            here = np.take_along_axis(bits, two, axis=1)
            swap = here[:, 0] > here[:, 1]
            two[swap] = two[swap][:, ::-1]
            part = slice(at, at + len(two))
            nearest[part], second[part], least[part] = two[:, 0], two[:, 1], here.min(axis=1)
        close = least <= DISTANCE
        link(others[close], pivots[nearest[close]])
        rest = others[~close]
        for cells in (nearest[~close], second[~close]):
            order = np.argsort(cells, kind="stable")
            for cell in np.split(rest[order], np.flatnonzero(np.diff(cells[order])) + 1):
                if len(cell) > 1:
                    todo.append(cell)
    return found


def _nearest_of_crowded(many: DataFrame, similarity: float) -> DataFrame:
    """Close pairs (a, b, bits) within each listing, from rows (listing, id, members, shingles, the fingerprint).

    Of those that pivots find the closest pair of each text with an earlier and with a later one, so that a listing
    gives no more than twice its rows.
    """
    # A listing beyond what a task holds is dealt by one of the other blocks.
    block = F.shiftrightunsigned(_PARTS[-1], 56)
    dealt = many.withColumn("part", F.when(F.col("members") > TOGETHER, block).otherwise(F.lit(-1).cast("long")))
    rows = dealt.select("listing", "part", "id", "shingles", *_PARTS)

    def pairs(rows: pd.DataFrame) -> set[tuple[int, ...]]:
        ids, prints = rows["id"].to_numpy(), _numbers(rows)
        return nearest_pairs(ids, prints, rows["shingles"].to_numpy(), similarity)

    return _pairs_by(rows, ["listing", "part"], pairs, ["a", "b", "bits"])


def nearest_pairs(ids: np.ndarray, prints: np.ndarray, sizes: np.ndarray, similarity: float) -> set[tuple[int, ...]]:
    """(a, b, bits) of `close_pairs` of similar size: the closest of each text with a later and with an earlier one."""
    found = np.array(sorted(close_pairs(ids, prints)), dtype=np.int64).reshape(-1, 2)
    order = np.argsort(ids, kind="stable")
    left, right = (order[np.searchsorted(ids[order], found[:, side])] for side in (0, 1))
    similar = similar_sizes(sizes[left], sizes[right], similarity)
    found, left, right = found[similar], left[similar], right[similar]
    bits = differing_bits_by_row(prints[left], prints[right])
    kept: set[tuple[int, ...]] = set()
    for side in (0, 1):
        closest = np.lexsort((found[:, 1 - side], bits, found[:, side]))
        first = closest[np.unique(found[closest, side], return_index=True)[1]]
        kept.update((a, b, n) for (a, b), n in zip(found[first].tolist(), bits[first].tolist()))
    return kept


def _pairs_by(
    rows: DataFrame, keys: list[str], pairs: Callable[[pd.DataFrame], set[tuple[int, ...]]], columns: Sequence[str] = ("a", "b")
) -> DataFrame:
    """The pairs (a, b), with further columns, that a function finds among the rows of each key."""

    def found(rows: pd.DataFrame) -> Iterator[pd.DataFrame]:
        key = rows[keys].to_numpy()
        ends = np.flatnonzero((key[1:] != key[:-1]).any(axis=1)) + 1
        for a, b in zip([0, *ends], [*ends, len(rows)]):
            yield pd.DataFrame(sorted(pairs(rows[a:b])), columns=list(columns), dtype="int64")

    return _by_whole_keys(rows, keys, keys, found, columns)


def _by_whole_keys(
    rows: DataFrame,
    keys: list[str],
    order: list[str],
    found: Callable[[pd.DataFrame], Iterator[pd.DataFrame]],
    columns: Sequence[str],
) -> DataFrame:
    """What a function makes of the rows in that order, which begins with the keys; it gets all rows of a key at once."""
    sorted_rows = rows.repartition(*keys).sortWithinPartitions(*order)

    def compared(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: pd.DataFrame | None = None
        for batch in batches:
            rows = batch if held is None else pd.concat([held, batch], ignore_index=True)
            last = (rows[keys] == rows[keys].iloc[-1]).all(axis=1)
            held = rows[last].reset_index(drop=True)
            if not last.all():
                yield from found(rows[~last])
        if held is not None:
            yield from found(held)

    return sorted_rows.mapInPandas(compared, ", ".join(f"{c} long" for c in columns))


def shared_listings(prints: DataFrame) -> DataFrame:
    """(id, listing, members) of the listings of several texts.

    Counting in a window takes one shuffle of the listings. None of them can be hot beside the others: a text has one
    row in a listing, of `CHOICES` in all.
    """
    listed = prints.select("id", F.explode(_listings()).alias("listing"))
    members = F.count(F.lit(1)).over(Window.partitionBy("listing"))
    return store(listed.withColumn("members", members).where("members > 1"), "shared-listings")


def close_in_listings(
    listings: np.ndarray, prints: np.ndarray, sizes: np.ndarray, similarity: float, groups: np.ndarray | None = None
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row numbers (left, right) of close pairs of similar size within each listing, with their bits.

    The rows stand in the order of the listings. With `groups` only pairs between different ones count.
    """
    found = [(np.empty(0, np.int64),) * 3]
    for step in range(1, len(listings)):
        left = np.flatnonzero(listings[step:] == listings[:-step])
        if not len(left):
            break
        right = left + step
        kept = similar_sizes(sizes[left], sizes[right], similarity)
        if groups is not None:
            kept &= groups[left] != groups[right]
        left, right = left[kept], right[kept]
        bits = differing_bits_by_row(prints[left], prints[right])
        near = bits <= DISTANCE
        found.append((left[near], right[near], bits[near]))
    left, right, bits = (np.concatenate(part) for part in zip(*found))
    return left, right, bits


def closest_in_listings(
    listings: np.ndarray, prints: np.ndarray, sizes: np.ndarray, similarity: float
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of `close_in_listings` the closest pair of each row with a later and with an earlier one of its listing."""
    left, right, bits = close_in_listings(listings, prints, sizes, similarity)
    kept = np.zeros(len(left), bool)
    for row, other in ((left, right), (right, left)):
        closest = np.lexsort((other, bits, row))
        kept[closest[np.unique(row[closest], return_index=True)[1]]] = True
    return left[kept], right[kept], bits[kept]


def _of_few(prints: DataFrame, crowd: DataFrame, pair_limit: int, similarity: float) -> DataFrame:
    """(listing, a, b, bits), a < b: the closest pairs of each text in each listing of up to `pair_limit`.

    Texts are pairs if they differ in few bits and their numbers of shingles are not too far apart for the similarity.
    """
    rows = crowd.where(F.col("members") <= pair_limit).join(prints, "id").select("listing", "id", "shingles", *_PARTS)
    columns = ["listing", "a", "b", "bits"]

    def found(rows: pd.DataFrame) -> Iterator[pd.DataFrame]:
        listings, ids, numbers = rows["listing"].to_numpy(), rows["id"].to_numpy(), _numbers(rows)
        left, right, bits = closest_in_listings(listings, numbers, rows["shingles"].to_numpy(), similarity)
        yield pd.DataFrame({"listing": listings[left], "a": ids[left], "b": ids[right], "bits": bits}, columns=columns)

    return _by_whole_keys(rows, ["listing"], ["listing", "id"], found, columns)


def _numbers(rows: pd.DataFrame) -> np.ndarray:
    return rows[list(_PARTS)].to_numpy().view(np.uint64)


def _counts(rows: pd.DataFrame) -> np.ndarray:
    return np.frombuffer(b"".join(rows["counts"]), np.uint8).reshape(-1, BUCKETS)


def _by_chunks(left: np.ndarray, right: np.ndarray, check: Callable[[np.ndarray, np.ndarray], np.ndarray]) -> np.ndarray:
    """What a check says of all pairs of rows, with bounded memory."""
    parts = [check(left[at : at + 4096], right[at : at + 4096]) for at in range(0, len(left), 4096)]
    return np.concatenate([np.empty(0, bool), *parts])


def _of_many(prints: DataFrame, crowd: DataFrame, pair_limit: int, similarity: float) -> DataFrame:
    """Of larger listings such pairs that pivots find, the closest of each text in each listing."""
    many = crowd.where(F.col("members") > pair_limit).join(prints, "id")
    return _nearest_of_crowded(many, similarity)


def _nearest(pairs: DataFrame) -> DataFrame:
    """Of each text's pairs the closest with an earlier and the closest with a later text (by id)."""
    both = pairs.select("a", "b", "bits").union(pairs.select("b", "a", "bits")).toDF("x", "y", "bits")
    keys = ["x", F.col("x") < F.col("y")]
    best = both.groupBy(*keys).agg(F.min(F.struct("bits", "y")).alias("_best")).select("x", F.col("_best.y").alias("y"))
    return best.select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct()


def _grouped(rows: DataFrame, found: DataFrame, key: str, group: str) -> DataFrame:
    """The rows with the group of the text in the column `key`; a text without one is a group of its own."""
    names = found.select(F.col("node").alias(key), F.col("label").alias(group))
    return rows.join(names, key, "left").withColumn(group, F.coalesce(group, key))


def _rest(
    prints: DataFrame,
    crowd: DataFrame,
    close: DataFrame,
    nearest: DataFrame,
    found: DataFrame,
    pair_limit: int = PAIR_LIMIT,
    similarity: float = SIMILARITY,
) -> DataFrame:
    """All close pairs (a, b) not compared yet whose texts are not in one group and may be that similar.

    `found` names the groups, and `close` has the closest pairs in the small listings.
    """
    many = crowd.where(F.col("members") > pair_limit)
    new = _between(prints, close, found, similarity).unionByName(_across(prints, many, found, similarity))
    return new.distinct().join(nearest, ["a", "b"], "left_anti")


def _between(prints: DataFrame, close: DataFrame, found: DataFrame, similarity: float) -> DataFrame:
    """Close pairs of texts of different groups in each small listing.

    A text with a close pair in a listing stands in one of its closest pairs, so those name all texts that matter.
    """
    sides = close.groupBy("listing").agg(F.collect_set("a").alias("_a"), F.collect_set("b").alias("_b"))
    members = sides.select("listing", F.explode(F.array_union("_a", "_b")).alias("id"))
    listing = Window.partitionBy("listing")
    several = F.min("_group").over(listing) != F.max("_group").over(listing)
    grouped = _grouped(members, found, "id", "_group").withColumn("_several", several).where("_several")
    rows = grouped.join(prints, "id").select("listing", "id", "_group", "shingles", "counts", *_PARTS)

    def pairs(rows: pd.DataFrame) -> Iterator[pd.DataFrame]:
        listings, ids, sizes, groups = (rows[name].to_numpy() for name in ("listing", "id", "shingles", "_group"))
        left, right, _ = close_in_listings(listings, _numbers(rows), sizes, similarity, groups)
        counts = _counts(rows)
        kept = _by_chunks(left, right, lambda a, b: may_be_similar(counts[a], counts[b], sizes[a], sizes[b], similarity))
        left, right = left[kept], right[kept]
        yield pd.DataFrame({"a": ids[left], "b": ids[right]}).drop_duplicates()

    return _by_whole_keys(rows, ["listing"], ["listing", "id"], pairs, ["a", "b"])


def _across(prints: DataFrame, many: DataFrame, found: DataFrame, similarity: float) -> DataFrame:
    """Close pairs in each large listing of a text outside the listing's largest group with one of another group.

    The outsiders are dealt into columns and all texts into rows of tiles, so a task holds the texts of one tile only,
    and a listing whose texts are all in one group takes no further part.
    """
    grouped = _grouped(many, found, "id", "_group")
    counts = grouped.groupBy("listing", "_group").agg(F.count(F.lit(1)).alias("_n"))
    largest = counts.groupBy("listing").agg(
        F.max_by("_group", F.struct("_n", "_group")).alias("_largest"), (F.sum("_n") - F.max("_n")).alias("_outside")
    )
    open_listings = largest.where(F.col("_outside") > 0)
    rows = store(grouped.join(open_listings, "listing").join(prints, "id"), "open-listings")
    number = F.shiftrightunsigned(F.xxhash64("id"), 1)
    across = F.ceil(F.col("_outside") / TILE)
    down = F.ceil(F.col("members") / TILE)
    outside = F.col("_group") != F.col("_largest")
    columns = ["listing", "id", "_group", "shingles", "counts", *_PARTS]
    first = F.lit(0).cast("long")
    each_row, each_column = F.explode(F.sequence(first, down - 1)), F.explode(F.sequence(first, across - 1))
    left = rows.where(outside).select(
        F.pmod(number, across).alias("column"), each_row.alias("row"), F.lit(True).alias("left"), *columns
    )
    right = rows.select(each_column.alias("column"), F.pmod(number, down).alias("row"), F.lit(False).alias("left"), *columns)

    def pairs(rows: pd.DataFrame) -> set[tuple[int, int]]:
        sides = [rows[rows["left"]], rows[~rows["left"]]]
        prints, counts = [_numbers(side) for side in sides], [_counts(side) for side in sides]
        ids, groups, sizes = ([side[name].to_numpy() for side in sides] for name in ("id", "_group", "shingles"))
        found: set[tuple[int, int]] = set()
        for at in range(0, len(ids[0]), 256):  # bounded memory
            here = slice(at, at + 256)
            near = differing_bits(prints[0][here], prints[1]) <= DISTANCE
            near &= groups[0][here, None] != groups[1][None, :]
            a, b = np.nonzero(near)
            a += at
            kept = similar_sizes(sizes[0][a], sizes[1][b], similarity)
            a, b = a[kept], b[kept]
            kept = _by_chunks(
                a, b, lambda a, b: may_be_similar(counts[0][a], counts[1][b], sizes[0][a], sizes[1][b], similarity)
            )
            x, y = ids[0][a[kept]], ids[1][b[kept]]
            found.update(zip(np.minimum(x, y).tolist(), np.maximum(x, y).tolist()))
        return found

    return _pairs_by(left.unionByName(right), ["listing", "column", "row"], pairs)


def links(docs: DataFrame, pairs: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """The pairs whose shingles are that similar (Jaccard), from the whole texts."""

    @F.pandas_udf("double")
    def jaccard(a: pd.Series, b: pd.Series) -> pd.Series:
        values = []
        for x, y in zip(a, b):
            left, right = shingles(x), shingles(y)
            shared = len(left & right)
            values.append(shared / max(len(left) + len(right) - shared, 1))
        return pd.Series(values, dtype="float64")

    ids = pairs.select(F.col("a").alias("id")).union(pairs.select("b"))
    texts = docs.select(F.xxhash64(text_of()).alias("id"), text_of().alias("text"))
    texts = texts.join(lookup_table(ids, ["id"]), "id", "left_semi")
    texts = store(texts.groupBy("id").agg(F.min("text").alias("text")), "linked-texts")
    left, right = (texts.select(F.col("id").alias(n), F.col("text").alias(f"{n}_text")) for n in ("a", "b"))
    both = pairs.join(left, "a").join(right, "b")
    return both.where(jaccard("a_text", "b_text") >= similarity).select("a", "b")


# The operator -------------------------------------------------------------------------------------------


def groups(docs: DataFrame, pair_limit: int = PAIR_LIMIT) -> DataFrame:
    """id (a hash of the text) and group, for texts that have a near copy with another text."""
    prints = store(_prints(docs), "wide-fingerprints")
    crowd = shared_listings(prints)
    # Only the closest pairs are needed here, as the rest takes all pairs between groups.
    close = store(_of_few(prints, crowd, pair_limit, SIMILARITY), "close-pairs")
    nearest = store(_nearest(close.drop("listing").unionByName(_of_many(prints, crowd, pair_limit, SIMILARITY))), "nearest")
    found = store(components(links(docs, nearest)), "groups")
    rest = store(_rest(prints, crowd, close, nearest, found, pair_limit), "rest")
    more = store(links(docs, rest), "more-links")
    if not more.isEmpty():
        edges = found.select(F.col("node").alias("a"), F.col("label").alias("b")).unionByName(more)
        found = store(components(edges), "groups")
    return found.select(F.col("node").alias("id"), F.col("label").alias("group"))


def keep_one(docs: DataFrame, pair_limit: int = PAIR_LIMIT) -> DataFrame:
    """One document of each group of near copies, with all its columns.

    Near copies share at least `SIMILARITY` of their five-word shingles, equal texts all of them, and a group is what
    such pairs connect. The document with the smallest doc_id stays, NULL after all others; among several the one whose
    columns hash lowest. A NULL text counts as empty, and texts without words are near copies only of themselves.
    An empty table gives an empty one; other columns play no part but in ties.
    """
    found = groups(docs, pair_limit).select(F.col("id").alias("_llm_id"), F.col("group").alias("_llm_group"))
    hashed = F.xxhash64(*[F.col(c).cast("string") for c in docs.columns])
    # What stays is chosen on narrow rows; the texts are moved once, to the rows chosen. A text in no group is told apart
    # by its digest too, so that a chance hash loses nothing.
    narrow = docs.select(
        F.xxhash64(text_of()).alias("_llm_id"),
        hashed.alias("_llm_hash"),
        F.md5(text_of().cast("binary")).alias("_llm_digest"),
        F.col("doc_id").cast("long").alias("_llm_doc"),
    ).join(found, "_llm_id", "left")
    alone = F.when(F.col("_llm_group").isNull(), F.col("_llm_digest")).alias("_llm_alone")
    order = F.struct(F.col("_llm_doc").isNull(), "_llm_doc", "_llm_hash", "_llm_id", "_llm_digest").alias("_llm_first")
    first = narrow.groupBy(F.coalesce("_llm_group", "_llm_id").alias("_llm_key"), alone).agg(F.min(order).alias("_llm_first"))
    keys = ["_llm_id", "_llm_hash", "_llm_digest"]
    chosen = first.select(*[F.col(f"_llm_first.{k}").alias(k) for k in keys])
    keyed = docs.withColumns(
        {"_llm_id": F.xxhash64(text_of()), "_llm_hash": hashed, "_llm_digest": F.md5(text_of().cast("binary"))}
    )
    # Rows alike in all columns are one.
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy("_llm_hash"))
    return keyed.join(chosen, keys).withColumn("_llm_rank", rank).where("_llm_rank = 1").select(*docs.columns)
