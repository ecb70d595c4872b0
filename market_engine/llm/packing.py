"""Packing token sequences by patterns whose repeat counts come from non-negative least squares.

Documents longer than a sequence are cut into full pieces and one shorter first piece. The number of pieces of
each length is a histogram of at most 1024 entries, which is all the driver sees. Patterns are the sets of up
to three lengths that fill a sequence exactly. Non-negative least squares (Krell et al. 2021) finds how often
each pattern should be used so that the histogram is met; counts are rounded so that errors do not add up,
and cut where a length runs out. What is left over is packed by best fit, the longest first, on the
histogram as well. Pieces find their places by length and by their rank among those of the same length.
"""

from __future__ import annotations

import os
import zlib
from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import chunk_count, chunk_of, hash31, running_total, store, text_of
from .tokens import shared_encoder

CAPACITY = 1024
END_ID = 2
#: Rounds of the least squares; it stops earlier when little changes.
ROUNDS = 300

PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


# Pieces -------------------------------------------------------------------------------------------------


def cuts(tokens: int, capacity: int) -> list[tuple[int, int]]:
    """(start, length) of the pieces of a document: all full but the first."""
    first = tokens % capacity or min(tokens, capacity)
    starts = [0, *range(first, tokens, capacity)]
    return [(a, b - a) for a, b in zip(starts, [*starts[1:], tokens])]


def pieces(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, end_id: int = END_ID) -> DataFrame:
    """A row per piece of each document, the end id included; whole texts, NULL as empty."""
    end = np.array([end_id], dtype="<u4").tobytes()

    def encode(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        encoder = shared_encoder(tokenizer)
        for batch in batches:
            out = []
            for doc_id, text in zip(batch["doc_id"], batch["text"]):
                ids = encoder.ids(text) + end
                for i, (start, length) in enumerate(cuts(len(ids) // 4, capacity)):
                    out.append((doc_id, i, start, length, zlib.crc32(ids[4 * start : 4 * (start + length)])))
            frame = pd.DataFrame(out, columns=["doc_id", "piece", "start", "length", "ids_crc32"])
            yield frame.astype({"doc_id": "Int64"})

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_of().alias("text"))
    return rows.mapInPandas(encode, PIECES)


# The plan, made from the histogram ---------------------------------------------------------------------


def patterns(capacity: int, present: np.ndarray) -> np.ndarray:
    """All sets of two or three lengths that sum to the capacity; 0 stands for no third length."""
    pairs = np.arange(1, capacity // 2 + 1)
    two = np.stack([pairs, capacity - pairs, np.zeros_like(pairs)], axis=1)
    first, second = np.meshgrid(np.arange(1, capacity // 3 + 1), np.arange(1, capacity // 2 + 1), indexing="ij")
    third = capacity - first - second
    ok = (second >= first) & (third >= second)
    three = np.stack([first[ok], second[ok], third[ok]], axis=1)
    found = np.concatenate([two, three])
    known = present.copy()
    known[0] = True
    return found[known[found].all(axis=1)]


def fit_counts(histogram: np.ndarray, found: np.ndarray, rounds: int = ROUNDS) -> np.ndarray:
    """Repeat counts x >= 0 that bring the lengths used close to the histogram.

    Multiplicative updates for least squares with non-negative coefficients (Lee and Seung 2001).
    """
    size = len(histogram)
    target = histogram.astype(float)
    target[0] = 0

    def used(x):
        total = sum(np.bincount(found[:, i], weights=x, minlength=size) for i in range(found.shape[1]))
        total[0] = 0
        return total

    def back(values):
        return sum(values[found[:, i]] for i in range(found.shape[1]))

    if not len(found):
        return np.zeros(0)
    wish = back(target)
    each = np.maximum(used(np.ones(len(found))), 1)
    x = np.minimum.reduce([np.where(found[:, i] > 0, target[found[:, i]] / each[found[:, i]], np.inf) for i in range(3)])
    x = np.maximum(x, 1e-9)
    last = np.inf
    for i in range(rounds):
        x *= wish / np.maximum(back(used(x)), 1e-12)
        if i % 20 == 19:
            error = float(np.square(used(x) - target).sum())
            if error > 0.999 * last:
                break
            last = error
    return x


def round_counts(histogram: np.ndarray, found: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Whole counts near x that use no length more often than it occurs."""
    order = np.lexsort((found[:, 1], found[:, 0], found[:, 2])) if len(found) else np.zeros(0, dtype=int)
    running = np.floor(np.cumsum(x[order]) + 0.5)
    whole = np.zeros(len(found), dtype=np.int64)
    whole[order] = np.diff(running, prepend=0).astype(np.int64)
    left = histogram.astype(np.int64).copy()
    out = np.zeros(len(found), dtype=np.int64)
    for i in np.argsort(-whole, kind="stable"):
        if not whole[i]:
            break
        need: dict[int, int] = defaultdict(int)
        for length in found[i]:
            if length:
                need[int(length)] += 1
        n = min([int(whole[i]), *(left[length] // k for length, k in need.items())])
        if n > 0:
            out[i] = n
            for length, k in need.items():
                left[length] -= n * k
    return out


def best_fit(left: np.ndarray, capacity: int) -> list[tuple[tuple[int, ...], int]]:
    """Pack what is left, the longest first, each into the fullest sequences it fits: (lengths, repeats)."""
    rooms: dict[int, list[list]] = defaultdict(list)
    open_rooms = np.zeros(capacity + 1, dtype=bool)
    for length in range(capacity, 0, -1):
        n = int(left[length])
        while n:
            fitting = np.flatnonzero(open_rooms[length:])
            if len(fitting):
                room = int(fitting[0]) + length
                held, repeats = rooms[room].pop()
                if not rooms[room]:
                    open_rooms[room] = False
                take = min(n, repeats)
                if take < repeats:
                    rooms[room].append([held, repeats - take])
                    open_rooms[room] = True
            else:
                # As many copies in a sequence as fit; shorter lengths fill the rest.
                room, held, take = capacity, (), n // (capacity // length) or 1
            copies = min(room // length, max(1, n // take))
            rest = room - copies * length
            rooms[rest].append([(*held, *[length] * copies), take])
            open_rooms[rest] = rest > 0
            n -= copies * take
    return [(held, repeats) for found in rooms.values() for held, repeats in found]


@dataclass
class Plan:
    """Arrays by (length, first rank): pieces of the length from that rank on go to the sequences from `sequence` on."""

    keys: np.ndarray
    sequence: np.ndarray
    offset: np.ndarray
    sequences: int
    patterned: int

    def place(self, length: np.ndarray, rank: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        key = (length.astype(np.int64) << 48) | rank
        at = np.searchsorted(self.keys, key, side="right") - 1
        return self.sequence[at] + (key - self.keys[at]), self.offset[at]


def make_plan(histogram: np.ndarray, capacity: int = CAPACITY) -> Plan:
    """From the number of pieces of each length (index 0 unused) to places. Size is bounded by the capacity alone."""
    histogram = histogram.astype(np.int64)
    whole = histogram.copy()
    whole[capacity] = 0
    found = patterns(capacity, whole > 0)
    counts = round_counts(whole, found, fit_counts(whole, found))
    chosen = [(tuple(int(v) for v in found[i] if v), int(counts[i])) for i in np.flatnonzero(counts)]
    left = whole.copy()
    for lengths, repeats in chosen:
        for length in lengths:
            left[length] -= repeats
    full = [((capacity,), int(histogram[capacity]))] if histogram[capacity] else []
    taken = np.zeros(capacity + 1, dtype=np.int64)
    rows, base = [], 0
    for lengths, repeats in full + chosen + best_fit(left, capacity):
        offset = 0
        for length in lengths:
            rows.append(((length << 48) | int(taken[length]), base, offset))
            taken[length] += repeats
            offset += length
        base += repeats
    if not np.array_equal(taken[1:], histogram[1:]):
        raise AssertionError("the plan does not place every piece once")
    rows.sort()
    columns = np.array(rows, dtype=np.int64).reshape(-1, 3)
    patterned = sum(repeats for _, repeats in full + chosen)
    return Plan(columns[:, 0], columns[:, 1], columns[:, 2], base, patterned)


# The operator -------------------------------------------------------------------------------------------


def pack(
    docs: DataFrame, tokenizer: str | None = None, capacity: int = CAPACITY, end_id: int = END_ID
) -> DataFrame:
    """A row per piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset.

    Every document has at least its end id, so NULL and empty texts make one piece of one token. doc_id may be
    NULL or repeat; each row is packed on its own. Pieces alike in doc_id, piece and checksum are
    interchangeable. An empty table gives an empty result. Other columns play no part.
    """
    made = store(pieces(docs, tokenizer or default_tokenizer(), capacity, end_id), "pieces")
    histogram = np.zeros(capacity + 1, dtype=np.int64)
    total = 0
    for row in made.groupBy("length").count().collect():  # at most `capacity` rows
        histogram[row["length"]] = row["count"]
        total += row["count"]
    plan = make_plan(histogram, capacity)

    chunks = chunk_count(total)
    keyed = made.withColumn("_hash", hash31("doc_id", "piece", "ids_crc32"))
    keyed = keyed.withColumn("_chunk", chunk_of(F.col("_hash"), chunks, 31))
    ranked = running_total(keyed, ["length"], "_chunk", ["_hash", "doc_id", "piece"], F.lit(1), "_rank")

    def place(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            sequence, offset = plan.place(batch["length"].to_numpy(), batch["_rank"].to_numpy())
            kept = batch.drop(columns=["_rank"]).astype({"doc_id": "Int64"})
            yield kept.assign(sequence_id=sequence, offset=offset)

    columns = ["doc_id", "piece", "start", "length", "ids_crc32"]
    placed = ranked.select(*columns, "_rank").mapInPandas(place, PIECES + ", sequence_id long, offset long")
    return placed


def result(docs: DataFrame) -> DataFrame:
    return pack(docs)
