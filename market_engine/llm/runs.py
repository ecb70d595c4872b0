"""Periodic runs of words, found as maximal pairs in the tree of LCP intervals.

Sorted suffixes of a text and the lengths of their common prefixes (LCP) form a tree: an interval of suffixes
that share `depth` words holds intervals that share more. Two positions from different children of an interval,
with different words to their left, are a maximal pair: the words repeat there and neither end can be moved. A
maximal pair whose distance is at most its depth overlaps or touches itself, so it is a stretch with that
distance as period which no neighbouring word extends: a run, with nothing left to extend. The stretch's
smallest period is the smallest distance it is found with.

The tree is walked from the leaves. An interval keeps its positions in text order, each with its left word; the
shorter of two lists is merged into the longer one. A position with another one of the list between itself and
a third is no pair of smallest period with that third one, so only neighbours in the list are compared, and
what is compared grows with n log n and not with the pairs.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left, insort
from collections.abc import Callable, Iterable, Iterator
from itertools import compress

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import text_of

MIN_WORDS = 12
#: Documents are sorted together up to so many words.
TOGETHER = 1 << 17
#: Texts handed back at a time, in bytes.
HANDED_BACK = 1 << 24

RUN = "struct<start:bigint,length:bigint,period:bigint>"
Edit = Callable[[list[bytes], int | None], list[bytes]]


# Sorted suffixes ----------------------------------------------------------------------------------------


def _numbered(documents: list[list[bytes]]) -> tuple[np.ndarray, np.ndarray]:
    """Words as numbers that differ between documents, with a number of its own before each document and at the
    end; and where each document begins."""
    ids: list[int] = []
    starts = []
    known = len(documents) + 1
    for i, words in enumerate(documents):
        ids.append(i)
        starts.append(len(ids))
        number = {w: n for n, w in enumerate(dict.fromkeys(words), known)}
        known += len(number)
        ids.extend(map(number.__getitem__, words))
    ids.append(len(documents))
    return np.array(ids, dtype=np.int64), np.array(starts, dtype=np.int64)


def _suffixes(ids: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray]:
    """Positions whose first `least` words are found again, in the order of their suffixes, and the common
    prefix of each with the one before it (0 for the first).

    Ranks by the first 1, 2, 4, ... words are refined for as long as positions share one; the ranks of every
    step are kept, as from them a common prefix is read off bit by bit.
    """
    n = len(ids)
    counts = np.bincount(ids)
    rank = (np.cumsum(counts) - counts)[ids]
    active = np.flatnonzero(counts[ids] > 1)
    steps, known = [rank.astype(np.int32)], 1
    candidates = None
    while len(active):
        if candidates is None and 2 * known >= least:
            # With `known` words equal, `least` are if those that end there are equal too.
            candidates = _shared(active, rank[active] * n + rank[active + (least - known)])
        key = rank[active] * n + rank[active + known]
        order = np.argsort(key, kind="stable")
        active, key = active[order], key[order]
        old = rank[active]
        place = np.arange(len(active))
        first = np.ones(len(active), bool)
        first[1:] = key[1:] != key[:-1]
        first_old = np.ones(len(active), bool)
        first_old[1:] = old[1:] != old[:-1]
        begin = np.maximum.accumulate(np.where(first, place, 0))
        rank[active] = old + begin - np.maximum.accumulate(np.where(first_old, place, 0))
        steps.append(rank.astype(np.int32))
        alone = first & np.append(first[1:], True)
        active = active[~alone]
        known *= 2
    if candidates is None or not len(candidates):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    candidates = candidates[np.argsort(rank[candidates], kind="stable")]
    a, b = candidates[:-1].copy(), candidates[1:].copy()
    common = np.zeros(len(a), np.int64)
    for power in range(len(steps) - 1, -1, -1):
        same = (steps[power][a] == steps[power][b]).astype(np.int64) << power
        common += same
        a += same
        b += same
    return candidates, np.append([0], common)


def _shared(positions: np.ndarray, key: np.ndarray) -> np.ndarray:
    """The positions whose key another one has too."""
    order = np.argsort(key, kind="stable")
    same = key[order][1:] == key[order][:-1]
    shared = np.zeros(len(positions), bool)
    shared[1:] |= same
    shared[:-1] |= same
    return positions[order][shared]


# Maximal pairs ------------------------------------------------------------------------------------------


def _maximal_pairs(positions: list[int], common: list[int], left: list[int], min_words: int, found: dict) -> None:
    """Walk the intervals of one subtree from the leaves; runs go to `found` as (start, length) -> period."""
    lists = [[positions[0]]]
    depths: list[int] = []

    def join() -> None:
        few, depth = lists.pop(), depths.pop()
        many = lists[-1]
        if len(many) < len(few):
            many, few = few, many
        for position in few:
            at = bisect_left(many, position)
            if at:
                pair(many[at - 1], position, depth)
            if at < len(many):
                pair(position, many[at], depth)
        if len(few) * 8 < len(many):
            for position in few:
                insort(many, position)
        else:
            many += few
            many.sort()
        lists[-1] = many

    def pair(a: int, b: int, depth: int) -> None:
        period = b - a
        if period <= depth and period + depth >= min_words and left[a - 1] != left[b - 1]:
            run = (a, period + depth)
            found[run] = min(period, found.get(run, period))

    for position, depth in zip(positions[1:], common[1:]):
        while depths and depths[-1] > depth:
            join()
        lists.append([position])
        depths.append(depth)
    while depths:
        join()


def runs_of(documents: list[list[bytes]], min_words: int = MIN_WORDS) -> list[list[tuple[int, int, int]]]:
    """The runs (start, length, period) of each document, by start, then period.

    A run has a length of at least `min_words` and of twice its period.
    """
    ids, starts = _numbered(documents)
    # Period p and depth d with p <= d and p + d >= min_words: d is at least half of that.
    least = max(1, -(-min_words // 2))
    positions, common = _suffixes(ids, least)
    runs: list[list[tuple[int, int, int]]] = [[] for _ in documents]
    if not len(positions):
        return runs
    found: dict[tuple[int, int], int] = {}
    begins = np.flatnonzero(common < least)
    sizes = np.diff(np.append(begins, len(positions)))
    # Most subtrees hold two positions.
    at = begins[sizes == 2]
    a, b = np.minimum(positions[at], positions[at + 1]), np.maximum(positions[at], positions[at + 1])
    depth, period = common[at + 1], b - a
    is_run = (period <= depth) & (period + depth >= min_words) & (ids[a - 1] != ids[b - 1])
    for start, length, p in zip(a[is_run].tolist(), (period + depth)[is_run].tolist(), period[is_run].tolist()):
        found[start, length] = p
    if (sizes > 2).any():
        left = ids.tolist()
        for i, size in zip(begins[sizes > 2].tolist(), sizes[sizes > 2].tolist()):
            _maximal_pairs(positions[i : i + size].tolist(), common[i : i + size].tolist(), left, min_words, found)
    if found:
        begin = np.array([start for start, _ in found])
        owner = (np.searchsorted(starts, begin, side="right") - 1).tolist()
        for doc, ((start, length), p) in zip(owner, found.items()):
            runs[doc].append((start - int(starts[doc]), length, p))
    for of_document in runs:
        of_document.sort(key=lambda run: (run[0], run[2]))
    return runs


def collapsed(words: list[bytes], runs: Iterable[tuple[int, int, int]]) -> list[bytes]:
    """The words without those that a run repeats."""
    kept = bytearray(b"\1") * len(words)
    for start, length, period in runs:
        kept[start + period : start + length] = bytes(length - period)
    return list(compress(words, kept))


# The operator -------------------------------------------------------------------------------------------


def find_runs(docs: DataFrame, min_words: int = MIN_WORDS, edit: Edit | None = None) -> DataFrame:
    """A row per document: doc_id, runs (array of start, length, period), collapsed (text).

    Words are what white space of ASCII separates; numbers count from 0. `collapsed` has the words that no run
    repeats, joined by a space. `edit` changes a document's words first. A NULL or empty text has no words, so
    no runs and an empty collapsed text. Rows that repeat are treated alike; other columns play no part.
    """
    schema = f"doc_id long, runs array<{RUN}>, collapsed string"
    kind = pa.schema(
        [
            ("doc_id", pa.int64()),
            ("runs", pa.list_(pa.struct([(c, pa.int64()) for c in ("start", "length", "period")]))),
            ("collapsed", pa.string()),
        ]
    )

    def batch_of(doc_ids: list, documents: list[list[bytes]]) -> Iterator[pa.RecordBatch]:
        rows: list[tuple] = []
        size = 0
        for doc_id, words, runs in zip(doc_ids, documents, runs_of(documents, min_words)):
            text = b" ".join(collapsed(words, runs) if runs else words)
            rows.append((doc_id, [dict(zip(("start", "length", "period"), run)) for run in runs], text))
            size += len(text)
            if size > HANDED_BACK:
                yield _batch(rows, kind)
                rows, size = [], 0
        if rows:
            yield _batch(rows, kind)

    def found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            doc_ids: list = []
            documents: list[list[bytes]] = []
            total = 0
            for doc_id, text in zip(batch.column(0), batch.column(1)):
                number = doc_id.as_py()
                words = text.as_py().split()
                words = edit(words, number) if edit else words
                if documents and total + len(words) > TOGETHER:
                    yield from batch_of(doc_ids, documents)
                    doc_ids, documents, total = [], [], 0
                doc_ids.append(number)
                documents.append(words)
                total += len(words) + 1
            if documents:
                yield from batch_of(doc_ids, documents)

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_of().cast("binary").alias("text"))
    return rows.mapInArrow(found, schema)


def _batch(rows: list[tuple], kind: pa.Schema) -> pa.RecordBatch:
    doc_ids, runs, texts = zip(*rows)
    columns = [pa.array(doc_ids, kind[0].type), pa.array(runs, kind[1].type), pa.array(texts, pa.binary())]
    columns[2] = columns[2].cast(pa.string())
    return pa.RecordBatch.from_arrays(columns, schema=kind)


def with_planted_period(words: list[bytes], doc_id: int | None) -> list[bytes]:
    """The words of a tenth of the documents, chosen by the CRC-32 of the doc_id, repeat from some word on."""
    code = zlib.crc32(str(doc_id).encode()) if doc_id is not None else 1
    if code % 10 or not words:
        return words
    code //= 10
    at = code % len(words)
    rest = len(words) - at
    period = 1 + rest // (3 + code % 8)
    pattern = words[at : at + period]
    return words[:at] + (pattern * (rest // len(pattern) + 1))[:rest]


def result(docs: DataFrame) -> DataFrame:
    """doc_id, n_runs, the longest run, and digests of all runs and of the collapsed text; see `find_runs`.

    A tenth of the documents is read with a planted period. A NULL doc_id plants nothing. An empty table gives
    an empty result.
    """
    found = find_runs(docs, edit=with_planted_period)
    lines = F.transform("runs", lambda r: F.concat_ws(",", r["start"], r["length"], r["period"]))
    listed = F.concat(F.array_join(lines, "\n"), F.when(F.size("runs") > 0, "\n").otherwise(""))
    # Structs compare field by field: the greatest length, then the smallest start, then the smallest period.
    best = F.array_max(
        F.transform(
            "runs", lambda r: F.struct(r["length"].alias("length"), (-r["start"]).alias("start"), (-r["period"]).alias("period"))
        )
    )
    start, length, period = -F.col("_best.start"), F.col("_best.length"), -F.col("_best.period")
    return found.withColumn("_best", best).select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        start.alias("start"),
        length.alias("length"),
        period.alias("period"),
        F.expr("1000 * _best.length div -_best.period").cast("long").alias("exponent_milli"),
        F.sha2(listed.cast("binary"), 256).alias("runs_sha256"),
        F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"),
    )


#: DuckDB: words whose six-word shingles are equal at a distance d, in unbroken stretches, and the smallest d.
ORACLE = r"""
WITH d AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w,
    list_reduce(list_prepend(4294967295, list_transform(range(1, len(CAST(doc_id AS VARCHAR)) + 1), lambda i: CAST(ord(substr(CAST(doc_id AS VARCHAR), i, 1)) AS BIGINT))),
      lambda c, b: list_reduce([xor(c, b), 0, 0, 0, 0, 0, 0, 0, 0], lambda x, y: xor(x >> 1, 3988292384 * (x & 1)))) AS c
  FROM documents),
h AS (SELECT doc_id, w, CAST(len(w) AS BIGINT) AS n, xor(c, 4294967295) AS h, xor(c, 4294967295) // 10 AS g FROM d),
p AS (SELECT *, CASE WHEN n > 0 THEN g % n END AS a, CASE WHEN n > 0 THEN 1 + (n - g % n) // (3 + g % 8) END AS p FROM h),
x AS (SELECT doc_id, n, unnest(range(n)) AS i, h, w, a, p FROM p),
t AS (SELECT doc_id, i, w[CAST(CASE WHEN h % 10 = 0 AND i >= a THEN a + (i - a) % p ELSE i END AS BIGINT) + 1] AS word FROM x),
s AS (
  SELECT doc_id, i, concat_ws(' ', word, lead(word) OVER o, lead(word, 2) OVER o, lead(word, 3) OVER o, lead(word, 4) OVER o, lead(word, 5) OVER o) AS six,
         lead(i, 5) OVER o AS last
  FROM t WINDOW o AS (PARTITION BY doc_id ORDER BY i)),
e AS (SELECT a.doc_id, a.i, b.i - a.i AS q FROM s a JOIN s b ON a.doc_id = b.doc_id AND a.six = b.six AND a.i < b.i WHERE a.last IS NOT NULL AND b.last IS NOT NULL),
u AS (SELECT *, i - row_number() OVER (PARTITION BY doc_id, q ORDER BY i) AS stretch FROM e),
m AS (SELECT doc_id, q, min(i) AS start, count(*) + 5 AS depth FROM u GROUP BY doc_id, q, stretch),
r AS (SELECT doc_id, start, depth + q AS length, min(q) AS period FROM m WHERE depth >= q AND depth + q >= 12 GROUP BY ALL),
f AS (
  SELECT doc_id, count(*) AS n_runs, arg_max(struct_pack(s := start, l := length, p := period), (length, -start, -period)) AS best,
         string_agg(start || ',' || length || ',' || period || chr(10), '' ORDER BY start, period) AS listed
  FROM r GROUP BY doc_id),
gone AS (SELECT DISTINCT doc_id, unnest(range(start + period, start + length)) AS i FROM r),
k AS (SELECT t.doc_id, string_agg(word, ' ' ORDER BY i) AS kept FROM t ANTI JOIN gone USING (doc_id, i) GROUP BY t.doc_id)
SELECT d.doc_id, CAST(coalesce(n_runs, 0) AS BIGINT) AS n_runs, CAST(best.s AS BIGINT) AS start, CAST(best.l AS BIGINT) AS length,
       CAST(best.p AS BIGINT) AS period, CAST(1000 * best.l // best.p AS BIGINT) AS exponent_milli,
       sha256(coalesce(listed, '')) AS runs_sha256, sha256(coalesce(kept, '')) AS collapsed_sha256
FROM d LEFT JOIN f ON d.doc_id = f.doc_id LEFT JOIN k ON d.doc_id = k.doc_id
"""
