"""Secrets in texts: fixed patterns, and values in credential contexts that are hard to guess.

How hard a value is to guess is the cost, in powers of ten, of its cheapest segmentation (Wheeler 2016): known words
by rank, dates and years, repeats, keyboard walks and runs, and single characters by brute force. Dynamic
programming over the end positions finds it. Words are ranked by a public vocabulary, after a short list of
common passwords, as someone who guesses would rank them. They do not come from the corpus: there a secret that
stands in many copies would become a known word, and what else is in the corpus would decide about a text.
"""

from __future__ import annotations

import hashlib
import json
import math
import re
from bisect import bisect_left
from collections.abc import Iterator
from itertools import accumulate

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import text_of

#: Log10 guesses from which a value counts as a secret, and the characters it must have.
HARD = 9.0
SHORTEST = 8
#: Letters of a word that counts as known.
WORD_LENGTHS = (3, 20)
#: Characters of one keyboard walk or run; longer ones take several, so that the time stays linear in the length.
LONGEST_RUN = 64

ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{16,}")
#: Names before a value that make it a credential, and the value: up to white space, quotes, commas, brackets.
CONTEXT = re.compile(
    r"""(?:pass(?:word|wd|phrase|code)?|pwd|secret|token|api[_-]?key|access[_-]?key|private[_-]?key|credentials?|auth)"""
    r"""["']?\x20*(?:[:=]|=>)\x20*["']?([^\s"',;<>(){}\[\]]+)""",
    re.I | re.A,
)
KINDS = ("assign", "access", "hex", "guess")

# Common passwords, and the rows of a keyboard.
COMMON = (
    "password", "123456", "12345678", "qwerty", "abc123", "letmein", "monkey", "dragon", "iloveyou", "trustno1",
    "sunshine", "master", "welcome", "shadow", "ashley", "football", "jesus", "michael", "ninja", "mustang",
    "admin", "administrator", "root", "user", "guest", "test", "demo", "default", "changeme", "secret", "login",
    "princess", "flower", "hello", "freedom", "whatever", "starwars", "passw0rd", "pass", "token", "access",
    "manager", "oracle", "mysql", "postgres", "public", "private", "temp", "temporary", "example", "sample",
    "server", "system", "summer", "winter", "spring", "autumn",
)
KEYBOARD = ("`1234567890-=", "qwertyuiop[]", "asdfghjkl;'", "zxcvbnm,./")
LOOKALIKES = str.maketrans("4@310$57!", "aaeiossti")

_DATE = re.compile(r"(?:19|20)\d\d[-/.]?[01]?\d[-/.]?[0-3]?\d|[0-3]?\d[-/.]?[01]?\d[-/.]?(?:19|20)\d\d|(?:19|20)\d\d")
_NEXT = {a: set() for row in KEYBOARD for a in row}
for _row in KEYBOARD:
    for _a, _b in zip(_row, _row[1:]):
        _NEXT[_a].add(_b)
        _NEXT[_b].add(_a)


def _characters(c: str) -> float:
    return math.log10(10 if c.isdigit() else 26 if c.isalpha() and c.isascii() else 33 if c.isascii() else 1000)


def _run_ends(value: str, goes_on) -> list[int]:
    """For each position the end of the longest run from it in which `goes_on(i)` holds between i and i + 1."""
    n = len(value)
    ends = list(range(1, n + 1))
    for i in range(n - 2, -1, -1):
        if goes_on(i):
            ends[i] = ends[i + 1]
    return ends


def guess_cost(value: str, ranks: dict[str, int]) -> float:
    """Log10 of the guesses the cheapest segmentation takes. Time and memory are linear in the length."""
    n, lower = len(value), value.lower()
    plain = lower.translate(LOOKALIKES)
    walk = _run_ends(lower, lambda i: lower[i + 1] in _NEXT.get(lower[i], ()))
    up = _run_ends(value, lambda i: ord(value[i + 1]) - ord(value[i]) == 1)
    down = _run_ends(value, lambda i: ord(value[i + 1]) - ord(value[i]) == -1)
    same = {p: _run_ends(value, lambda i, p=p: i + 1 >= p and value[i + 1] == value[i + 1 - p]) for p in (1, 2, 3, 4)}
    best = [0.0] + [math.inf] * n

    def reach(end: int, cost: float) -> None:
        if cost < best[end]:
            best[end] = cost

    for i in range(n):
        here = best[i]
        reach(i + 1, here + _characters(value[i]))
        for length in range(WORD_LENGTHS[0], min(WORD_LENGTHS[1], n - i) + 1):
            word = lower[i : i + length]
            rank, extra = ranks.get(word), 0.0
            if rank is None:
                rank, extra = ranks.get(plain[i : i + length]), math.log10(2)
            if rank is not None:
                changed = value[i : i + length] != word
                reach(i + length, here + math.log10(rank + 1) + extra + changed * math.log10(2))
        for ends, starts in ((walk, 2 * 47), (up, 2 * 62), (down, 2 * 62)):
            for end in range(i + 3, min(ends[i], i + LONGEST_RUN) + 1):
                reach(end, here + math.log10(starts * (end - i)))
        # A repeat goes on from what stands before it: only its length has to be guessed.
        for period, ends in same.items():
            if i >= period and value[i] == value[i - period]:
                stop = ends[i - 1] if i else 0
                if stop - i >= 2:
                    reach(stop, here + math.log10(stop - i + 1))
        date = _DATE.match(value, i)
        if date:
            reach(date.end(), here + (2.1 if date.end() - i == 4 else math.log10(365 * 130)))
    return best[n]


def _credentials(text: str) -> Iterator[tuple[int, int]]:
    """Where the values behind the names of credentials stand. A value that is itself such a name is none."""
    m = CONTEXT.search(text)
    while m:
        inner = CONTEXT.match(text, m.start(1))
        if not inner:
            yield m.span(1)
        m = inner or CONTEXT.search(text, m.end())


def find(text: str, ranks: dict[str, int]) -> list[tuple[int, int, str, float | None]]:
    """(start, end, kind, log10 guesses of a credential's value) of all spans, by start and kind."""
    spans = []
    for m in ASSIGN.finditer(text):
        if len(m.group(2)) >= 12:
            spans.append((m.start(), m.end(), 0, guess_cost(m.group(2), ranks)))
    spans += [(m.start(), m.end(), 1, None) for m in ACCESS.finditer(text) if m.end() - m.start() >= 18]
    spans += [(m.start(), m.end(), 2, None) for m in HEX.finditer(text)]
    known = sorted((a, b) for a, b, _, _ in spans)
    starts, reach = [a for a, _ in known], [0, *accumulate((b for _, b in known), max)]
    for start, end in _credentials(text):
        # Of the spans that start before the end, does one reach past the start?
        if end - start < SHORTEST or reach[bisect_left(starts, end)] > start:
            continue
        cost = guess_cost(text[start:end], ranks)
        if cost >= HARD:
            spans.append((start, end, 3, cost))
    return [(a, b, KINDS[k], cost) for a, b, k, cost in sorted(spans, key=lambda s: (s[0], s[2]))]


def default_vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def word_ranks(path: str | None = None) -> dict[str, int]:
    """Ranks of the common passwords and then of the vocabulary's whole words, in the order in which it learned them.

    The file is that of a tokenizer whose tokens mark ends of words. Its size bounds what tasks are sent.
    """
    with open(path or default_vocabulary(), encoding="utf-8") as file:
        ids = json.load(file)["model"]["vocab"]
    whole = re.compile(rf"([a-z]{{{WORD_LENGTHS[0]},{WORD_LENGTHS[1]}}})</w>")
    ranks: dict[str, int] = {}
    for word in [*COMMON, *(m.group(1) for token in sorted(ids, key=ids.get) if (m := whole.fullmatch(token)))]:
        ranks.setdefault(word, len(ranks) + 1)
    return ranks


def spans_of(docs: DataFrame, ranks: dict[str, int] | None = None) -> DataFrame:
    """doc_id, kind, start, end (code points), text, log10_guesses: a row per span. NULL texts have none."""
    known = word_ranks() if ranks is None else ranks

    def located(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = [
                (doc_id, kind, a, b, text[a:b], cost)
                for doc_id, text in zip(batch["doc_id"], batch["text"])
                for a, b, kind, cost in find(text, known)
            ]
            frame = pd.DataFrame(out, columns=["doc_id", "kind", "start", "end", "text", "log10_guesses"])
            yield frame.astype({"doc_id": "Int64", "start": "int64", "end": "int64", "log10_guesses": "float64"})

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_of().alias("text"))
    return rows.mapInPandas(located, "doc_id long, kind string, start long, end long, text string, log10_guesses double")


def result(docs: DataFrame, ranks: dict[str, int] | None = None) -> DataFrame:
    """A row per document: doc_id, n_assign, n_access, n_hex, n_guess, base_sha256, spans.

    NULL and empty texts have no spans, and an empty table gives an empty result. Rows are judged on their own, so a
    text has the same spans in any table; repeated rows and other columns do not matter.
    """
    known = word_ranks() if ranks is None else ranks

    def joined(spans) -> str:
        return ",".join(f"{kind}:{a}:{b}" for a, b, kind, _ in spans)

    @F.pandas_udf("n_assign long, n_access long, n_hex long, n_guess long, base_sha256 string, spans string")
    def scanned(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for texts in batches:
            out = []
            for text in texts:
                spans = find(text, known)
                base = joined([s for s in spans if s[2] != "guess"])
                counts = [sum(s[2] == kind for s in spans) for kind in KINDS]
                out.append((*counts, hashlib.sha256(base.encode()).hexdigest(), joined(spans)))
            columns = ["n_assign", "n_access", "n_hex", "n_guess", "base_sha256", "spans"]
            yield pd.DataFrame(out, columns=columns)

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), scanned(text_of()).alias("_found")).select("doc_id", "_found.*")
