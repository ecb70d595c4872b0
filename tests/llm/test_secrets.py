"""Secrets against exhaustive segmentation and plain searches; the same text has the same spans in any table."""

import hashlib
import math
import random

import pytest

from market_engine.llm import secrets
from market_engine.llm.secrets import COMMON, LONGEST_RUN, _DATE, _NEXT, _characters

RANKS = {"password": 1, "dragon": 2, "abc": 3, "sun": 40, "leet": 900}


def segment_costs(value, i, ranks):
    """(end, cost) of every segment that may begin at i, straight from the rules."""
    n, lower = len(value), value.lower()
    plain = lower.translate(secrets.LOOKALIKES)
    yield i + 1, _characters(value[i])
    for end in range(i + 3, min(n, i + 20) + 1):
        part = value[i:end]
        for word, extra in ((lower[i:end], 0), (plain[i:end], math.log10(2))):
            if word in ranks:
                yield end, math.log10(ranks[word] + 1) + extra + (math.log10(2) if part != lower[i:end] else 0)
                break
        if end - i <= LONGEST_RUN:
            if all(b in _NEXT.get(a, ()) for a, b in zip(lower[i:end], lower[i + 1 : end])):
                yield end, math.log10(2 * 47 * (end - i))
            if len({ord(b) - ord(a) for a, b in zip(part, part[1:])}) == 1 and abs(ord(part[1]) - ord(part[0])) == 1:
                yield end, math.log10(2 * 62 * (end - i))
    for period in (1, 2, 3, 4):
        if i >= period:
            end = i
            while end < n and value[end] == value[end - period]:
                end += 1
            if end - i >= 2:
                yield end, math.log10(end - i + 1)
    date = _DATE.match(value, i)
    if date:
        yield date.end(), 2.1 if date.end() - i == 4 else math.log10(365 * 130)


def cheapest(value, ranks, i=0, memo=None):
    memo = {} if memo is None else memo
    if i == len(value):
        return 0.0
    if i not in memo:
        memo[i] = min(cost + cheapest(value, ranks, end, memo) for end, cost in segment_costs(value, i, ranks))
    return memo[i]


def test_cost_is_that_of_the_cheapest_segmentation():
    rng = random.Random(2)
    parts = ["password", "Dragon", "p4ssw0rd", "abc", "sun", "1987", "2020-12-01", "qwert", "aaaa", "xyxyxy", "cba", "7", "K", "!", "é", "l33t"]
    for _ in range(1500):
        value = "".join(rng.choice([rng.choice(parts), rng.choice("aQ9$z")]) for _ in range(rng.randint(1, 7)))
        assert secrets.guess_cost(value, RANKS) == pytest.approx(cheapest(value, RANKS)), value


def plain_base(text):
    """Base spans by walking the text."""
    spans, lower = [], text.lower()

    def run(at, allowed):
        while at < len(text) and text[at] in allowed:
            at += 1
        return at

    at = 0
    while at < len(text):
        for name in ("password", "passwd", "secret", "token", "api_key", "apikey"):
            if not lower.startswith(name, at):
                continue
            end = at + len(name)
            end += end < len(text) and text[end] in "\"'"
            end = run(end, " ")
            if end >= len(text) or text[end] not in ":=":
                continue
            end = run(end + 1, " ")
            end += end < len(text) and text[end] in "\"'"
            stop = run(end, "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_.=-")
            if stop > end:
                if stop - end >= 12:
                    spans.append((at, 0, f"assign:{at}:{stop}"))
                at = stop - 1
                break
        at += 1
    for kind, name, first, allowed, least in ((1, "access", "AKIA", "ABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789", 18), (2, "hex", "", "0123456789abcdef", 16)):
        at = 0
        while at < len(text):
            stop = run(at + len(first), allowed) if text.startswith(first, at) else at
            if stop > at + len(first):
                if stop - at >= least:
                    spans.append((at, kind, f"{name}:{at}:{stop}"))
                at = stop
            else:
                at += 1
    return [span for _, _, span in sorted(spans)]


def random_text(rng):
    parts = ["password", "Token", "api_key", "apikey", "SECRET", '"', "'", " ", ":", "=", "AKIA", "ABCD9999XYZ", "deadbeef", "0123456789abcdef", "é", "\n", "x-y_z", "pwd: "]
    return "".join(rng.choices(parts, k=rng.randint(0, 40)))


def test_base_spans_and_rows(docs_of):
    rng = random.Random(4)
    rows = [(i, random_text(rng)) for i in range(600)]
    out = {r.doc_id: r for r in secrets.result(docs_of(rows)).collect()}
    for i, text in rows:
        want = plain_base(text)
        assert out[i].base_sha256 == hashlib.sha256(",".join(want).encode()).hexdigest(), text
        counts = [sum(s.startswith(k) for s in want) for k in ("assign", "access", "hex")]
        assert [out[i].n_assign, out[i].n_access, out[i].n_hex] == counts
        assert [s for s in out[i].spans.split(",") if s and not s.startswith("guess")] == want


def test_a_text_has_the_same_spans_alone_and_among_copies(docs_of):
    text = "login pwd=qzkdvbtmxw and password: correcthorse then token = thankyou2020 end"
    alone = secrets.result(docs_of([(1, text)])).first().spans
    assert "guess" in alone
    many = docs_of([(i, text) for i in range(1000)] + [(5000 + i, "qzkdvbtmxw " * 50) for i in range(50)])
    assert {r.spans for r in secrets.result(many).where("doc_id < 1000").collect()} == {alone}


def test_names_inside_values():
    ranks = secrets.word_ranks()
    assert [text for text in ("password: secret: qzkdvbtmxwpl", "token=password=qzkdvbtmxwpl") if not secrets.find(text, ranks)] == []
    (span,) = secrets.find("auth: token: 'Zk8!vQ2#xLm'", ranks)
    assert span[2] == "guess" and span[0] == 14
    assert secrets.find("password: password: password", ranks) == []
    many = "token: " * 20_000 + "Zk8!vQ2#xLm"
    assert [s[2] for s in secrets.find(many, ranks)] == ["guess"]


def test_known_words_are_ranked():
    ranks = secrets.word_ranks()
    assert ranks[COMMON[0]] == 1 and ranks["the"] < ranks["different"] < ranks["probiotics"] and "qzkdv" not in ranks
    assert sorted(ranks.values()) == list(range(1, len(ranks) + 1))
