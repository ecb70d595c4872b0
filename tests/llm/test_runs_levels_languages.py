"""Runs, source divergence and language identification against brute force and held-out labels."""

import hashlib
import math
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from market_engine.llm import level_products, runs, string_kernel

WORD = re.compile(r"[^\x20\x09-\x0D]+")
TERM = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")


# Runs -----------------------------------------------------------------------------------------------


def brute_runs(words, least=12):
    """Stretches with each period, straight from the definition."""
    found, n = {}, len(words)
    for q in range(1, n // 2 + 1):
        i = 0
        while i + q < n:
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            if j > i and j - i + q >= max(least, 2 * q):
                found.setdefault((i, j - i + q), q)
            i = j + 1 if j == i else j
    return sorted(((s, length, q) for (s, length), q in found.items()), key=lambda r: (r[0], r[2]))


def words_with_repeats(rng):
    n, letters = rng.choice([0, 1, 5, 30, 90]), rng.choice([1, 2, 3, 6])
    words = ["abcdef"[rng.randrange(letters)] for _ in range(n)]
    if words and rng.random() < 0.5:
        at = rng.randrange(n)
        period = 1 + (n - at) // rng.randint(3, 10)
        words = [words[i] if i < at else words[at + (i - at) % period] for i in range(n)]
    return words


@pytest.mark.parametrize("least", [12, 2, 7, 20])
def test_maximal_pairs_are_the_runs(rng, least):
    for _ in range(150):
        documents = [[w.encode() for w in words_with_repeats(rng)] for _ in range(rng.randint(0, 6))]
        assert runs.runs_of(documents, least) == [brute_runs(d, least) for d in documents]


def test_long_texts_of_few_words_take_little_time():
    for words in ([b"x"] * 60_000, [b"a", b"b"] * 30_000, b"a line of words again and again ".split() * 9_000):
        (found,) = runs.runs_of([words])
        assert [(s, length) for s, length, _ in found][0] == (0, len(words))


def planted(words, doc_id):
    code = zlib.crc32(str(doc_id).encode()) if doc_id is not None else 1
    n = len(words)
    if code % 10 or not n:
        return words
    a = code // 10 % n
    p = 1 + (n - a) // (3 + code // 10 % 8)
    return [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]


def test_run_rows(docs_of, rng):
    rows = [(i, rng.choice([" ", "\n", "\t "]).join(words_with_repeats(rng))) for i in range(150)]
    rows += [(None, "a " * 20), (200, None), (201, ""), (202, "é \u00a0 é " * 9), (7, rows[7][1])]
    expected = Counter()
    for doc_id, text in rows:
        words = planted(WORD.findall(text or ""), doc_id)
        found = brute_runs(words)
        gone = {i for s, length, q in found for i in range(s + q, s + length)}
        s, length, q = min(found, key=lambda r: (-r[1], r[0], r[2]), default=(None, None, None))
        lines = "".join(f"{a},{b},{c}\n" for a, b, c in found)
        kept = " ".join(w for i, w in enumerate(words) if i not in gone)
        digests = [hashlib.sha256(x.encode()).hexdigest() for x in (lines, kept)]
        expected[(doc_id, len(found), s, length, q, q and 1000 * length // q, *digests)] += 1
    assert Counter(tuple(r) for r in runs.result(docs_of(rows)).collect()) == expected


# Source divergence ----------------------------------------------------------------------------------


def brute_divergence(rows, least, top):
    lower = {c: c + 32 for c in range(65, 91)}
    documents, counts, groups = Counter(), Counter(), set()
    for _, text, lang, source in rows:
        lang, source = lang or "", source or ""
        groups.add((lang, source))
        terms = TERM.findall((text or "").translate(lower))
        documents.update((lang, t) for t in set(terms))
        counts.update((lang, source, t) for t in terms)
    out = Counter()
    for lang in {g for g, _ in groups}:
        kept = [t for (g, t), n in documents.items() if g == lang and n >= least]
        sources = [s for g, s in groups if g == lang]
        inside = {s: {t: counts[lang, s, t] for t in kept} for s in sources}
        inside[None] = {t: sum(inside[s][t] for s in sources) for t in kept}
        totals = {s: sum(c.values()) + 5 * len(kept) for s, c in inside.items()}
        price = {s: {t: 1 + 1_000_000_000 * (c[t] + 5) // totals[s] for t in kept} for s, c in inside.items()}
        for s in sources:
            pairs = [(o, sum(abs(price[s][t] - price[o][t]) for t in kept)) for o in sources if o != s]
            own = [(t, price[s][t] - price[None][t]) for t in kept if inside[s][t] and price[s][t] > price[None][t]]
            for part, items, limit in (("pair", pairs, len(pairs)), ("term", own, top)):
                ordered = sorted(items, key=lambda x: (-x[1], x[0].encode()))[:limit]
                out.update((lang, s, part, item, value, rank) for rank, (item, value) in enumerate(ordered, 1))
    return out


def test_divergence_of_random_sources(docs_of, rng, monkeypatch):
    words = ["ab", "Cd", "é", "É", "日本", "zz"] + ["".join(rng.choices("abcde", k=3)) for _ in range(150)]
    rows = []
    for i in range(500):
        text = rng.choice([" ", "1", "-"]).join(rng.choices(words, k=rng.randint(0, 30), weights=[30, 20, 9, 5, 5, 3] + [1] * 150))
        rows.append((i, text, rng.choice(["en", "en", "de", None]), rng.choice(["hot"] * 5 + ["b", "c", "É", None, ""])))
    rows += [(1, None, "en", "silent"), (2, "1 2 3", "xx", "a"), (3, "", "xx", "b"), (3, "", "xx", "b"), (4, "solo", "yy", "only")]
    monkeypatch.setattr(level_products, "BLOCK_TERMS", 16)
    out = Counter(tuple(r) for r in level_products.result(docs_of(rows), min_documents=6, top_terms=9).collect())
    assert out == brute_divergence(rows, 6, 9)
    extra = docs_of(rows).selectExpr("*", "1 as term", "2 as n", "3 as number", "4 as rank", "5 as value")
    assert Counter(tuple(r) for r in level_products.result(extra, 6, 9).collect()) == out


def test_divergence_of_odd_tables(docs_of):
    assert level_products.result(docs_of([])).count() == 0
    alone = docs_of([(1, "word " * 60000, "en", "a")] * 40 + [(2, None, None, None)] * 2)
    assert level_products.result(alone).collect() == []
    tied = docs_of([(i, "same words", "en", s) for i in range(30) for s in ("b", "a", "c")])
    assert [tuple(r)[3:] for r in level_products.result(tied).where("source = 'a'").orderBy("rank").collect()] == [("b", 0, 1), ("c", 0, 2)]


def test_level_products_are_exact_in_any_blocks(rng):
    counts = np.array([[int(rng.paretovariate(0.6)) - 1 for _ in range(7)] for _ in range(300)])
    totals = [int(c) + 5 * 300 for c in counts.sum(axis=0)]
    prices = [[1 + 1_000_000_000 * (int(c) + 5) // t for c in counts[:, g]] for g, t in enumerate(totals)]
    expected = [[sum(abs(a - b) for a, b in zip(p, q)) for q in prices] for p in prices]
    for columns in (1, 100, 10_000):
        assert level_products.joint_prices(counts, totals, columns).tolist() == expected
    assert level_products.joint_prices(counts[:0], totals).tolist() == [[0] * 7] * 7


def test_prices_of_very_large_counts(spark):
    count, total = 9_000_000_000_007, 12_345_678_901_234
    expected = 1 + 1_000_000_000 * (count + 5) // total
    assert level_products.price(np.array([count]), total).tolist() == [expected]
    row = spark.createDataFrame([(count, total)], "c long, t long")
    assert row.select(level_products.price_of(row.c, row.t)).first()[0] == expected


# Language -------------------------------------------------------------------------------------------


def test_kernel_is_that_of_the_definition(rng, monkeypatch):
    texts = ["".join(rng.choices("abC é日\n", k=rng.randint(0, 200))) for _ in range(30)] + ["", "x", "xy", "XY"]

    def grams(text, n):
        text = text.lower()
        return {text[i : i + n] for i in range(len(text) - n + 1)}

    def kernel(x, y):
        parts = []
        for n in (1, 2, 3):
            a, b = grams(x, n), grams(y, n)
            parts.append(len(a & b) / math.sqrt(len(a) * len(b)) if a and b else 0.0)
        return sum(parts) / 3

    expected = [[kernel(x, y) for y in texts] for x in texts]
    for piece in (1 << 20, 7):
        monkeypatch.setattr(string_kernel, "PIECE", piece)
        np.testing.assert_allclose(string_kernel.Landmarks.of(texts).kernel(texts), expected, atol=1e-5)


def test_ridge_solution(rng):
    """With every text a landmark the Nyström solution is that of kernel ridge regression."""
    texts = ["".join(rng.choices("abcdefgh ", k=60)) for _ in range(20)]
    kernel = string_kernel.Landmarks.of(texts).kernel(texts).astype(float)
    labels = np.arange(20) % 3
    wanted = (labels[:, None] == np.arange(3)).astype(float)
    plain = np.linalg.solve(kernel + 1e-2 * 20 * np.eye(20), wanted)
    np.testing.assert_allclose(kernel @ string_kernel.solve(kernel, kernel, labels, 1e-2), kernel @ plain, atol=1e-3)


def test_held_out_languages(docs_of, rng):
    syllables = {"aa": ["ka", "lo", "mi", "tu"], "bb": ["sch", "ein", "ung", "te"], "cc": ["ção", "lhe", "que", "os"]}

    def text(lang):
        return " ".join("".join(rng.choices(syllables[lang], k=rng.randint(1, 4))) for _ in range(rng.randint(5, 60)))

    labelled = [(i, lang, text(lang)) for i in range(400) for lang in [rng.choice(["aa"] * 8 + ["bb", "cc"])]]
    rows = [(i, t, lang, "s") for i, lang, t in labelled] + [(1000, None, "aa", "s"), (1001, "12 !", "bb", "s"), (1002, "", None, "s")]
    rows += [(None, "ka lo mi", None, "s"), (1003, "que os " * 40_000, "cc", None), (1004, "日本", None, None)]
    out = {r.doc_id: r for r in string_kernel.result(docs_of(rows)).collect()}
    assert len(out) == len(rows)
    held = [(i, lang) for i, lang, _ in labelled if zlib.crc32(str(i).encode()) % 4 == 2]
    assert {i for i, _ in held} == {i for i in range(400) if out[i].held_out}
    assert sum(out[i].lang_pred == lang for i, lang in held) >= 0.97 * len(held)
    assert [tuple(out[i])[2:] for i in (1000, 1001, 1002)] == [("und", 0.0)] * 3
    assert out[None].lang_pred == "aa" and out[None].held_out is None and out[1003].lang_pred == "cc"
    assert out[1004].lang_pred in syllables and all(0 <= r.score <= 1 for r in out.values())
    again = {r.doc_id: tuple(r) for r in string_kernel.result(docs_of(rows[::-1])).collect()}
    assert {i: r[2] for i, r in again.items()} == {i: r.lang_pred for i, r in out.items()}


def test_nothing_to_learn_from(docs_of):
    assert string_kernel.result(docs_of([])).count() == 0
    out = string_kernel.result(docs_of([(1, "words", None, "s"), (2, None, "en", "s")])).collect()
    assert {(r.lang_pred, r.score) for r in out} == {("und", 0.0)}


def test_sample_is_bounded_whatever_the_ids(docs_of):
    rows = [(1, f"text {i}", "en", "s") for i in range(300)] + [(i, "autre", "fr", "s") for i in range(3) for _ in range(50)]
    learned = [i for i in range(3) if zlib.crc32(str(i).encode()) % 4 != 2]
    sample = string_kernel.sample_of(docs_of(rows), 40).collect()
    assert Counter(r.lang for r in sample) == {"en": 20, "fr": len(learned)}
    assert len({r.text for r in sample}) == 21
