"""Operators against brute force and on odd rows: NULLs, empty and very long texts, ties, repeats, empty tables."""

import random
import re
import time
from collections import Counter

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from market_engine.llm import (
    exact_dedup,
    fixity,
    kd_shards,
    license_rules,
    mixing,
    robust_outliers,
    runs,
    secrets,
    simhash,
    string_kernel,
    toxicity,
)

WORD = re.compile(r"[^\x20\x09-\x0D]+")
ODD = [(1, None), (2, ""), (None, "no id here"), (None, None), (3, "a b  c"), (4, "a\tb c"), (4, "a\tb c"), (5, "x " * 30000)]
OPERATORS = {
    "exact_dedup": exact_dedup.result,
    "kd_shards": kd_shards.result,
    "license_rules": license_rules.result,
    "mixing": mixing.result,
    "robust_outliers": robust_outliers.result,
    "runs": runs.result,
    "secrets": secrets.result,
    "simhash": simhash.result,
    "string_kernel": string_kernel.result,
}


@pytest.mark.parametrize("name", OPERATORS)
def test_odd_rows_and_empty_tables(docs_of, name):
    """A row per row, whatever it holds; columns with the names used inside change nothing."""
    docs = docs_of([(i, t, lang, source) for i, t in ODD for lang, source in [("en", None), (None, "s")]])
    plain = OPERATORS[name](docs)
    extra = docs.selectExpr("*", "1 as digest", "2 as size", "'x' as component_id", "3 as shard", "4 as `group`", "5 as start", "6 as score")
    rows = Counter(map(repr, plain.collect()))
    assert sum(rows.values()) == 2 * len(ODD)
    assert Counter(map(repr, OPERATORS[name](extra).collect())) == rows
    assert OPERATORS[name](docs.limit(0)).count() == 0


def variants(rng, n):
    out = []
    for _ in range(n):
        base = [rng.choice("abcdefghij") * rng.randint(1, 3) for _ in range(rng.randint(0, 60))]
        out.append(" ".join(base))
        for _ in range(rng.randint(0, 4)):
            changed = list(base)
            if changed:
                changed[rng.randrange(len(changed))] = rng.choice(["q", "Zz", "é"])
            out.append(rng.choice([" ", "\n"]).join(changed))
    return out


def brute_fingerprint(text):
    words = [w for w in WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text))]
    shingles = [" ".join(words[i : i + 3]) for i in range(len(words) - 2)] if len(words) >= 3 else [" ".join(words)] if words else []
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


@pytest.mark.parametrize("limit", [simhash.PAIR_LIMIT, 1])
def test_simhash_components(docs_of, rng, limit):
    """Both ways of finding links give the components of all pairs."""
    texts = variants(rng, 60) + ["", "  ", "solo"]
    prints = [brute_fingerprint(t) for t in texts]
    parent = list(range(len(texts)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(texts)):
        for j in range(i):
            if bin(prints[i] ^ prints[j]).count("1") <= 2:
                a, b = sorted((root(i), root(j)))
                parent[b] = a
    expected = {(i, format(prints[i], "016x"), root(i)) for i in range(len(texts))}
    out = simhash.find_near_duplicates(docs_of(list(enumerate(texts))), limit)
    got = {(r.doc_id, r.h, r.component_id) for r in out.select("*", simhash.as_hex("fingerprint").alias("h")).collect()}
    assert got == expected
    assert len({r[2] for r in expected}) < len(set(prints))


@pytest.mark.parametrize("limit", [simhash.PAIR_LIMIT, 2])
def test_links_among_many_close_fingerprints(spark, rng, limit):
    """A cluster around one fingerprint, linked only within two bits, and a chain."""
    prints = {rng.getrandbits(64) for _ in range(50)}
    centre = rng.getrandbits(64)
    prints |= {centre ^ (1 << rng.randrange(64)) ^ (1 << rng.randrange(64)) ^ (1 << rng.randrange(30)) for _ in range(80)}
    chain = rng.getrandbits(64)
    prints |= {chain := chain ^ (3 << (2 * i)) for i in range(20)}
    rows = [(p - (1 << 64) if p >= 1 << 63 else p,) for p in prints]
    found = simhash.components(simhash.links(spark.createDataFrame(rows, "fingerprint long"), limit)).collect()
    groups = {}
    for r in found:
        groups.setdefault(r.label, set()).add(r.node)
    assert sum(map(len, groups.values())) == len({r.node for r in found})
    left, expected = {r[0] for r in rows}, []
    while left:
        todo, group = [left.pop()], set()
        while todo:
            a = todo.pop()
            group.add(a)
            near = {b for b in left if bin((a ^ b) & (1 << 64) - 1).count("1") <= 2}
            left -= near
            todo += near
        expected.append(group)
    assert sorted(map(sorted, groups.values())) == sorted(sorted(g) for g in expected if len(g) > 1)


def test_exact_duplicates_keep_one_row(docs_of):
    docs = docs_of([(5, "a  b"), (2, "a\nb"), (2, "a\nb"), (None, "a b"), (None, "c"), (None, "c"), (8, None), (9, "")])
    assert sorted(str(r.doc_id) for r in exact_dedup.drop_duplicates(docs).collect()) == ["2", "8", "None"]


def test_perfect_hash_is_minimal_and_checks_bytes():
    known = [random.Random(i).randbytes(32) for i in range(3000)]
    sizes, bits, slots = exact_dedup.build_hash(b"".join(known))
    assert sorted(slots) == list(range(3000))
    assert (exact_dedup.find_slots(b"".join(known), sizes, bits) == slots).all()
    assert exact_dedup.build_hash(b"")[0] == []


def test_history_is_looked_up(docs_of):
    old, new = docs_of([(10, "x y"), (11, "z")]), docs_of([(1, "x  y"), (12, "new"), (13, "new")])
    found = {r.doc_id: (r.keep_id, r.group_size, r.kept) for r in exact_dedup.find_duplicates(new, old).collect()}
    assert found == {10: (1, 2, False), 1: (1, 2, True), 11: (11, 1, True), 12: (12, 2, True), 13: (12, 2, False)}


def test_mix_meets_targets_and_slots_hold_blocks(docs_of, rng):
    rows = [(i, "w " * rng.randint(0, 90), "en", rng.choice(["a", "b", "c", "d", None, "tiny"] + ["a"] * 6)) for i in range(600)]
    rows = [r for r in rows if r[3] != "tiny"] + [(900, "w w", "en", "tiny")]
    mixed = mixing.mix(docs_of(rows), block=64)
    out = mixing.taken(mixed).collect()
    total = sum(r.size for r in out)
    by_source = {}
    for r in out:
        assert r.taken <= 3 * r.size
        by_source.setdefault(r.source, []).append(r)
    assert abs(sum(rs[0].target for rs in by_source.values()) - total) < 1e-6
    for rs in by_source.values():
        assert sum(r.taken for r in rs) == int(rs[0].target) <= 3 * rs[0].source_size
    assert by_source["tiny"][0].target == 6
    per_slot = mixed.pieces.groupBy("slot", "source_key").agg(F.sum("words").alias("n"))
    assert per_slot.count() == per_slot.select("slot").distinct().count()
    assert {(r.doc_id, r.taken) for r in out} == {(r.doc_id, r.taken) for r in mixing.taken(mixing.mix(docs_of(rows[::-1]), 64)).collect()}


def test_shards_are_even_and_slots_gapless(docs_of, rng):
    rows = [(i, "x" * int(rng.paretovariate(1.2) * 20 % 3000), rng.choice(["en", "de"]), rng.choice(["big"] * 5 + ["a", "b"])) for i in range(4000)]
    out = kd_shards.result(docs_of(rows)).collect()
    sizes = Counter()
    for r in out:
        sizes[r.shard] += r.size
    mean = sum(sizes.values()) / 24
    assert sorted(sizes) == list(range(24)) and max(sizes.values()) < 1.05 * mean and min(sizes.values()) > 0.95 * mean
    for shard in range(24):
        slots = sorted(r.slot for r in out if r.shard == shard)
        assert slots == list(range(len(slots)))


def brute_statistics(text):
    words, lines = WORD.findall(text), [x for x in text.split("\n") if WORD.search(x)]
    windows = [tuple(words[i : i + 5]) for i in range(len(words) - 4)]
    counts = Counter(windows)
    covered = {j for i, w in enumerate(windows) if counts[w] > 1 for j in range(i, i + 5)}
    symbols = sum(c in "#*$%&|<>" for c in text)
    return len(words), sum(map(len, words)), symbols, len(lines) - len(set(lines)), len(covered)


def test_quality_statistics(docs_of, rng):
    texts = ["".join(rng.choices(["a ", "bb ", "\n", "é", "#", "| ", "c\t", "日"], k=rng.randint(0, 200))) for _ in range(150)]
    texts += ["", "\n\n", "a b c d e a b c d e", "x y\nx y\n x y"]
    out = robust_outliers.with_statistics(docs_of(list(enumerate(texts)))).collect()
    names = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
    assert {r.doc_id: tuple(r[n] for n in names) for r in out} == {i: brute_statistics(t) for i, t in enumerate(texts)}


def test_outliers_go_and_clean_documents_stay(docs_of, rng):
    def text(noise):
        return " ".join("".join(rng.choices("abcdefgh", k=rng.randint(2, 9))) + noise for _ in range(rng.randint(40, 400)))

    rows = [(i, text("###" if i % 20 == 0 else ""), "en", "s" if i % 3 else "t") for i in range(400)]
    out = {r.doc_id: r for r in robust_outliers.judge(docs_of(rows)).collect()}
    assert [i for i, r in out.items() if not r.kept and not r.base_failed] and all(out[i].kept == (i % 20 != 0) for i in out)


def numpy_mcd(x, share=0.75):
    """The lowest determinant over many starts, by steps to convergence with the closest documents counted exactly."""
    floors = np.diag(np.array(robust_outliers.FLOORS) ** 2)
    h, best = int(np.ceil(share * len(x))), None
    rng = np.random.default_rng(0)
    starts = [(np.median(x, axis=0), np.diag((1.4826 * np.median(np.abs(x - np.median(x, axis=0)), axis=0)) ** 2) + floors)]
    starts += [(c.mean(axis=0), np.cov(c.T, bias=True) + floors) for c in [x] + [x[rng.choice(len(x), 20)] for _ in range(20)]]
    for mean, cov in starts:
        for _ in range(60):
            d = np.einsum("ij,jk,ik->i", x - mean, np.linalg.inv(cov), x - mean)
            core = x[np.argsort(d, kind="stable")[:h]]
            mean, cov = core.mean(axis=0), np.cov(core.T, bias=True) * robust_outliers.CORE_FACTOR + floors
        det = np.linalg.slogdet(cov)[1]
        if best is None or det < best[0]:
            best = (det, mean)
    return best


def test_estimates_are_those_of_the_lowest_determinant(spark):
    rng = np.random.default_rng(3)
    groups = {}
    for k in range(6):
        mix = rng.normal(size=(5, 5))
        x = rng.normal(size=(400, 5)) @ mix + rng.normal(size=5) * 3
        x[: 20 * k] = rng.normal(size=5) * 12 + rng.normal(size=(20 * k, 5))  # up to a quarter lies elsewhere
        groups[f"g{k}"] = x
    rows = [(g, i % 32, i % 8, *map(float, v)) for g, x in groups.items() for i, v in enumerate(x)]
    vectors = spark.createDataFrame(rows, "`group` string, _salt int, _part int, x1 double, x2 double, x3 double, x4 double, x5 double")
    found = {r.group: r for r in robust_outliers.estimate(vectors).collect()}
    assert len(found) == len(groups)
    for g, x in groups.items():
        det, mean = numpy_mcd(x)
        assert found[g].log_det == pytest.approx(det, abs=0.15)
        assert [found[g][f"m{i}"] for i in range(5)] == pytest.approx(list(mean), abs=0.3)


def test_repetition_alone_rejects(docs_of, rng):
    def words(n):
        return ["".join(rng.choices("abcdefgh", k=rng.randint(2, 9))) for _ in range(n)]

    def lines(found):
        return "\n".join(" ".join(found[i : i + 10]) for i in range(0, len(found), 10))

    rows = [(i, lines(words(rng.randint(150, 400)))) for i in range(600)]
    for i in range(1000, 1020):  # a seventh of the words is repeated, less than the base rule forbids
        found = words(250)
        rows.append((i, lines(found + found[:20])))
    for i in range(2000, 2020):  # a short line again and again
        found = words(250)
        rows.append((i, "\n".join([lines(found)] + ["x"] * 30)))
    rows += [(3000 + i, lines(words(250)) + "\nx\nx") for i in range(20)]  # one line twice is usual
    out = {r.doc_id: r for r in robust_outliers.judge(docs_of(rows)).collect()}
    assert not any(out[i].base_failed for i in out)
    assert not any(out[i].kept for i in range(1000, 1020)) and not any(out[i].kept for i in range(2000, 2020))
    assert sum(out[i].kept for i in range(600)) >= 597 and sum(out[i].kept for i in range(3000, 3020)) >= 19


def test_secret_spans():
    key = "AKIA" + "Z9" * 8
    text = f"é password: 'abcdefghijklmnop' {key} secret=short TOKEN = \"{'0f' * 10}\" pwd=\"xK9!vQ2#zR\" pass=password1 AKIAX"
    spans = secrets.find(text, {"password": 1})
    assert [k for _, _, k, _ in spans] == ["assign", "access", "assign", "hex", "guess"]
    assert [text[a:b] for a, b, k, _ in spans if k in ("access", "hex", "guess")] == [key, "0f" * 10, "xK9!vQ2#zR"]
    assert secrets.find("password: secret: abcdefghijklmnop", {})[:1] == []


@pytest.mark.parametrize(
    "easy, hard",
    [("password1", "pzqsvword"), ("19870412", "83920417"), ("aaaaaaaaaa", "aqmzbvkdje"), ("qwertyuiop", "qmwzeprtxy"), ("p4ssw0rd", "p4zzx0vd")],
)
def test_guess_cost_order(easy, hard):
    ranks = {"password": 1}
    assert secrets.guess_cost(easy, ranks) + 1 < secrets.guess_cost(hard, ranks)
    assert secrets.guess_cost(easy * 40, ranks) < 60 * secrets.guess_cost(easy, ranks)


def test_license_rules(docs_of):
    mit = (
        "MIT License\nPermission is hereby granted, free of charge, to any person obtaining a copy of this software and associated"
        " documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the"
        " rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit"
        " persons to whom the Software is furnished to do so, subject to the following conditions.\nThe above copyright notice and"
        " this permission notice shall be included in all copies or substantial portions of the Software. All rights reserved."
    )
    rows = [(1, mit), (2, "Text. Licensed under CC BY-NC 4.0.\nReleased under the MIT License."), (3, "the license"), (4, None)]
    out = {r.doc_id: (r.licenses, r.unmatched) for r in license_rules.result(docs_of(rows)).collect()}
    assert out[1] == ("MIT,All-rights-reserved", "mit-notice")
    assert out[2] == ("MIT,CC-BY-NC-4.0", "") and out[3] == ("", "") and out[4] == ("", "")


def test_fixity_finds_all_damage(spark, rng):
    rows = [(rng.randrange(3), i * 700, 600, rng.randbytes(8).hex(), i) for i in range(2000)]
    sound = spark.createDataFrame(rows, "archive int, offset long, length long, digest string, record_id long")
    kind = F.col("record_id") % 400
    second = sound.where(kind != 7).withColumn("digest", F.when(kind == 9, "bad").otherwise(F.col("digest")))
    out = {(r.record_id, r.status) for r in fixity.audit(sound, second).collect()}
    assert out == {(i, "missing") for i in range(7, 2000, 400)} | {(i, "changed") for i in range(9, 2000, 400)}
    assert {r.status for r in fixity.audit(second, sound).collect()} == {"extra", "changed"}
    assert fixity.audit(sound, sound).count() == 0 and fixity.audit(sound.limit(0), sound.limit(0)).count() == 0
    pages = spark.createDataFrame([(None, None, None), (1, "u", None), (1, "u", None), (2, None, "x")], "page_id long, url string, html string")
    assert fixity.result(pages).count() <= 4


def test_toxic_sentences_are_learned_from_documents(spark, docs_of, rng):
    def text(toxic):
        sentences = [" ".join(rng.choices("the of and in to it is on as at by".split(), k=9)) for _ in range(8)]
        if toxic:
            sentences[3] += " idiot"
        return ". ".join(sentences) + "."

    rows = [(i, text(i % 4 == 0)) for i in range(600)] + [(1000, None), (1001, ""), (None, "idiot")]
    labels = spark.createDataFrame([(i, int(i % 4 == 0)) for i in range(600)] + [(5, None), (4, 1)], "doc_id long, toxic int")
    docs = docs_of(rows)
    out = {r.doc_id: r for r in toxicity.result(docs, labels).collect()}
    held = [i for i in range(600) if out[i].held_out]
    assert held and all(out[i].predicted == (i % 4 == 0) for i in held)
    assert out[1000].predicted == out[1001].predicted == 0 and all(0 <= r.score <= 1 for r in out.values())
    model = toxicity.train(docs, labels)
    blamed = toxicity.offending_sentences(docs.where("doc_id = 8"), model).collect()
    assert len(blamed) == 1 and "idiot" in blamed[0].sentence
    assert toxicity.clean_documents(docs, labels).columns == docs.columns
    assert toxicity.result(docs, labels.limit(0)).where("predicted = 1").count() == 0
    assert toxicity.result(docs.limit(0), labels).count() == 0


def test_long_values_and_many_spans_take_linear_time():
    start = time.perf_counter()
    secrets.guess_cost("qw" * 50_000, {})
    spans = secrets.find("password=aaaaaaaaaaaaa secret=Zk8!vQ2#xL ; " * 3000, {})
    assert time.perf_counter() - start < 30
    assert sum(kind == "assign" for _, _, kind, _ in spans) == 3000
    assert sum(kind == "guess" for _, _, kind, _ in spans) == 3000
