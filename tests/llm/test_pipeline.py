"""The pipeline and its stages against a brute-force chain, with planted copies, toxic documents and odd ids."""

import math
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from market_engine.llm import exact_dedup, mixing, near_copies, toxicity

COMMON = "the of and in to it is on as at by for with was from this that are or an".split()


def prose(rng, n, letters="abcdefghijklmno"):
    return ["".join(rng.choices(letters, k=rng.randint(2, 8))) if rng.random() < 0.6 else rng.choice(COMMON) for _ in range(n)]


def changed(rng, words, n):
    words = list(words)
    for at in rng.sample(range(len(words)), n):
        words[at] = "changed" + str(rng.randrange(10**6))
    return words


@pytest.fixture
def corpus(rng):
    """(doc_id, text, lang, source), and the doc_ids that are toxic."""
    rows, toxic = [], set()
    for i in range(300):
        words = prose(rng, rng.randint(30, 120))
        if i % 6 == 0:
            words.insert(rng.randrange(len(words)), "idiot")
            toxic.add(i)
        rows.append((i, ". ".join(" ".join(words[k : k + 9]) for k in range(0, len(words), 9)), "en", rng.choice("aaab") if i % 9 else None))
    clean = [r for r in rows if r[0] not in toxic]
    for k in range(25):  # exact copies but for white space, and copies with two words changed
        base = rng.choice(clean)
        rows.append((1000 + k, base[1].replace(" ", rng.choice(["  ", "\n"])), "en", "b"))
    for k in range(25):
        base = rng.choice([r for r in clean if len(r[1].split()) > 90])
        rows.append((2000 + k, " ".join(changed(rng, base[1].split(), 1)), "en", "c"))
    variants = prose(rng, 150)
    rows += [(3000 + k, " ".join(changed(rng, variants, 1)), "en", "a") for k in range(60)]
    rows += [(None, " ".join(prose(rng, 40)), "en", "a") for _ in range(5)] + [(7, " ".join(prose(rng, 40)), "de", "b") for _ in range(2)]
    rows += [(4000, None, "en", "a"), (4001, "", None, None), (4002, "solo", "en", None), (4003, "Solo", "en", "a")]
    return rows, toxic


def shingles(text):
    words = (text or "").lower().split()
    return {tuple(words[i : i + 5]) for i in range(len(words) - 4)} or ({tuple(words)} if words else set())


def one_of_each_group(rows):
    """Groups of a Jaccard of 0.8 by all pairs; the smallest doc_id stays, None last."""
    found = [shingles(r[1]) for r in rows]
    parent = list(range(len(rows)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            same = (rows[i][1] or "") == (rows[j][1] or "")
            if same or (found[i] and len(found[i] & found[j]) >= 0.8 * len(found[i] | found[j])):
                parent[root(i)] = root(j)
    groups = defaultdict(list)
    for i, r in enumerate(rows):
        groups[root(i)].append(r)
    return [min(g, key=lambda r: (r[0] is None, r[0] or 0)) for g in groups.values()]


def first_of_equal(rows):
    groups = defaultdict(list)
    for r in rows:
        groups[re.sub(r"[\x20\x09-\x0D]+", " ", r[1] or "")].append(r)
    return [min(g, key=lambda r: (r[0] is None, r[0] or 0)) for g in groups.values()]


def ids(rows):
    return Counter((r[0], r[1]) for r in rows)


def rows_of(df):
    return [tuple(r) for r in df.select("doc_id", "text", "lang", "source").collect()]


def same_survivors(got, expected):
    """Of texts that tie on the doc_id either may stay."""
    assert Counter(r[0] for r in got) == Counter(r[0] for r in expected)
    unnamed = {None, 7}
    assert ids(r for r in got if r[0] not in unnamed) == ids(r for r in expected if r[0] not in unnamed)


@pytest.mark.parametrize("limit", [near_copies.PAIR_LIMIT, 2])
def test_near_copies_leave_one_of_each_group(docs_of, corpus, limit):
    rows, _ = corpus
    docs = docs_of(rows)
    kept = rows_of(near_copies.keep_one(docs, limit))
    same_survivors(kept, one_of_each_group(rows))
    extra = docs.selectExpr("*", "1 as id", "2 as a", "3 as bits", "4 as `group`", "5 as listing")
    out = near_copies.keep_one(extra, limit)
    assert out.columns == extra.columns and ids(rows_of(out)) == ids(kept)


def test_all_links_are_found_whatever_is_compared_first(docs_of, corpus, monkeypatch):
    """With no pairs from pivots and few from the first comparison, the pairs of the rest make the same groups."""
    rows, _ = corpus
    monkeypatch.setattr(near_copies, "_nearest", lambda pairs: pairs.where("a % 5 = 0").select("a", "b"))
    monkeypatch.setattr(near_copies, "close_pairs", lambda ids, prints: set())
    monkeypatch.setattr(near_copies, "TILE", 16, raising=False)
    same_survivors(rows_of(near_copies.keep_one(docs_of(rows), 2)), one_of_each_group(rows))


def test_the_pipeline_hands_python_small_batches(spark, docs_of, monkeypatch):
    name, seen = "spark.sql.execution.arrow.maxRecordsPerBatch", []
    before = spark.conf.get(name)

    def stage(session, docs, folder):
        seen.append(int(session.conf.get(name)))
        return docs

    monkeypatch.setattr(corpus_pipeline, "read", lambda *_: docs_of([(1, "a text")]))
    monkeypatch.setattr(corpus_pipeline, "STAGES", [("one", stage)])
    assert corpus_pipeline.run(spark, "").count() == 1
    assert seen == [1000] and spark.conf.get(name) == before


@pytest.mark.parametrize("stage, module, work", [("simhash", near_copies, "keep_one"), ("packing", corpus_pipeline.packing, "pack")])
def test_a_stage_on_its_own_hands_python_small_batches(spark, docs_of, monkeypatch, stage, module, work):
    name, seen = "spark.sql.execution.arrow.maxRecordsPerBatch", []
    before = spark.conf.get(name)

    def watched(docs):
        seen.append(int(spark.conf.get(name)))
        return docs

    monkeypatch.setattr(module, work, watched)
    assert dict(corpus_pipeline.STAGES)[stage](spark, docs_of([(1, "a text")]), "").count() == 1
    assert seen == [1000] and spark.conf.get(name) == before


def test_unrelated_documents_without_ids_all_stay(docs_of, rng):
    rows = [(i, " ".join(prose(rng, 30))) for i in [None] * 5 + [3, 3, 4]]
    assert ids(rows_of(near_copies.keep_one(docs_of(rows)))) == ids(rows)
    again = rows + rows
    assert ids(rows_of(near_copies.keep_one(docs_of(again)))) == ids(rows)
    assert near_copies.keep_one(docs_of([])).count() == 0


def test_very_long_and_very_many(docs_of, rng):
    long = prose(rng, 40_000)
    rows = [(1, " ".join(long)), (2, " ".join(changed(rng, long, 300))), (3, " ".join(changed(rng, long, 30_000)))]
    rows += [(10 + i, "same words in every one of these texts") for i in range(400)]
    assert sorted(r[0] for r in rows_of(near_copies.keep_one(docs_of(rows)))) == [1, 3, 10]


@pytest.mark.parametrize("n", [10, 64, 65, 700])
def test_pivots_find_close_fingerprints(n):
    """Clusters, scattered prints and repeated ids; every member of a cluster is linked to the rest of it."""
    numbers = np.random.default_rng(n)
    prints = numbers.integers(0, 256, (n, 64), dtype=np.uint8)
    cluster = numbers.permutation(n)[: n // 2]
    flips = np.packbits(numbers.random((len(cluster), 512)) < 0.05, axis=1)
    prints[cluster] = prints[cluster[0]] ^ flips
    ids = numbers.permutation(10 * n)[:n].astype(np.int64)
    found = near_copies.close_pairs(ids, prints.view(np.uint64))
    parent = {int(i): int(i) for i in ids}

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for a, b in found:
        assert a < b
        parent[root(a)] = root(b)
    inside = {int(ids[c]) for c in cluster}
    assert all({a, b} <= inside for a, b in found) and len({root(i) for i in inside}) == 1
    assert len(found) <= n * n / 2 if n <= 64 else len(found) < 40 * n


def words_by_source(rows):
    out = Counter()
    for r in rows:
        out[r[3]] += len((r[1] or "").split())
    return out


def test_the_mix_meets_its_targets_with_whole_documents(docs_of, rng):
    rows = [(None, f"{i} " + "w " * 99, "en", "a") for i in range(10)] + [(i, "x " * rng.randint(1, 50), "en", "b") for i in range(300)]
    rows += [(1000, "long " * 20_000, "en", "c"), (1001, "y " * 700, "en", None), (1002, None, "en", "d"), (1003, "tiny", "en", "e")]
    rows += [(2000, "copy " * 40, "en", "f")] * 30
    docs = docs_of(rows)
    out = rows_of(mixing.mixed_documents(docs))
    targets = {r.source: r.target for r in mixing.taken(mixing.mix(docs)).collect()}
    got = words_by_source(out)
    for source, target in targets.items():
        largest = max(len((r[1] or "").split()) for r in rows if r[3] == source)
        assert abs(got[source] - target) <= largest, source
        assert got[source] > 0 or target < 1
    before, after = Counter(rows), Counter(out)
    assert all(n <= 3 * before[r] for r, n in after.items())
    whole = {s: words_by_source(rows)[s] for s in targets}
    for r, n in before.items():  # what a source takes in full is there that often
        if r[1] and targets[r[3]] >= 2 * whole[r[3]]:
            assert after[r] >= 2 * n
    assert Counter(rows_of(mixing.mixed_documents(docs_of(rows[::-1])))) == after
    extra = docs.selectExpr("*", "1 as size", "2 as target", "3 as copies", "4 as rows", "5 as digest", "6 as start")
    assert Counter(rows_of(mixing.mixed_documents(extra))) == after
    assert mixing.mixed_documents(docs.limit(0)).count() == 0


def test_a_crowded_listing_gives_no_more_than_two_pairs_a_text():
    """Copies of three texts in one listing: each gives its closest pairs, with their bits, and none of unlike size."""
    rng = np.random.default_rng(4)
    base = rng.integers(0, 2**63, (3, 8), dtype=np.uint64)
    of = np.arange(600) % 3
    prints = base[of].copy()
    prints[np.arange(600), rng.integers(0, 8, 600)] ^= np.uint64(1) << rng.integers(0, 63, 600).astype(np.uint64)
    ids = rng.permutation(600) - 300
    sizes = np.where(np.arange(600) < 300, 100, 50)
    every = near_copies.close_pairs(ids, prints)
    found = near_copies.nearest_pairs(ids, prints, sizes, 0.8)
    at = {v: i for i, v in enumerate(ids.tolist())}
    alike = {(a, b) for a, b in every if sizes[at[a]] == sizes[at[b]]}
    assert {(a, b) for a, b, _ in found} <= alike < every
    assert {v for p in alike for v in p} == {v for a, b, _ in found for v in (a, b)}
    bits = {(a, b): int(np.bitwise_count(prints[at[a]] ^ prints[at[b]]).sum()) for a, b in alike}
    assert all(bits[a, b] == n for a, b, n in found) and len(found) <= 2 * len(ids)
    for v in ids.tolist():
        for side in (0, 1):
            mine = [bits[p] for p in alike if p[side] == v]
            assert not mine or min(mine) in {n for *p, n in found if p[side] == v}
    assert near_copies.nearest_pairs(ids[:1], prints[:1], sizes[:1], 0.8) == set()


def clusters_of_prints(rng, n, clusters):
    base = rng.integers(0, 2**63, (clusters, 8), dtype=np.uint64)
    prints = base[np.arange(n) % clusters].copy()
    for _ in range(6):
        prints[np.arange(n), rng.integers(0, 8, n)] ^= np.uint64(1) << rng.integers(0, 63, n).astype(np.uint64)
    return prints


def test_small_listings_are_compared_in_place():
    """All close pairs of each listing, with their bits; of them each text's closest on either side; none within a group."""
    rng = np.random.default_rng(5)
    lengths = [1, 16, 2, 9, 1, 13]
    listings = np.repeat(np.array([-4, -2, 0, 3, 8, 9]), lengths)
    prints, sizes = clusters_of_prints(rng, len(listings), 2), np.where(np.arange(len(listings)) % 3 == 0, 50, 100)
    pairs = [(i, j) for i in range(len(listings)) for j in range(i + 1, len(listings)) if listings[i] == listings[j] and sizes[i] == sizes[j]]
    bits = {(i, j): int(np.bitwise_count(prints[i] ^ prints[j]).sum()) for i, j in pairs}
    expected = {p: n for p, n in bits.items() if n <= near_copies.DISTANCE}
    assert 0 < len(expected) < len(bits)

    def found(function, *more):
        left, right, n = function(listings, prints, sizes, 0.8, *more)
        assert len({*zip(left.tolist(), right.tolist())}) == len(left)
        return dict(zip(zip(left.tolist(), right.tolist()), n.tolist()))

    assert found(near_copies.close_in_listings) == expected
    groups = rng.integers(0, 2, len(listings))
    assert found(near_copies.close_in_listings, groups) == {(i, j): n for (i, j), n in expected.items() if groups[i] != groups[j]}
    closest = found(near_copies.closest_in_listings)
    assert closest.items() < expected.items() and len(closest) <= 2 * len(listings)
    for row in range(len(listings)):
        for side in (0, 1):
            mine = [n for p, n in expected.items() if p[side] == row]
            assert not mine or min(mine) in {n for p, n in closest.items() if p[side] == row}


def test_small_listings_give_no_more_than_two_pairs_a_text(spark):
    """Variants of one text in many small listings; a row for each listing and text at most, not for each pair."""
    rng = np.random.default_rng(6)
    prints = clusters_of_prints(rng, 64, 1).view(np.int64)
    rows = [(i, *prints[i].tolist(), 100) for i in range(64)]
    schema = ", ".join(f"{c} long" for c in ("id", *near_copies._PARTS, "shingles"))
    crowd = [(i, n * 100 + i // 16, 16) for n in range(3) for i in range(64)]
    df, listed = spark.createDataFrame(rows, schema), spark.createDataFrame(crowd, "id long, listing long, members long")
    found = near_copies._of_few(df, listed, 16, 0.8).collect()
    assert 12 * 15 <= len(found) <= 2 * len(crowd) < 12 * 120
    assert {r.listing for r in found} == {listing for _, listing, _ in crowd} and all(r.a < r.b for r in found)


def test_bucket_counts_pass_every_similar_pair():
    """Of sets around the similarity those that reach it always pass, nearly all that miss it clearly do not, and full buckets pass."""
    rng, similarity = np.random.default_rng(7), 0.8
    passed = {True: [], False: []}
    for n in [1, 2, 5, 30, 100, 400]:
        for changed_part in np.linspace(0, 0.3, 13):
            a = {f"{n} {i}".encode() for i in range(n)}
            keep = [s for s in a if rng.random() >= changed_part]
            b = {*keep, *[f"new {rng.integers(10**9)}".encode() for _ in range(n - len(keep))]}
            jaccard = len(a & b) / max(len(a | b), 1)
            counts = [near_copies.bucket_counts(near_copies.hashes_of(s))[None, :] for s in (a, b)]
            sizes = [np.array([len(s)]) for s in (a, b)]
            passed[jaccard >= similarity].append(bool(near_copies.may_be_similar(*counts, *sizes, similarity)[0]))
    assert all(passed[True]) and sum(passed[False]) < len(passed[False]) / 3
    full = near_copies.bucket_counts(np.zeros(2000, np.uint64))[None, :]
    assert full.max() == near_copies.FULL
    assert near_copies.may_be_similar(full, full, np.array([2000]), np.array([2000]), similarity).all()


def test_a_small_target_leaves_one_document(docs_of):
    """A source whose target is less than half of its first document."""
    rows = [(1, "long " * 5000, "en", "b")] + [(i, "w " * 20, "en", "a") for i in range(2, 60)]
    out = rows_of(mixing.mixed_documents(docs_of(rows)))
    assert [r[0] for r in out if r[3] == "b"] == [1]


def test_the_fitted_sample_is_bounded_whatever_the_ids(spark, docs_of, rng):
    rows = [(1, " ".join(prose(rng, 20)), "en", "s") for _ in range(300)] + [(i, " ".join(prose(rng, 20)), "en", "s") for i in range(2, 200)]
    labels = spark.createDataFrame([(i, i % 2) for i in range(200)], "doc_id long, toxic int")
    seen = []
    fit = toxicity.fit
    toxicity.fit = lambda sample, *a: seen.append(len(sample.toxic)) or fit(sample, *a)
    try:
        toxicity.train(docs_of(rows), labels, max_sample=45)
    finally:
        toxicity.fit = fit
    assert 30 <= seen[0] <= 45


def test_toxic_documents_go(spark, docs_of, corpus):
    rows, toxic = corpus
    labels = spark.createDataFrame([(i, int(i in toxic)) for i in range(300)], "doc_id long, toxic int")
    docs = docs_of(rows)
    kept = rows_of(toxicity.clean_documents(docs, labels))
    gone = ids(rows) - ids(kept)
    assert {i for i, _ in gone} == toxic and sum(gone.values()) == len(toxic)
    scores = toxicity.train(docs, labels).score([r[1] or "" for r in rows])
    assert ids(kept) == ids(r for r, s in zip(rows, scores) if s < 0.5)
    assert toxicity.clean_documents(docs.limit(0), labels).count() == 0


def test_exact_copies_go(docs_of, corpus):
    rows, _ = corpus
    docs = docs_of(rows)
    kept = rows_of(exact_dedup.drop_duplicates(docs))
    same_survivors(kept, first_of_equal(rows))
    extra = docs.selectExpr("*", "1 as digest", "2 as keep_id", "3 as kept")
    assert ids(rows_of(exact_dedup.drop_duplicates(extra))) == ids(kept)
    assert exact_dedup.drop_duplicates(docs.limit(0)).count() == 0


def test_the_whole_pipeline(spark, docs_of, corpus, tmp_path):
    rows, toxic = corpus
    folder = str(tmp_path)
    docs = docs_of(rows)
    docs.withColumn("n_chars", F.length("text").cast("long")).write.parquet(f"{folder}/documents.parquet")
    labels = spark.createDataFrame([(i, int(i in toxic)) for i in range(300)], "doc_id long, toxic int")
    labels.write.parquet(f"{folder}/labels.parquet")
    expected = one_of_each_group(first_of_equal([r for r in rows if r[0] not in toxic]))
    mixed = rows_of(mixing.mixed_documents(docs_of(expected)))
    out = corpus_pipeline.run(spark, folder)
    pieces = out.collect()
    whole = Counter(r.doc_id for r in pieces if r.piece == 0)
    unnamed = {None, 7}
    assert {i: n for i, n in whole.items() if i not in unnamed} == {i: n for i, n in Counter(r[0] for r in mixed).items() if i not in unnamed}
    assert not toxic & set(whole)
    used = Counter()
    for r in pieces:
        used[r.sequence_id] += r.length
    assert max(used.values()) <= 1024 and len(used) <= 1.2 * math.ceil(sum(used.values()) / 1024) + 1
    assert [name for name, _ in corpus_pipeline.STAGES] == ["toxicity", "exact_dedup", "simhash", "mixing", "packing"]
