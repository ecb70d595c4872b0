"""Pieces against the tokenizer itself, places against the rules."""

import random
import zlib
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from market_engine.llm import packing
from market_engine.llm.tokens import Encoder, shared_encoder

PATH = packing.default_tokenizer()


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(PATH)


@settings(max_examples=300, deadline=None)
@given(
    st.text(
        st.one_of(
            st.sampled_from(" \t\n\r\x0b\x1c\x85\xa0'stvrmdlEe9½²ß×÷ǅ“”–…€日 ªº_-"),
            st.characters(max_codepoint=0x250, exclude_categories=["Cs"]),
        ),
        max_size=60,
    )
)
def test_ids_equal_the_tokenizers(text):
    own = _encoder()
    assert own.ids(text) == np.array(own.tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()


def _encoder(made=[]):
    if not made:
        made.append(Encoder(PATH))
    return made[0]


def test_memory_starts_anew(monkeypatch):
    monkeypatch.setattr("market_engine.llm.tokens.REMEMBERED", 3)
    encoder = Encoder(PATH)
    for text in ("one two three four five", "six seven", "one two eight", "<|endoftext|> nine"):
        assert encoder.ids(text) == np.array(encoder.tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()


@pytest.mark.parametrize(
    "text", ["a  b", "a \n\n b \t\n", "\n\n\n", "  a's  'tis ", "a\u00a0\u00a0b", "it'll  \r\n9  --", "", " ", "x\n y\x85  z" * 50]
)
@pytest.mark.parametrize("fast", [True, False])
def test_runs_of_white_space(text, fast):
    encoder = Encoder(PATH)
    encoder.pieces = encoder.pieces if fast else None
    assert encoder.ids(text) == np.array(encoder.tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()


def test_plain_texts_leave_no_memory_and_workers_share_an_encoder():
    encoder = shared_encoder(PATH)
    encoder.ids("these words are not remembered")
    assert not encoder.memory and shared_encoder(PATH) is encoder


@pytest.mark.parametrize("tokens, expected", [(1, [(0, 1)]), (8, [(0, 8)]), (9, [(0, 1), (1, 8)]), (16, [(0, 8), (8, 8)])])
def test_cuts(tokens, expected):
    assert packing.cuts(tokens, 8) == expected


def test_plan_places_every_piece_once_and_nearly_fills():
    rng = np.random.default_rng(3)
    histogram = np.bincount(np.minimum(rng.geometric(1 / 300, 20000), 1024), minlength=1025)
    histogram[0] = 0
    plan = packing.make_plan(histogram)
    lengths = np.repeat(np.arange(1025), histogram)
    ranks = np.concatenate([np.arange(n) for n in histogram])
    sequence, offset = plan.place(lengths, ranks)
    order = np.lexsort((offset, sequence))
    sequence, offset, lengths = sequence[order], offset[order], lengths[order]
    starts = np.r_[True, sequence[1:] != sequence[:-1]]
    assert (offset[starts] == 0).all()
    assert (offset[1:][~starts[1:]] == (offset + lengths)[:-1][~starts[1:]]).all()
    assert (offset + lengths).max() <= 1024
    assert plan.sequences == len(np.unique(sequence)) <= 1.002 * lengths.sum() / 1024
    assert plan.patterned > 0.3 * plan.sequences


@pytest.mark.parametrize("lengths", [[], [5], [1024] * 3, [600] * 7, [512] * 9, [1, 1023, 1024, 700, 324], [3] * 1000])
def test_plan_of_odd_histograms(lengths):
    plan = packing.make_plan(np.bincount(lengths, minlength=1025))
    assert plan.sequences == {0: 0}.get(len(lengths), -(-sum(lengths) // 1024) if 600 not in lengths else 7)


def test_pack(spark, tokenizer, docs_of):
    rng = random.Random(5)
    words = ["alpha", "beta's", "g5", "Straße", "日本", "...", "\n\n", "x\ty"]
    texts = [" ".join(rng.choices(words, k=rng.choice([0, 1, 3, 50, 400, 3000]))) for _ in range(80)] + ["", None, "same", "same"]
    rows = [(i, t) for i, t in enumerate(texts)] + [(None, "no id"), (3, texts[3])]
    out = packing.pack(docs_of(rows)).collect()
    expected = Counter()
    for doc_id, text in rows:
        ids = np.array(tokenizer.encode(text or "", add_special_tokens=False).ids + [2], "<u4")
        first = len(ids) % 1024 or min(1024, len(ids))
        for i, (a, b) in enumerate(zip([0, *range(first, len(ids), 1024)], [*range(first, len(ids), 1024), len(ids)])):
            expected[doc_id, i, a, b - a, zlib.crc32(ids[a:b].tobytes())] += 1
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in out) == expected
    by_sequence = {}
    for r in out:
        by_sequence.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for held in by_sequence.values():
        at = 0
        for offset, length in sorted(held):
            assert offset == at
            at += length
        assert at <= 1024


def test_empty_table(docs_of):
    assert packing.pack(docs_of([])).collect() == []
