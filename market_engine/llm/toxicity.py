"""Toxic documents by multiple-instance learning: sentences are scored, a noisy-or makes the document.

Only documents are labelled. A sentence with words x is toxic with probability p = sigmoid(bias + w.x); a
document is clean if its label is not noise (the leak) and no sentence is toxic, so its probability is
1 - (1 - leak) * product(1 - p). Bias, weights and leak are fitted together to the document labels; which
sentences are to blame follows from the fit.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import hash31, text_of

FOLDS = 5
#: At most so many labelled documents are fitted, none of them longer than so many characters.
MAX_SAMPLE = 12_000
MAX_SAMPLE_CHARS = 20_000
#: Words with a weight, and the number of sampled documents a word must be in.
MAX_WORDS = 4096
MIN_DOCUMENTS = 4

_SENTENCE = re.compile(r"[^.!?\n]+")
_WORD = re.compile(rb"[a-z0-9\x80-\xff]+")


def words_of(sentence: str) -> list[int]:
    return list(map(zlib.crc32, _WORD.findall(sentence.lower().encode("utf-8", "replace"))))


@dataclass
class Model:
    """Weights by the CRC-32 of a word, sorted; `bias` of a sentence, `leak` of a document."""

    words: np.ndarray
    weights: np.ndarray
    bias: float
    leak: float

    def sentence_logits(self, sentences: list[list[int]]) -> np.ndarray:
        logits = np.full(len(sentences), self.bias)
        if not len(self.words) or not sentences:
            return logits
        sizes = np.fromiter(map(len, sentences), np.int64, len(sentences))
        flat = np.fromiter((w for s in sentences for w in s), np.int64, int(sizes.sum()))
        at = np.minimum(np.searchsorted(self.words, flat), len(self.words) - 1)
        hit = self.words[at] == flat
        # A word counts once in a sentence.
        pairs = np.unique(np.repeat(np.arange(len(sentences)), sizes)[hit] * len(self.words) + at[hit])
        np.add.at(logits, pairs // len(self.words), self.weights[pairs % len(self.words)])
        return logits

    def score(self, texts: list[str], together: int = 256) -> np.ndarray:
        """The probability of each text, computed for a few at a time to bound memory."""
        parts = [self._score(texts[i : i + together]) for i in range(0, len(texts), together)]
        return np.concatenate(parts) if parts else np.zeros(0)

    def _score(self, texts: list[str]) -> np.ndarray:
        sentences, owner = [], []
        for i, text in enumerate(texts):
            found = [words_of(m) for m in _SENTENCE.findall(text)]
            sentences += found
            owner += [i] * len(found)
        clean = -np.logaddexp(0, self.sentence_logits(sentences))
        total = np.bincount(np.array(owner, dtype=np.int64), weights=clean, minlength=len(texts))
        return 1 - (1 - self.leak) * np.exp(total[: len(texts)])


# Fitting ------------------------------------------------------------------------------------------------


@dataclass
class Sample:
    """Flat arrays: the toxic label and the number of sentences of each document, the number of words of each
    sentence, and the words, each once in a sentence."""

    toxic: np.ndarray
    sentences: np.ndarray
    sizes: np.ndarray
    words: np.ndarray


def fit(sample: Sample, rounds: int = 400, rate: float = 0.05) -> Model:
    y = sample.toxic.astype(float)
    if not len(y) or not y.any():
        return Model(np.zeros(0, np.int64), np.zeros(0), -12.0, 0.0)
    words, weights = _choose_words(sample)
    sentence = len(sample.sizes)
    owner = np.repeat(np.arange(len(y), dtype=np.int32), sample.sentences)
    at = np.searchsorted(words, sample.words).astype(np.int32)
    np.minimum(at, max(len(words) - 1, 0), out=at)
    known = words[at] == sample.words if len(words) else np.zeros(len(at), bool)
    rows = np.repeat(np.arange(sentence, dtype=np.int32), sample.sizes)[known]
    columns = at[known]
    theta = np.concatenate([weights, [-6.0, -4.0]])
    moment, square = np.zeros_like(theta), np.zeros_like(theta)
    penalty = np.concatenate([np.full(len(weights), 0.02), [0.0, 0.0]])
    for step in range(1, rounds + 1):
        w, bias, leak = theta[:-2], theta[-2], _sigmoid(theta[-1])
        z = bias + np.bincount(rows, weights=w[columns], minlength=sentence)
        p = _sigmoid(z)
        clean = np.log1p(-leak) + np.bincount(owner, weights=-np.logaddexp(0, z), minlength=len(y))
        q = np.exp(clean)
        # The slope of the loss in log(q): q / (1 - q) for a toxic document, -1 for a clean one.
        slope = np.where(y > 0, q / np.maximum(1 - q, 1e-9), -1.0)
        dz = -p * slope[owner]
        grad = np.empty_like(theta)
        grad[:-2] = np.bincount(columns, weights=dz[rows], minlength=len(w))
        grad[-2] = dz.sum()
        grad[-1] = (-slope * leak).sum()
        grad += penalty * theta
        moment = 0.9 * moment + 0.1 * grad
        square = 0.999 * square + 0.001 * grad * grad
        theta -= rate * (moment / (1 - 0.9**step)) / (np.sqrt(square / (1 - 0.999**step)) + 1e-8)
    return Model(words.astype(np.int64), theta[:-2].copy(), float(theta[-2]), float(_sigmoid(theta[-1])))


def _sigmoid(x):
    return 1 / (1 + np.exp(-np.clip(x, -40, 40)))


def _choose_words(sample: Sample) -> tuple[np.ndarray, np.ndarray]:
    """The words most unevenly spread over the labels, and weights to begin with."""
    doc = np.repeat(np.arange(len(sample.toxic), dtype=np.int64), sample.sentences)
    pairs = np.repeat(doc << 32, sample.sizes)
    pairs |= sample.words
    pairs.sort()
    pairs = pairs[np.diff(pairs, prepend=-1) != 0]
    y = sample.toxic[pairs >> 32].astype(bool)
    pairs &= 0xFFFFFFFF
    vocabulary, count = np.unique(pairs, return_counts=True)
    often = count >= MIN_DOCUMENTS
    vocabulary, count = vocabulary[often], count[often]
    found, n = np.unique(pairs[y], return_counts=True)
    at = np.minimum(np.searchsorted(found, vocabulary), max(len(found) - 1, 0))
    toxic = np.where(found[at] == vocabulary, n[at], 0) if len(found) else np.zeros(len(vocabulary))
    share = sample.toxic.mean()
    lift = (toxic - count * share) / np.sqrt(count * share * (1 - share) + 1e-9)
    chosen = np.sort(np.argsort(-np.abs(lift), kind="stable")[:MAX_WORDS])
    odds = np.log((toxic + share) / (count - toxic + 1 - share)) - np.log(share / (1 - share + 1e-9))
    return vocabulary[chosen].astype(sample.words.dtype), np.clip(odds[chosen], 0, 4)


# The operator -------------------------------------------------------------------------------------------


def fold(doc_id: Column) -> Column:
    return F.crc32(doc_id.cast("string").cast("binary")) % FOLDS


def train(docs: DataFrame, labels: DataFrame, max_sample: int = MAX_SAMPLE) -> Model:
    """Fit on labelled documents outside fold 0; a document labelled twice is toxic if either label says so.

    Beyond `max_sample` labels those with the smallest hash of the doc_id are used. Of several documents with one
    doc_id the label stands for one only, that with the smallest hash of its text; so no more than `max_sample` rows
    go to the driver.
    """
    usable = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("toxic").cast("int").alias("toxic"))
    usable = usable.where((fold(F.col("doc_id")) != 0) & F.col("toxic").isNotNull())
    usable = usable.groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    sample = usable.orderBy(hash31("doc_id"), "doc_id").limit(max_sample)

    def split(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            found = [[set(words_of(m)) for m in _SENTENCE.findall(text)] for text in batch["text"]]
            sizes = [np.array([len(s) for s in doc], dtype=np.int32) for doc in found]
            words = [np.array([w for s in doc for w in sorted(s)], dtype=np.int64) for doc in found]
            signed = [(w - (1 << 31)).astype(np.int32) for w in words]
            yield pd.DataFrame({"toxic": batch["toxic"], "sizes": sizes, "words": signed})

    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_of().alias("text"))
    texts = texts.where(F.length("text") <= MAX_SAMPLE_CHARS)
    # The sample is bounded by `max_sample` rows of two numbers.
    found = texts.join(F.broadcast(sample), "doc_id")
    one = F.row_number().over(Window.partitionBy("doc_id").orderBy(F.xxhash64("text"), "text"))
    joined = found.withColumn("_copy", one).where("_copy = 1").orderBy("doc_id")
    rows = joined.select("toxic", "text").mapInPandas(split, "toxic int, sizes array<int>, words array<int>").toArrow()
    return fit(_flat(rows))


def _flat(rows: pa.Table) -> Sample:
    toxic, sizes, words = (rows[c].combine_chunks() for c in ("toxic", "sizes", "words"))
    flat = words.flatten().to_numpy(zero_copy_only=False).astype(np.int32).view(np.uint32) ^ np.uint32(1 << 31)
    sentences = sizes.value_lengths().to_numpy(zero_copy_only=False)
    return Sample(toxic.to_numpy(zero_copy_only=False), sentences, sizes.flatten().to_numpy(zero_copy_only=False), flat)


def with_score(docs: DataFrame, model: Model, column: str = "score") -> DataFrame:
    """The documents with the probability of being toxic; only the text is an input."""

    @F.pandas_udf("double")
    def scored(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            yield pd.Series(model.score(list(texts)), dtype="float64")

    return docs.withColumn(column, scored(text_of()))


def offending_sentences(docs: DataFrame, model: Model, at_least: float = 0.5) -> DataFrame:
    """doc_id, start, end (characters, end exclusive), sentence, score: the sentences to blame."""

    def located(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for doc_id, text in zip(batch["doc_id"], batch["text"]):
                found = list(_SENTENCE.finditer(text))
                p = _sigmoid(model.sentence_logits([words_of(m.group()) for m in found]))
                out += [(doc_id, m.start(), m.end(), m.group(), float(x)) for m, x in zip(found, p) if x >= at_least]
            frame = pd.DataFrame(out, columns=["doc_id", "start", "end", "sentence", "score"])
            yield frame.astype({"doc_id": "Int64", "start": "int64", "end": "int64", "score": "float64"})

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_of().alias("text"))
    return rows.mapInPandas(located, "doc_id long, start long, end long, sentence string, score double")


def result(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score, predicted.

    NULL and empty texts are scored from the leak alone. Without toxic labels every score is near 0. held_out is
    NULL for a NULL doc_id. Other columns, and rows that repeat, change nothing.
    """
    model = train(docs, labels)
    number = F.col("doc_id").cast("long")
    scored = with_score(docs.select(number.alias("doc_id"), "text"), model)
    return scored.select(
        "doc_id", (fold(number) == 0).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted")
    )


def clean_documents(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The documents with a score under 0.5, with all their columns.

    Every row is judged by its own text, NULL as empty, whatever its doc_id; an empty table gives an empty one, and
    without toxic labels all stay.
    """
    scored = with_score(docs, train(docs, labels), "_llm_score")
    return scored.where("_llm_score < 0.5").select(*docs.columns)

