"""Language identification by string kernels: Nyström landmarks and one-versus-rest kernel ridge regression.

The kernel is a blended spectrum of presence kernels. For n = 1, 2, 3 let G(x) be the set of character n-grams
of a text in lower case; then k(x, y) is the mean over n of |G(x) & G(y)| / sqrt(|G(x)| |G(y)|). A regression
on all texts would need all pairs of them, so the kernel is taken against a bounded number of landmark texts
only (Nyström): with C the kernel of sample and landmarks, M that among the landmarks and Y one 0/1 column per
language, the coefficients A solve (C'C + ridge M) A = C'Y. Texts are scored in batches as presence matrix
times landmark matrix times A.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import hash31, store

ORDERS = 3
#: Bits of a character in a packed n-gram; characters count from 1, so that n-grams of all orders differ.
CHAR_BITS = 21
#: At most so many documents are fitted, so many of them landmarks, none longer than so many characters.
MAX_SAMPLE = 6_000
LANDMARKS = 256
MAX_SAMPLE_CHARS = 20_000
RIDGE = 1e-3
UNDETERMINED = "und"
FOLDS, HELD_OUT = 4, 2
#: Texts scored by one matrix product, and characters whose n-grams are sorted together.
BATCH = 64
PIECE = 1 << 20


# The kernel ---------------------------------------------------------------------------------------------


def spectrum(text: str) -> tuple[np.ndarray, np.ndarray]:
    """The distinct packed n-grams of each order, order by order, and how many each order has."""
    characters = np.frombuffer(text.lower().encode("utf-32-le", "replace"), dtype="<u4")
    parts: list[list[np.ndarray]] = [[] for _ in range(ORDERS)]
    # Pieces overlap by what an n-gram needs; they bound the memory that a very long text takes.
    for at in range(0, max(len(characters), 1), PIECE):
        piece = characters[at : at + PIECE + ORDERS - 1].astype(np.uint64) + np.uint64(1)
        packed = piece
        for n in range(ORDERS):
            if n:
                packed = (packed[:-1] << np.uint64(CHAR_BITS)) | piece[n:]
            parts[n].append(np.unique(packed))
    found = [p[0] if len(p) == 1 else np.unique(np.concatenate(p)) for p in parts]
    return np.concatenate(found), np.array([len(f) for f in found])


@dataclass
class Landmarks:
    """The landmarks' n-grams, sorted, and a row of each for every n-gram."""

    grams: np.ndarray
    matrix: np.ndarray

    @staticmethod
    def of(texts: list[str]) -> Landmarks:
        found = [spectrum(t)[0] for t in texts]
        grams = np.unique(np.concatenate(found)) if found else np.zeros(0, np.uint64)
        made = Landmarks(grams, np.zeros((len(grams), 0), np.float32))
        parts = [made.presence(texts[i : i + BATCH]) for i in range(0, len(texts), BATCH)]
        if parts:
            made.matrix = np.ascontiguousarray(np.concatenate(parts).T) / np.float32(ORDERS)
        return made

    def presence(self, texts: list[str]) -> np.ndarray:
        """A row per text and a column per n-gram: 1 / sqrt(|G(x)|) where the text has it, else 0."""
        rows = np.zeros((len(texts), len(self.grams)), np.float32)
        for row, text in zip(rows, texts):
            grams, sizes = spectrum(text)
            if not len(self.grams):
                continue
            at = np.minimum(np.searchsorted(self.grams, grams), len(self.grams) - 1)
            hit = self.grams[at] == grams
            weight = np.repeat(1 / np.sqrt(np.maximum(sizes, 1)), sizes).astype(np.float32)
            row[at[hit]] = weight[hit]
        return rows

    def kernel(self, texts: list[str]) -> np.ndarray:
        """k(text, landmark), by one matrix product for each batch of texts."""
        parts = [self.presence(texts[i : i + BATCH]) @ self.matrix for i in range(0, len(texts), BATCH)]
        return np.concatenate(parts) if parts else np.zeros((0, self.matrix.shape[1]), np.float32)


# Fitting ------------------------------------------------------------------------------------------------


@dataclass
class Model:
    landmarks: Landmarks
    languages: list[str]
    coefficients: np.ndarray

    def predict(self, texts: list[str | None]) -> tuple[list[str], np.ndarray]:
        """A language and a score for each text; `und` and 0 for those without a letter."""
        named = [UNDETERMINED] * len(texts)
        scores = np.zeros(len(texts))
        usable = [i for i, t in enumerate(texts) if t is not None and any(map(str.isalpha, t))]
        if self.languages and usable:
            values = self.landmarks.kernel([texts[i] for i in usable]) @ self.coefficients
            best = values.argmax(axis=1)
            for i, language in zip(usable, best):
                named[i] = self.languages[language]
            scores[usable] = np.clip(values[np.arange(len(usable)), best], 0, 1)
        return named, scores


def solve(kernel: np.ndarray, among: np.ndarray, languages: np.ndarray, ridge: float = RIDGE) -> np.ndarray:
    """The coefficients of every landmark (rows) for every language (columns)."""
    kernel, among = kernel.astype(float), among.astype(float)
    wanted = (languages[:, None] == np.arange(languages.max(initial=-1) + 1)).astype(float)
    normal = kernel.T @ kernel + ridge * len(kernel) * among
    # Repeated landmarks make the system singular; a little on the diagonal settles it.
    normal += 1e-6 * np.eye(len(among))
    return np.linalg.solve(normal, kernel.T @ wanted)


def fold(doc_id: Column) -> Column:
    return F.crc32(doc_id.cast("string").cast("binary")) % FOLDS


def sample_of(docs: DataFrame, max_sample: int = MAX_SAMPLE) -> DataFrame:
    """lang, rank and text of at most `max_sample` documents outside the held-out fold.

    Each language gives as many, those with the smallest hash of doc_id and text; documents alike in both count
    once. How many a language has tells below which hash they are to be found, so that only about those are
    shuffled with their texts.
    """
    number = F.col("doc_id").cast("long")
    rows = docs.select(
        number.alias("doc_id"), F.col("lang").cast("string").alias("lang"), F.col("text").cast("string").alias("text")
    )
    learnable = (F.coalesce(fold(F.col("doc_id")), F.lit(0)) != HELD_OUT) & (F.length("text") <= MAX_SAMPLE_CHARS)
    rows = rows.where(F.col("lang").isNotNull() & learnable & F.col("text").rlike(r"\p{L}"))
    rows = rows.select("lang", hash31("doc_id", "text").alias("hash"), "text")
    different = rows.groupBy("lang", "hash").agg(F.lit(1).alias("one"))
    sizes = store(different.groupBy("lang").agg(F.count("one").alias("documents")), "languages")
    quota = max(1, max_sample // max(sizes.count(), 1))
    # Chance leaves a few more or less below the bound; the margin makes less than the quota next to impossible.
    bound = F.col("documents").cast("double") / F.lit(1.3 * quota + 100)
    near = rows.join(sizes, "lang").where(F.col("hash") * bound <= float(1 << 31))
    single = near.groupBy("lang", "hash").agg(F.min("text").alias("text"))
    rank = F.row_number().over(Window.partitionBy("lang").orderBy("hash"))
    ranked = single.withColumn("rank", rank).where(F.col("rank") <= quota)
    return ranked.select("lang", "rank", "text").orderBy("rank", "lang").limit(max_sample)


def train(docs: DataFrame, max_sample: int = MAX_SAMPLE, landmarks: int = LANDMARKS) -> Model:
    """Fit on the sample, whose first texts, languages in turn, are the landmarks.

    To the driver go the landmarks' texts and one row of `landmarks` numbers for each text of the sample.
    """
    sample = store(sample_of(docs, max_sample), "sample")
    first = sample.orderBy("rank", "lang").limit(landmarks)
    chosen = Landmarks.of([r.text for r in first.collect()])

    def rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield pd.DataFrame({"lang": batch["lang"], "row": list(chosen.kernel(list(batch["text"])))})

    found = sample.select("lang", "text").mapInPandas(rows, "lang string, row array<float>").toArrow()
    names = found["lang"].to_pylist()
    languages = sorted(set(names))
    kernel = found["row"].combine_chunks().flatten().to_numpy(zero_copy_only=False)
    kernel = kernel.reshape(len(names), -1) if names else np.zeros((0, 0))
    place = {language: i for i, language in enumerate(languages)}
    among = chosen.matrix.T @ chosen.matrix * ORDERS
    return Model(chosen, languages, solve(kernel, among, np.array([place[n] for n in names], dtype=int)))


# The operator -------------------------------------------------------------------------------------------


def with_language(docs: DataFrame, model: Model) -> DataFrame:
    """The documents with `lang_pred` and `score`; only the text is an input."""

    @F.pandas_udf("lang_pred string, score double")
    def identified(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for texts in batches:
            languages, scores = model.predict([t if isinstance(t, str) else None for t in texts])
            yield pd.DataFrame({"lang_pred": languages, "score": scores})

    found = docs.withColumn("_llm_found", identified(F.col("text").cast("string")))
    return found.withColumns({c: F.col(f"_llm_found.{c}") for c in ("lang_pred", "score")}).drop("_llm_found")


def result(docs: DataFrame) -> DataFrame:
    """doc_id, held_out, lang_pred, score: a row for each document.

    A NULL text and one without a letter are `und` with score 0, and so is every text if no document can be
    learned from. held_out is NULL for a NULL doc_id, whose document may be learned from. An empty table gives
    an empty result. Repeated rows get the same prediction; other columns play no part.
    """
    number = F.col("doc_id").cast("long")
    found = with_language(docs.select(number.alias("doc_id"), "text"), train(docs))
    return found.select("doc_id", (fold(number) == HELD_OUT).alias("held_out"), "lang_pred", "score")
