"""The corpus pipeline: toxic documents, exact and near copies go; sources are mixed and packed.

Each stage takes (spark, docs, sf_dir), works on all that the one before kept, and is written as Parquet and
read again before the next. All but the last return the columns of `documents`. The jobs that near copies and
packing run themselves hand Python few rows at a time also where a stage is called on its own.
"""

from __future__ import annotations

import os
import sys

from pyspark.sql import DataFrame, SparkSession

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from market_engine.llm import exact_dedup, mixing, near_copies, packing, toxicity  # noqa: E402
from market_engine.llm.common import read, small_batches, store  # noqa: E402


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a toxicity score under 0.5."""
    return toxicity.clean_documents(docs, read(spark, sf_dir, "labels"))


def drop_exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the document with the smallest doc_id."""
    return exact_dedup.drop_duplicates(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies, by five-word shingles and a similarity of 0.8, the document with the smallest doc_id."""
    with small_batches(spark):
        return near_copies.keep_one(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it whole; those it does not take go."""
    return mixing.mixed_documents(docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The place of every piece of every document in sequences of 1024 tokens."""
    with small_batches(spark):
        return packing.pack(docs)


STAGES = [
    ("toxicity", drop_toxic),
    ("exact_dedup", drop_exact_copies),
    ("simhash", drop_near_copies),
    ("mixing", mix_sources),
    ("packing", pack_sequences),
]

#: The first stage scores with a fitted model, the third hashes and the last tokenizes, which SQL cannot express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    # The workers of one stage live on into the next, beside a heap that has grown.
    with small_batches(spark):
        for name, stage in STAGES:
            docs = store(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
