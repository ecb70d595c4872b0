"""Lookups from many rows, some keys far more frequent than others, into one row per key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def lookup_table(df: DataFrame, keys: Sequence[str], *aggs: Column) -> DataFrame:
    """One row per key, laid out so that a join on the keys can be split where a key is hot.

    Adaptive execution splits a skewed join only if both of its inputs come straight from a shuffle. A
    table grouped by the join keys would already be partitioned by them and skip that shuffle, and the
    join would run a hot key as one task. Grouping by a hash beside the keys keeps the shuffle; it moves
    only one row per key.
    """
    grouped = df.groupBy(F.xxhash64(*keys).alias("_hash"), *keys)
    table = grouped.agg(*aggs) if aggs else grouped.agg(F.lit(True).alias("_present")).drop("_present")
    return table.drop("_hash")
