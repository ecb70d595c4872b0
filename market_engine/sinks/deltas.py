"""Bronze tables that take a day's load without rewriting months, and are compacted later.

A load writes its own rows, by month, to a folder of its own, and then one row per month to the table's list of
contents. Only what is listed counts, so a load that breaks off leaves nothing behind but files nobody reads. Of
several rows with a key the latest load's counts: readers drop the others, but only in months that more than one
folder holds. Compaction writes such months anew as one folder, which stands for all loads up to a number; a load
that comes in meanwhile has a higher one and is not lost. One writer at a time adds loads.

The list has a row per load and month since the last compaction and is read by the driver.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import clean
from .tables import MONTH, clustered, with_month

CONTENTS = "load long, upto long, folder string, month string"
NO_MONTH = "none"


@dataclass(frozen=True)
class Part:
    """A month in a folder. ``upto`` is the last load it stands for; a compacted month has no ``load`` of its own."""

    load: int | None
    upto: int
    folder: str
    month: str


def contents(spark: SparkSession, path: str) -> list[Part]:
    """All that was ever listed; empty for a table that is not there."""
    try:
        rows = spark.read.schema(CONTENTS).parquet(f"{path}/contents").collect()
    except AnalysisException:
        return []
    return [Part(*r) for r in rows]


def live(parts: Sequence[Part]) -> dict[str, list[Part]]:
    """The parts of each month that count: the last compaction, and the loads after it in order."""
    months: dict[str, list[Part]] = {}
    for month in sorted({p.month for p in parts}):
        mine = [p for p in parts if p.month == month]
        bases = sorted((p for p in mine if p.load is None), key=lambda p: (p.upto, p.folder))[-1:]
        after = bases[0].upto if bases else -1
        months[month] = bases + sorted((p for p in mine if p.load is not None and p.load > after), key=lambda p: p.load)
    return months


def add(rows: DataFrame, path: str, keys: Sequence[str | Column], order: Sequence, date: str = "date", ticker: str = "ticker") -> int:
    """Add a load; of its own rows with one key the first in ``order`` counts. Returns the number of the load."""
    spark = rows.sparkSession
    number = max((p.upto for p in contents(spark, path)), default=0) + 1
    single = with_month(clean.first_per_key(rows, keys, order), date)
    _write(single.withColumn(MONTH, F.coalesce(MONTH, F.lit(NO_MONTH))), path, number, number, date, ticker)
    return number


def _write(rows: DataFrame, path: str, load: int | None, upto: int, date: str, ticker: str) -> None:
    spark = rows.sparkSession
    folder = uuid.uuid4().hex
    clustered(rows, MONTH, ticker, date).write.partitionBy(MONTH).parquet(f"{path}/data/{folder}")
    try:
        written = spark.read.parquet(f"{path}/data/{folder}")
    except AnalysisException:  # a load without rows writes no schema
        return
    if MONTH not in written.columns:
        return
    months = written.select(F.col(MONTH).cast("string")).distinct()
    listed = months.select(
        F.lit(load).cast("long").alias("load"), F.lit(upto).cast("long").alias("upto"), F.lit(folder).alias("folder"), MONTH
    )
    listed.coalesce(1).write.mode("append").parquet(f"{path}/contents")


def _rows(spark: SparkSession, path: str, parts: Sequence[Part]) -> DataFrame:
    """Rows of the parts with the number of their load; columns that a part lacks are NULL."""
    folders = [f"{path}/data/{p.folder}/{MONTH}={p.month}" for p in parts]
    rows = spark.read.option("mergeSchema", True).parquet(*folders)
    numbers = F.create_map(*[F.lit(x) for f, upto in {p.folder: p.upto for p in parts}.items() for x in (f, upto)])
    folder = F.regexp_extract(F.col("_metadata.file_path"), rf"/data/([0-9a-f]{{32}})/{MONTH}=", 1)
    month = F.regexp_extract(F.col("_metadata.file_path"), rf"/{MONTH}=([^/]*)/", 1)
    return rows.select(*[c for c in rows.columns if c != MONTH], numbers[folder].alias("_load"), month.alias(MONTH))


def read(spark: SparkSession, path: str, keys: Sequence[str | Column], months: Sequence[str] | None = None) -> DataFrame | None:
    """The table, one row per key, with its months; None if nothing was added.

    Months in one folder are read as they are, others are sorted out by key.
    """
    held = {m: parts for m, parts in live(contents(spark, path)).items() if parts and (months is None or m in months)}
    plain = [p for parts in held.values() if len(parts) == 1 for p in parts]
    mixed = [p for parts in held.values() if len(parts) > 1 for p in parts]
    found = [_rows(spark, path, plain)] if plain else []
    if mixed:
        found.append(clean.first_per_key(_rows(spark, path, mixed), keys, [F.col("_load").desc()]))
    if not found:
        return None
    table = found[0] if len(found) == 1 else found[0].unionByName(found[1], allowMissingColumns=True)
    return table.drop("_load").withColumn(MONTH, F.nullif(F.col(MONTH), F.lit(NO_MONTH)))


def compact(spark: SparkSession, path: str, keys: Sequence[str | Column], date: str = "date", ticker: str = "ticker") -> list[str]:
    """Write the months that several folders hold as one folder each; returns them."""
    months = live(contents(spark, path))
    due = [m for m, parts in months.items() if len(parts) > 1]
    if due:
        upto = max(p.upto for m in due for p in months[m])
        rows = read(spark, path, keys, due)
        _write(rows.withColumn(MONTH, F.coalesce(MONTH, F.lit(NO_MONTH))), path, None, upto, date, ticker)
    return due


def superseded(spark: SparkSession, path: str) -> list[str]:
    """Folders of months that no reader opens any more, for whoever cleans up."""
    parts = contents(spark, path)
    used = {(p.folder, p.month) for held in live(parts).values() for p in held}
    return sorted(f"{path}/data/{p.folder}/{MONTH}={p.month}" for p in parts if (p.folder, p.month) not in used)
