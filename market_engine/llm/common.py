"""What the operators share: whole-table reads, stored intermediate tables, running totals over hot keys."""

from __future__ import annotations

import uuid
from collections.abc import Iterator, Sequence
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir

WORD = r"[^\x20\x09-\x0D]+"
SPACE = r"[\x20\x09-\x0D]+"
#: Rows that share a window partition of `running_total`, about.
CHUNK_ROWS = 4096
#: Rows that a Python worker of the pipeline takes at once.
BATCH_ROWS = 1000


def read(spark: SparkSession, folder: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{table}.parquet")


def text_of(column: str = "text") -> Column:
    """The text, empty where it is NULL."""
    return F.coalesce(F.col(column).cast("string"), F.lit(""))


def store(df: DataFrame, name: str) -> DataFrame:
    """The same rows, written once as Parquet to the folder all executors share.

    What follows reads the files, so a lost executor costs no more than its own tasks, and a table used
    several times is computed once.
    """
    spark = df.sparkSession
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if spark.sparkContext.getCheckpointDir() is None:
            ensure_checkpoint_dir(spark)
        base = spark.sparkContext.getCheckpointDir()
    path = f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


@contextmanager
def small_batches(spark: SparkSession, rows: int = BATCH_ROWS) -> Iterator[None]:
    """Jobs planned inside hand Python fewer rows at a time, so that its workers hold few whole texts."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)
    spark.conf.set(name, str(min(rows, int(before)) if int(before) > 0 else rows))
    try:
        yield
    finally:
        spark.conf.set(name, before)


def hash31(*columns: Column | str) -> Column:
    """A whole number from 0 to 2^31 - 1, spread evenly."""
    return F.shiftrightunsigned(F.xxhash64(*columns), 33)


def chunk_count(rows: int, chunk_rows: int = CHUNK_ROWS) -> int:
    return max(1, -(-rows // chunk_rows))


def chunk_of(hashed: Column, chunks: int, bits: int) -> Column:
    """The chunk a hash of so many bits falls into; chunks follow the order of the hashes."""
    return F.shiftright(hashed * F.lit(chunks).cast("long"), bits)


def running_total(
    df: DataFrame, keys: Sequence[str], chunk: str, order: Sequence[str], value: Column, name: str
) -> DataFrame:
    """Add the sum of `value` over the earlier rows of the same keys, in the order (chunk, order).

    A key may hold most of the rows: sums of chunks are added up per key, rows only within a chunk. The
    keys must not be NULL. `df` is read twice.
    """
    by_chunk = df.groupBy(*keys, chunk).agg(F.sum(value).alias("_sum"))
    earlier = Window.partitionBy(*keys).orderBy(chunk).rowsBetween(Window.unboundedPreceding, -1)
    starts = by_chunk.select(*keys, chunk, F.coalesce(F.sum("_sum").over(earlier), F.lit(0)).alias("_start"))
    inside = Window.partitionBy(*keys, chunk).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    within = df.withColumn(name, F.coalesce(F.sum(value).over(inside), F.lit(0)))
    joined = within.join(starts, [*keys, chunk])
    return joined.withColumn(name, (F.col(name) + F.col("_start")).cast("long")).drop("_start")
