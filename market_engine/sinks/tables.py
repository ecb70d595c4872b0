"""Partitioned Parquet tables for each layer.

Tables are partitioned by month, as their queries filter by date, and sorted by ticker and date inside a file
so that row group statistics prune by ticker. Partitions are overwritten dynamically: running a load
twice leaves the same table. Loads replace the months they hold; merges keep the other rows of those months.
"""

from __future__ import annotations

from collections.abc import Sequence
from contextlib import contextmanager

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import NullType, StructField, StructType

from ..operators import clean
from ..operators.incremental import MONTH
from ..session import ensure_checkpoint_dir

OVERWRITE_MODE = "spark.sql.sources.partitionOverwriteMode"


def with_month(df: DataFrame, date: str) -> DataFrame:
    return df.withColumn(MONTH, F.date_format(date, "yyyy-MM"))


def clustered(df: DataFrame, partition: str, *order: str) -> DataFrame:
    """Rows of one table partition together, sorted, in tasks of about the advisory size.

    The hint shuffles once, without the sample that a range partitioning takes by running its input twice.
    Adaptive execution then cuts a large partition into several tasks and puts small ones together.
    """
    return df.hint("rebalance", F.col(partition)).sortWithinPartitions(partition, *order)


def write_months(df: DataFrame, path: str, date: str = "date", ticker: str = "ticker") -> None:
    laid_out = clustered(with_month(df, date), MONTH, ticker, date)
    laid_out.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(MONTH).parquet(path)


def write_per_ticker(df: DataFrame, path: str, ticker: str = "ticker") -> None:
    """One folder per ticker, for small universes; the folder of each ticker present is replaced."""
    laid_out = clustered(df, ticker, "date")
    laid_out.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(ticker).parquet(path)


def write_combined(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").parquet(path)


def merged(new: DataFrame, held: DataFrame, keys: list, order: list) -> DataFrame:
    """New and held rows, one per key.

    ``order`` ranks rows of one key by its columns and ``_new``, which is 1 for new rows.
    """
    rows = new.withColumn("_new", F.lit(1)).unionByName(held.withColumn("_new", F.lit(0)), allowMissingColumns=True)
    return clean.first_per_key(rows, keys, order).drop("_new")


def _merged_months(fresh: DataFrame, held: DataFrame, keys: list, order: list) -> DataFrame:
    """``fresh``, which is stored, merged with the held rows of the months it touches.

    The result is stored too, because it is read from the folders that the write replaces.
    """
    # A calendar has a few hundred months, so this list stays small; it prunes the partitions read.
    months = [r[0] for r in fresh.select(MONTH).distinct().collect()]
    touched = F.col(MONTH).isin([m for m in months if m is not None])
    if None in months:
        touched = touched | F.col(MONTH).isNull()
    return merged(fresh, held.withColumn(MONTH, F.col(MONTH).cast("string")).where(touched), keys, order).checkpoint()


def merge_months(new: DataFrame, path: str, keys: list, order: list, date: str = "date", ticker: str = "ticker") -> None:
    """Write new rows into a month table without losing the other days of their months; see ``merged``."""
    spark = new.sparkSession
    rows = with_month(new, date)
    held = read_months(spark, path)
    if held is not None:
        ensure_checkpoint_dir(spark)
        rows = _merged_months(rows.checkpoint(), held, keys, order)
    else:
        rows = clean.first_per_key(rows.withColumn("_new", F.lit(1)), keys, order).drop("_new")
    write_months(rows.drop(MONTH), path, date, ticker)


def read_months(spark: SparkSession, path: str) -> DataFrame | None:
    """The table under the path with the columns of all its months; None if nothing was written there.

    Months written before a column was added have NULL there.
    """
    try:
        return spark.read.option("mergeSchema", True).parquet(path)
    except AnalysisException:
        return None


def prepare_news(df: DataFrame) -> DataFrame:
    """Article and query dates as timestamps, NULL where they cannot be read; see ``clean.as_timestamp``."""
    kinds = dict(df.dtypes)
    texts = [c for c in ("date", "query_date") if kinds.get(c) == "string"]
    return df.withColumns({c: clean.as_timestamp(df, c) for c in texts}) if texts else df


def create_table(spark: SparkSession, name: str, schema: StructType, path: str | None = None) -> None:
    """Create the table if it is absent: Parquet, partitioned by month, required columns NOT NULL."""
    columns = ", ".join(
        f"{f.name} {f.dataType.simpleString()}{'' if f.nullable else ' NOT NULL'}" for f in schema.fields
    )
    location = f" LOCATION '{path}'" if path else ""
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {name} ({columns}, {MONTH} string) USING parquet PARTITIONED BY ({MONTH}){location}"
    )


def load_table(df: DataFrame, name: str, schema: StructType, date: str = "date_key", strict: bool = False) -> None:
    """Replace the months of ``df`` in an existing table, after conforming to its schema.

    Columns that the table lacks are added to it and are NULL in the rows it holds; with ``strict`` any column
    that ``schema`` does not declare stops the load. Columns that ``df`` lacks are NULL in the new rows.
    """
    _insert(_conformed(df, name, schema, date, strict), name, date)


def merge_table(
    new: DataFrame, name: str, schema: StructType, keys: list, order: list, date: str = "date_key", strict: bool = False
) -> None:
    """Like ``load_table``, but the other rows of the touched months stay; see ``merged``."""
    spark = new.sparkSession
    fresh = _conformed(new, name, schema, date, strict)
    ensure_checkpoint_dir(spark)
    _insert(_merged_months(fresh.checkpoint(), spark.table(name), keys, order), name, date)


def new_fields(df: DataFrame, name: str) -> list[StructField]:
    """The columns of ``df`` that the table lacks, whatever the case of their names.

    A column without a type, which is NULL everywhere, is none: it gets its type with its first value.
    """
    unknown = clean.unknown_columns(df, df.sparkSession.table(name).schema)
    return [f for f in df.schema.fields if f.name in unknown and not isinstance(f.dataType, NullType)]


def add_fields(spark: SparkSession, name: str, fields: Sequence[StructField]) -> None:
    """Add columns to a table; the files written so far are not touched and read as NULL there."""
    if fields:
        listed = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in fields)
        spark.sql(f"ALTER TABLE {name} ADD COLUMNS ({listed})")


def _conformed(df: DataFrame, name: str, schema: StructType, date: str, strict: bool) -> DataFrame:
    spark = df.sparkSession
    if not spark.catalog.tableExists(name):
        raise ValueError(f"table {name} does not exist")
    if strict:
        undeclared = clean.unknown_columns(df, schema)
        if undeclared:
            raise ValueError(f"unknown columns: {undeclared}")
    add_fields(spark, name, new_fields(df, name))
    rows = clean.conform(df, StructType([f for f in spark.table(name).schema.fields if f.name != MONTH]))
    for column in (f.name for f in schema.fields if not f.nullable):
        # A missing required value stops the load as a warehouse would.
        message = F.lit(f"NULL in required column {column}")
        rows = rows.withColumn(
            column, F.when(F.col(column).isNull(), F.raise_error(message)).otherwise(F.col(column))
        )
    return with_month(rows, date)


def _insert(rows: DataFrame, name: str, date: str) -> None:
    spark = rows.sparkSession
    laid_out = clustered(rows.select(spark.table(name).columns), MONTH, "ticker", date)
    with _dynamic_overwrite(spark):
        laid_out.write.mode("overwrite").insertInto(name)


@contextmanager
def _dynamic_overwrite(spark: SparkSession):
    """Inserts into tables follow the session only: under the static mode they would empty the other months."""
    before = spark.conf.get(OVERWRITE_MODE)
    spark.conf.set(OVERWRITE_MODE, "dynamic")
    try:
        yield
    finally:
        spark.conf.set(OVERWRITE_MODE, before)


def write_report(report: DataFrame, root: str, day: str, source: str) -> str:
    """The check table as JSON under ``{yyyymmdd}_{source}.json``."""
    path = f"{root}/{day.replace('-', '')}_{source}.json"
    # A report has one row per check, so one file is enough.
    report.coalesce(1).write.mode("overwrite").json(path)
    return path
