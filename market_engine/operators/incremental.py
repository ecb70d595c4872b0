"""Which days are still to be loaded."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .clean import as_date

LOOKBACK_DAYS = 365
#: The partition column of the stored tables.
MONTH = "month"


def last_date(spark: SparkSession, table: str, column: str = "date"):
    """Latest date of a catalog table; None if it is missing or empty.

    If the table is partitioned by month, ``column`` must be what its months were made from, or a date of the same
    month. The names of its partitions then tell which month to read; rows without a date are in none of them.
    """
    if not spark.catalog.tableExists(table):
        return None
    rows = spark.table(table)
    if any(c.name == MONTH and c.isPartition for c in spark.catalog.listColumns(table)):
        names = spark.sql(f"SHOW PARTITIONS {table}")
        month = F.regexp_extract("partition", rf"{MONTH}=(\d{{4}}-\d{{2}})$", 1)
        # An empty name stands for the rows without a date.
        last = names.agg(F.max(month)).first()[0]
        found = rows.where(F.col(MONTH) == last).agg(F.max(column)).first()[0] if last else None
        if found is not None:
            return found
    return rows.agg(F.max(column)).first()[0]


def newest_month(loaded: DataFrame) -> DataFrame:
    """The rows of the last month of a month table that hold a date; other tables as they are.

    The month is found from the folder names, which Spark has listed already; it prunes the folders read.
    """
    if MONTH not in loaded.columns:
        return loaded
    months = {m.group(1) for f in loaded.inputFiles() if (m := re.search(rf"/{MONTH}=(\d{{4}}-\d{{2}})/", f))}
    return loaded.where(F.col(MONTH).cast("string") == max(months)) if months else loaded


def pending_range(loaded: DataFrame, today, column: str = "date", lookback: int = LOOKBACK_DAYS) -> DataFrame:
    """One row with the first and last day to load; no row if nothing is due.

    For a stored month table pass its ``newest_month``, which has the latest date.
    """
    end = F.lit(today).cast("date")
    start = F.coalesce(F.date_add(F.max(column), 1), F.date_sub(end, lookback))
    return loaded.agg(start.alias("start_date"), end.alias("end_date")).where("start_date <= end_date")


def pending_ranges_by_ticker(
    tickers: DataFrame, loaded: DataFrame, today, column: str = "date", lookback: int = LOOKBACK_DAYS
) -> DataFrame:
    """Range per ticker: after its own last date, else after the last date of all, else the lookback."""
    end = F.lit(today).cast("date")
    own = loaded.groupBy("ticker").agg(F.max(column).alias("_own"))
    overall = loaded.agg(F.max(column).alias("m")).scalar()
    start = F.coalesce(F.date_add("_own", 1), F.date_add(overall, 1), F.date_sub(end, lookback))
    return (
        tickers.select("ticker")
        .distinct()
        .join(own, "ticker", "left")
        .select("ticker", start.alias("start_date"), end.alias("end_date"))
        .where("start_date <= end_date")
    )


def day_spine(ranges: DataFrame) -> DataFrame:
    """One row per day of each range, both ends included."""
    keep = [c for c in ranges.columns if c not in ("start_date", "end_date")]
    return ranges.select(*keep, F.explode(F.sequence("start_date", "end_date")).alias("date"))


def missing_days(spine: DataFrame, loaded: DataFrame) -> DataFrame:
    """Days of the spine with no loaded (ticker, date).

    ``loaded`` may be rows of a table or a list of processed days; a processed day without articles is then
    not asked for again.
    """
    done = loaded.select("ticker", as_date(loaded, "date").alias("date")).distinct()
    return spine.join(done, ["ticker", "date"], "left_anti")


def nothing_pending(*ranges: DataFrame) -> bool:
    return all(r.isEmpty() for r in ranges)
