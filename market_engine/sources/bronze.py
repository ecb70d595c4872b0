"""Bronze readers."""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import pyarrow as pa
import pyarrow.parquet as pq
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..schemas import TICKERS

# Headings of the ticker list and the file name pattern of per-ticker prices. The pattern
# leaves out files that hold all tickers at once.
TICKER_HEADINGS = {
    "Symbol": "ticker",
    "CompanyName": "company_name",
    "Abbreviated Company Name": "abbrev1",
    "Abbreviated Secondary Company Name": "abbrev2",
}
PRICE_FILES = "prices_*.parquet"
#: The longest file that a probe opens.
PROBED_BYTES = 256 << 20
NANOS_AS_LONG = "spark.sql.legacy.parquet.nanosAsLong"


def _readable(df: DataFrame, path: str) -> DataFrame:
    if df.isEmpty():
        raise ValueError(f"no readable rows under {path}")
    return df


def _reader(spark: SparkSession, skip_unreadable: bool):
    reader = spark.read.option("ignoreCorruptFiles", skip_unreadable)
    return reader.option("ignoreMissingFiles", skip_unreadable)


def read_price_files(spark: SparkSession, root: str, schema=None, skip_unreadable: bool = False) -> DataFrame:
    """Per-ticker price files anywhere below ``root``.

    An unreadable file stops the readers of this module unless it is to be skipped; ``files_without_rows`` then
    tells which ones were.
    """
    reader = _reader(spark, skip_unreadable).option("recursiveFileLookup", True).option("pathGlobFilter", PRICE_FILES)
    if schema is not None:
        reader = reader.schema(schema)
    return _readable(reader.parquet(root), root)


def read_prices(spark: SparkSession, root: str, skip_unreadable: bool = False) -> DataFrame:
    """The partitioned price table that ``jobs.store_bars`` or ``tables.write_per_ticker`` writes."""
    return _readable(_reader(spark, skip_unreadable).parquet(root), root)


def read_news(
    spark: SparkSession,
    root: str,
    date_columns: tuple[str, ...] = ("date", "query_date"),
    skip_unreadable: bool = False,
) -> DataFrame:
    """Article files with the union of their columns.

    Where the files hold nanosecond time stamps, these are brought to microseconds, rounding down. Spark reads
    them under a session option only, and when the rows are used; so the option stays set in that case.
    Whole numbers in files without such time stamps are left as they are.
    """
    reader = _reader(spark, skip_unreadable).option("mergeSchema", True)
    before = spark.conf.get(NANOS_AS_LONG)
    spark.conf.set(NANOS_AS_LONG, "false")
    try:
        df = reader.parquet(root)
    except AnalysisException as error:
        if error.getCondition() != "PARQUET_TYPE_ILLEGAL":
            raise
        df = None
    finally:
        spark.conf.set(NANOS_AS_LONG, before)
    if df is None:
        spark.conf.set(NANOS_AS_LONG, "true")
        df = reader.parquet(root)
        kinds = dict(df.dtypes)
        nanos = [c for c in date_columns if kinds.get(c) == "bigint"]
        df = df.withColumns({c: F.timestamp_micros(F.floor(F.col(c) / 1000).cast("bigint")) for c in nanos})
    return _readable(df, root)


def files_without_rows(rows: DataFrame, root: str, pattern: str = "*.parquet") -> DataFrame:
    """path and length of the files below ``root`` that gave no row to ``rows``, a frame of these readers.

    With skipping on these are the skipped files and empty ones. Only the files' footers are read, so damage
    further inside a file is not seen here.
    """
    listing = rows.sparkSession.read.format("binaryFile").option("recursiveFileLookup", True)
    files = listing.option("pathGlobFilter", pattern).load(root)
    used = rows.select(F.col("_metadata.file_path").alias("path")).distinct()
    return files.select(F.col("_metadata.file_path").alias("path"), "length").join(used, "path", "left_anti")


def probe_files(spark: SparkSession, root: str, pattern: str = "*.parquet", max_bytes: int = PROBED_BYTES) -> DataFrame:
    """path, length, rows, lost_rows and error of each file below ``root``; whole files have no error.

    Every file is opened in a task and its row groups are read one by one, so damage inside a file is found too. Of a
    file whose footer cannot be read the rows are unknown (NULL). Files beyond ``max_bytes``, which would fill a
    task's memory, are not opened; they are listed with that as their error.
    """
    listing = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", pattern).load(root)
    files = listing.select(F.col("_metadata.file_path").alias("path"), "length", "content")

    # Functions made here travel to the tasks whole, which then need not have this package.
    def said(error: Exception) -> str:
        return f"{type(error).__name__}: {error}"[:300]

    def probe(content: pa.Scalar) -> tuple[int | None, int | None, str | None]:
        try:
            file = pq.ParquetFile(pa.BufferReader(content.as_buffer()))
        except Exception as error:  # whatever the reader cannot take is what is asked for
            return None, None, said(error)
        lost, first = 0, None
        for group in range(file.num_row_groups):
            try:
                file.read_row_group(group)
            except Exception as error:
                lost += file.metadata.row_group(group).num_rows
                first = first or said(error)
        return file.metadata.num_rows, lost, first

    def probed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [probe(content) for content in batch.column("content")]
            columns = [pa.array([f[i] for f in found], t) for i, t in enumerate((pa.int64(), pa.int64(), pa.string()))]
            yield pa.RecordBatch.from_arrays(
                [batch.column("path"), batch.column("length"), *columns], names=["path", "length", "rows", "lost_rows", "error"]
            )

    opened = files.where(F.col("length") <= max_bytes).mapInArrow(
        probed, "path string, length long, rows long, lost_rows long, error string"
    )
    unknown = F.lit(None).cast("long")
    left = files.where(F.col("length") > max_bytes).select(
        "path", "length", unknown.alias("rows"), unknown.alias("lost_rows"), F.lit(f"longer than {max_bytes} bytes").alias("error")
    )
    return opened.unionByName(left)


def read_tickers(spark: SparkSession, path: str) -> DataFrame:
    """The ticker list; blank abbreviations are NULL."""
    raw = spark.read.option("header", True).csv(path)
    present = [F.col(f"`{heading}`").alias(name) for heading, name in TICKER_HEADINGS.items() if heading in raw.columns]
    missing = [F.lit(None).cast("string").alias(name) for heading, name in TICKER_HEADINGS.items() if heading not in raw.columns]
    return raw.select(*present, *missing).select(*TICKERS.fieldNames())


def union_all(*frames: DataFrame) -> DataFrame:
    """Rows of all frames; columns that one lacks are NULL."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)
