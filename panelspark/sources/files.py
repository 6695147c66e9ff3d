"""File scans and sinks (S1-S8): CSV ingest with normalisation, wide-to-long, writers.

Everything is a plain Spark reader or writer. Processed panels are stored as Parquet
partitioned by ticker, so loading a ticker list is partition pruning (S2, S3).
"""

from __future__ import annotations

import csv
import uuid
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from panelspark.session import scratch_path

RELEVANT = ["Open", "High", "Low", "Close", "Adj Close", "Volume"]
FIELDS = ["Open", "High", "Low", "Close", "Volume"]


def title_case(name: str) -> str:
    """Header normalisation of the reference: strip, then Python ``str.title``."""
    return name.strip().title()


def _number(c):
    """Null for NaN, which would pass null checks and poison windows."""
    return F.nullif(c, F.lit(float("nan")))


def _text_key(schema: StructType, key: str) -> StructType:
    return StructType([StructField(f.name, StringType() if f.name == key else f.dataType, f.nullable) for f in schema])


def header_groups(spark: SparkSession, path: str) -> tuple[dict[str, list[str]], bool]:
    """Header lines and the files that begin with each (one row a file reaches the driver, as does the
    file listing itself), and whether files lie in ``ticker=`` folders."""
    lines = spark.read.text(path)
    first = (lines.select("value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"),
                          F.monotonically_increasing_id().alias("row"))
             .where("block = 0").groupBy("file").agg(F.min_by("value", "row").alias("header")))
    groups: dict[str, list[str]] = {}
    for r in first.collect():
        groups.setdefault(r["header"], []).append(unquote(r["file"]))  # a path, not a URL
    return groups, "ticker" in lines.columns


def load_csv_bars(spark: SparkSession, path: str, ticker: str | None = None, with_ord: bool = False) -> DataFrame:
    """Raw OHLCV CSV -> (ticker, Date, Open.., Volume).

    Files are grouped by their header line, each group is read with its own columns, all as strings;
    headers are stripped and title-cased, columns a group lacks are null. The ticker comes from the
    argument, a ``ticker=`` partition folder, or the file name (``TICKER.csv``). Bad dates drop the row,
    bad numbers and NaN become null. ``with_ord`` adds the ingest ordinal ``ord``: file, block start and
    place in the block, so "the last row" means the last of the file."""
    groups, in_folders = header_groups(spark, path)
    out = None
    for header, files in sorted(groups.items()):
        names = [title_case(c) for c in next(csv.reader([header]))]
        kinds = [StructField(n if n not in names[:i] else f"{n}_{i}", StringType()) for i, n in enumerate(names)]
        schema = StructType(kinds + ([StructField("ticker", StringType())] if in_folders else []))
        raw = spark.read.schema(schema).option("header", True).option("basePath", path).csv(path if len(groups) == 1 else files)
        if ticker is not None:
            tk = F.lit(ticker)
        else:
            tk = F.col("ticker") if in_folders else F.regexp_extract(F.col("_metadata.file_name"), r"^(.*?)(\.csv)?$", 1)
        date = F.to_timestamp(F.try_to_timestamp(F.trim(F.col("Date")))).cast("timestamp_ntz")
        place = F.struct(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"),
                         F.monotonically_increasing_id().alias("row"))
        part = raw.select(tk.cast("string").alias("ticker"), date.alias("Date"),
                          *[_number(F.expr(f"try_cast(`{c}` AS DOUBLE)")).alias(c) for c in RELEVANT if c in names],
                          *([place.alias("ord")] if with_ord else []))
        out = part if out is None else out.unionByName(part, allowMissingColumns=True)
    if out is None:
        return spark.createDataFrame([], "ticker string, Date timestamp_ntz")
    return out.filter(F.col("Date").isNotNull())


def wide_to_long(df: DataFrame, date_col: str = "Date", ticker: str | None = None) -> DataFrame:
    """Vendor frames with ``TICKER_Field`` columns (several tickers) or plain fields (one
    ticker) -> canonical long panel, one row per (ticker, Date) with at least one value."""
    value_cols = [c for c in df.columns if c != date_col]
    if all(c in FIELDS for c in value_cols):
        return df.select(F.lit(ticker).alias("ticker"), F.col(date_col).alias("Date"),
                         *[_number(F.col(c).cast("double")).alias(c) for c in FIELDS if c in value_cols])
    stacked = df.unpivot([date_col], value_cols, "col", "value")
    parts = stacked.select(
        F.col(date_col).alias("Date"),
        F.regexp_extract("col", r"^(.*)_([^_]+)$", 1).alias("ticker"),
        F.regexp_extract("col", r"^(.*)_([^_]+)$", 2).alias("field"),
        _number(F.col("value").cast("double")).alias("value"))
    parts = parts.filter(F.col("field").isin(FIELDS) & F.col("value").isNotNull())
    return parts.groupBy("ticker", "Date").pivot("field", FIELDS).agg(F.first("value"))


def long_to_wide(df: DataFrame, key: str = "ticker", date_col: str = "Date") -> DataFrame:
    """Inverse of S4 (``TICKER_Field`` columns); used to build vendor-shaped test input."""
    st = df.unpivot([key, date_col], FIELDS, "field", "value")
    st = st.select(date_col, F.concat_ws("_", key, "field").alias("col"), "value")
    return st.groupBy(date_col).pivot("col").agg(F.first("value"))


def write_panel(df: DataFrame, path: str, fmt: str = "parquet", key: str = "ticker",
                mode: str = "overwrite") -> str:
    """One folder and one file per ticker (Parquet by default; CSV with ``yyyy-MM-dd`` dates).
    Rows of a ticker, which the calendar bounds, are brought together first."""
    w = df.repartition(key).write.mode(mode).partitionBy(key)
    if fmt == "csv":
        w.option("header", True).option("dateFormat", "yyyy-MM-dd") \
         .option("timestampNTZFormat", "yyyy-MM-dd").csv(path)
    else:
        w.parquet(path)
    return path


def read_panel(spark: SparkSession, path: str, tickers=None, key: str = "ticker") -> DataFrame:
    """Read a processed panel; a ticker list becomes a partition filter, a table of tickers a semi
    join, which prunes partitions as it runs. Tickers are text, so that "0700" doesn't come back as a
    number."""
    df = spark.read.schema(_text_key(spark.read.parquet(path).schema, key)).parquet(path)
    if isinstance(tickers, DataFrame):
        return df.join(tickers.select(key), key, "left_semi")
    return df.filter(F.col(key).isin(list(tickers))) if tickers is not None else df


def write_table_csv(df: DataFrame, path: str, mode: str = "overwrite") -> str:
    """Metrics tables and prediction frames as CSV with a header, no index."""
    df.write.mode(mode).option("header", True).option("timestampNTZFormat", "yyyy-MM-dd HH:mm:ss").csv(path)
    return path


def read_table_csv(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """A table of ``write_table_csv`` with its types."""
    return spark.read.schema(schema).option("header", True).option("timestampNTZFormat", "yyyy-MM-dd HH:mm:ss").csv(path)


def new_scratch(spark: SparkSession, name: str) -> str:
    """A fresh folder under the shared checkpoint folder."""
    return scratch_path(spark, f"{name}-{uuid.uuid4().hex[:12]}")
