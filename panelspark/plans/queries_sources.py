"""Registered queries: file sources and sinks (S1-S9) as round trips of derived panels.

Each query writes a panel derived from the given tables into the shared checkpoint folder
and reads it back through the operator under test; the oracle is the panel itself.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from panelspark.plans.queries_core import BARS, r
from panelspark.plans.registry import register, rounded
from panelspark.sources import files as fs
from panelspark.sources import testbeds as tb

_BARS_ORACLE = f'SELECT ticker, "Date", {r(BARS)} FROM ({tb.CALM_BARS_SQL})'


@register("csv_normalise", _BARS_ORACLE)
def q_csv_normalise(spark, sf):
    """Vendor-style CSVs (odd header case and spacing, one folder per ticker) -> bars."""
    bars = tb.calm_bars(spark, sf)
    vendor = bars.select("ticker", F.date_format("Date", "yyyy-MM-dd").alias(" date"),
                         *[F.col(c).alias(f" {c.lower()} ") for c in BARS])
    path = fs.new_scratch(spark, "raw_csv")
    vendor.write.mode("overwrite").partitionBy("ticker").option("header", True).csv(path)
    return rounded(fs.load_csv_bars(spark, path).select("ticker", "Date", *BARS))


@register("wide_to_long", _BARS_ORACLE)
def q_wide_to_long(spark, sf):
    """A TICKER_Field wide frame of all tickers back to the long panel."""
    wide = fs.long_to_wide(tb.calm_bars(spark, sf))
    return rounded(fs.wide_to_long(wide).select("ticker", "Date", *BARS))


@register("sink_roundtrip", _BARS_ORACLE)
def q_sink_roundtrip(spark, sf):
    """S6 + S2/S3: write the panel partitioned by ticker, read it back."""
    path = fs.write_panel(tb.calm_bars(spark, sf), fs.new_scratch(spark, "panel"))
    return rounded(fs.read_panel(spark, path).select("ticker", "Date", *BARS))


@register("csv_sink_roundtrip", _BARS_ORACLE)
def q_csv_sink(spark, sf):
    """S6 CSV form (dates as yyyy-MM-dd) read back with S1."""
    path = fs.write_panel(tb.calm_bars(spark, sf), fs.new_scratch(spark, "panel_csv"), fmt="csv")
    return rounded(fs.load_csv_bars(spark, path).select("ticker", "Date", *BARS))


_NUMERIC_SQL = f"""SELECT lpad(CAST(l_suppkey AS VARCHAR), 4, '0') AS ticker, l_shipdate AS "Date",
  round(sum(l_quantity) + 3.1e-10, 6) + 0.0 AS "Volume" FROM lineitem
  WHERE lpad(CAST(l_suppkey AS VARCHAR), 4, '0') <> '0001' GROUP BY 1, 2"""


@register("numeric_ticker_roundtrip", _NUMERIC_SQL)
def q_numeric_ticker(spark, sf):
    """S6 + S2/S3 with tickers that look like numbers, read back by a ticker list."""
    rows = spark.read.parquet(f"{sf}/lineitem.parquet").groupBy(
        F.lpad(F.col("l_suppkey").cast("string"), 4, "0").alias("ticker"), F.col("l_shipdate").cast("timestamp_ntz").alias("Date")
    ).agg(F.sum("l_quantity").alias("Volume"))
    path = fs.write_panel(rows, fs.new_scratch(spark, "numeric"))
    wanted = rows.select("ticker").distinct().where("ticker <> '0001'")
    return rounded(fs.read_panel(spark, path, wanted).select("ticker", "Date", "Volume"))
