"""Panels derived from the given TPC-H-style tables (FIXTURES.md section 3).

The testdata has no OHLCV table, so daily bars are aggregated from ``lineitem``: one bar per
(ticker, ship date). All panels are plain group-bys with partial (map-side) aggregation,
so a hot ticker or date only costs one partial row per map task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _bars(spark: SparkSession, sf_dir: str, *, by: str, calm: bool) -> DataFrame:
    li = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity",
        "l_extendedprice", "l_shipdate")
    if by == "brand":
        part = table(spark, sf_dir, "part").select("p_partkey", "p_brand")
        li = li.join(part, li.l_partkey == part.p_partkey)
        ticker = F.col("p_brand")
    else:
        ticker = F.col("l_suppkey").cast("string")
    px = F.lit(100.0) + F.col("l_extendedprice") / F.lit(10000.0) if calm else F.col("l_extendedprice")
    # (l_orderkey, l_linenumber) is not unique; the four-column key is.
    seq = F.struct("l_orderkey", "l_linenumber", "l_extendedprice", "l_quantity")
    return (li.select(ticker.alias("ticker"), F.col("l_shipdate").alias("Date"),
                      px.alias("px"), seq.alias("seq"), "l_quantity")
            .groupBy("ticker", "Date")
            .agg(F.min_by("px", "seq").alias("Open"), F.max("px").alias("High"),
                 F.min("px").alias("Low"), F.max_by("px", "seq").alias("Close"),
                 F.sum("l_quantity").alias("Volume")))


def calm_bars(spark: SparkSession, sf_dir: str) -> DataFrame:
    """25 brands as tickers, prices 100 + extendedprice/10000 (no outliers)."""
    return _bars(spark, sf_dir, by="brand", calm=True)


def raw_bars(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Same bars with px = extendedprice: jumpy returns that exercise the outlier rule."""
    return _bars(spark, sf_dir, by="brand", calm=False)


def wide_bars(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Calm rule with ticker = supplier key (1,000 tickers at sf0.1): the bench panel."""
    return _bars(spark, sf_dir, by="supp", calm=True)


def corp_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(ticker, event_ts, kind): R -> split, A -> dividend, N -> earnings at 16:00."""
    li = table(spark, sf_dir, "lineitem").select("l_partkey", "l_quantity", "l_returnflag",
                                                 "l_shipdate")
    part = table(spark, sf_dir, "part").select("p_partkey", "p_brand")
    kind = (F.when(F.col("l_returnflag") == "R", F.lit("split"))
            .when(F.col("l_returnflag") == "A", F.lit("dividend"))
            .otherwise(F.lit("earnings")))
    ts = F.when(kind == "earnings", F.col("l_shipdate") + F.expr("INTERVAL 16 HOURS")).otherwise(
        F.col("l_shipdate"))
    return (li.filter(F.col("l_quantity") >= 49)
            .join(part, li.l_partkey == part.p_partkey)
            .select(F.col("p_brand").alias("ticker"), ts.alias("event_ts"), kind.alias("kind"))
            .distinct())


def dirty_bars(spark: SparkSession, sf_dir: str) -> DataFrame:
    """calm_bars with nulls and duplicates keyed by day of month, plus an ingest ordinal.

    day 13: Close null; day 17: Volume null; day 29: all prices null;
    day 7: a second copy with prices + 1 and ord = 2 (later ingest wins on dedupe).
    """
    b = calm_bars(spark, sf_dir)
    d = F.dayofmonth("Date")
    px_null = d == 29

    def price(c):
        return F.when(px_null, F.lit(None).cast("double")).otherwise(F.col(c))

    base = b.select(
        "ticker", "Date", price("Open").alias("Open"), price("High").alias("High"),
        price("Low").alias("Low"),
        F.when(px_null | (d == 13), F.lit(None).cast("double")).otherwise(F.col("Close")).alias("Close"),
        F.when(d == 17, F.lit(None).cast("double")).otherwise(F.col("Volume")).alias("Volume"),
        F.lit(1).alias("ord"))
    dup = b.filter(d == 7).select(
        "ticker", "Date", *[(F.col(c) + 1).alias(c) for c in ("Open", "High", "Low", "Close")],
        "Volume", F.lit(2).alias("ord"))
    return base.unionByName(dup)


# ---------------------------------------------------------------------------
# The same panels as DuckDB CTE text, for the oracle queries.
# ---------------------------------------------------------------------------

def _bars_sql(by: str, calm: bool) -> str:
    px = "100 + l_extendedprice / 10000.0" if calm else "l_extendedprice"
    seq = "row(l_orderkey, l_linenumber, l_extendedprice, l_quantity)"
    if by == "brand":
        tk, src = "p_brand", "lineitem JOIN part ON l_partkey = p_partkey"
    else:
        tk, src = "CAST(l_suppkey AS VARCHAR)", "lineitem"
    return (f"SELECT {tk} AS ticker, l_shipdate AS \"Date\", arg_min({px}, {seq}) AS \"Open\", "
            f"max({px}) AS \"High\", min({px}) AS \"Low\", arg_max({px}, {seq}) AS \"Close\", "
            f"sum(l_quantity) AS \"Volume\" FROM {src} GROUP BY 1, 2")


CALM_BARS_SQL = _bars_sql("brand", True)
RAW_BARS_SQL = _bars_sql("brand", False)
WIDE_BARS_SQL = _bars_sql("supp", True)

CORP_EVENTS_SQL = """
SELECT DISTINCT p_brand AS ticker,
  CASE WHEN l_returnflag NOT IN ('R', 'A') THEN l_shipdate + INTERVAL 16 HOUR ELSE l_shipdate END AS event_ts,
  CASE WHEN l_returnflag = 'R' THEN 'split' WHEN l_returnflag = 'A' THEN 'dividend' ELSE 'earnings' END AS kind
FROM lineitem JOIN part ON l_partkey = p_partkey WHERE l_quantity >= 49
"""

DIRTY_BARS_SQL = f"""
SELECT ticker, "Date",
  CASE WHEN day("Date") = 29 THEN NULL ELSE "Open" END AS "Open",
  CASE WHEN day("Date") = 29 THEN NULL ELSE "High" END AS "High",
  CASE WHEN day("Date") = 29 THEN NULL ELSE "Low" END AS "Low",
  CASE WHEN day("Date") IN (13, 29) THEN NULL ELSE "Close" END AS "Close",
  CASE WHEN day("Date") = 17 THEN NULL ELSE "Volume" END AS "Volume", 1 AS ord
FROM ({CALM_BARS_SQL}) b0
UNION ALL
SELECT ticker, "Date", "Open" + 1, "High" + 1, "Low" + 1, "Close" + 1, "Volume", 2 AS ord
FROM ({CALM_BARS_SQL}) b1 WHERE day("Date") = 7
"""
