"""Cleaning (C1-C5h): dedupe, null pruning, QC, event-aware outlier removal.

Dedupe is a hash aggregate (``max_by`` on the ingest ordinal) instead of a window, so a
(ticker, Date) key repeated many times is combined map-side before the shuffle. The outlier
rule is one window pass on the ticker partitioning plus one lookup of expanded event
timestamps; the lookup joins on (ticker, Date) and reuses the ticker partitioning of the
bars, so only the event table moves.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelspark.functions.windows import (
    KEY, ORDER, by_key, flag, padded, ratio_change, roll_median, roll_std)

PRICE_COLS = ["Open", "High", "Low", "Close"]
EVENT_KINDS = ("split", "dividend", "earnings")


def dedupe(df: DataFrame, key: str = KEY, order: str = ORDER, ord_col: str = "ord") -> DataFrame:
    """Keep the last ingested row per (ticker, Date). ``ord_col`` is the ingest ordinal."""
    value_cols = [c for c in df.columns if c not in (key, order)]
    packed = F.struct(*[F.col(c) for c in value_cols])
    out = (df.groupBy(key, order)
           .agg(F.max_by(packed, F.col(ord_col)).alias("_row")))
    return out.select(key, order, *[F.col(f"_row.{c}").alias(c) for c in value_cols])


def prune_nulls(df: DataFrame) -> DataFrame:
    """Drop rows without Adj Close (if present) or with all four prices null; Volume null -> 0."""
    out = df
    if "Adj Close" in out.columns:
        out = out.filter(F.col("`Adj Close`").isNotNull())
    prices = [c for c in PRICE_COLS if c in out.columns]
    if prices:
        out = out.filter(F.coalesce(*[F.col(c) for c in prices]).isNotNull())
    if "Volume" in out.columns:
        out = out.withColumn("Volume", F.coalesce(F.col("Volume"), F.lit(0.0)))
    return out


def qc_report(df: DataFrame, key: str = KEY, order: str = ORDER) -> DataFrame:
    """C4: per ticker rows, duplicate dates, null Adj Close and date range."""
    na_adj = (F.count_if(F.col("`Adj Close`").isNull()) if "Adj Close" in df.columns
              else F.lit(None).cast("bigint"))
    return (df.groupBy(key)
            .agg(F.count(F.lit(1)).alias("rows"),
                 (F.count(F.lit(1)) - F.count_distinct(order)).alias("dupe_dates"),
                 na_adj.alias("n_na_adjclose"),
                 F.min(order).alias("date_min"), F.max(order).alias("date_max")))


def expand_events(events: DataFrame, buffer_days: int = 1, match: str = "exact",
                  key: str = KEY) -> DataFrame:
    """C5d: every event timestamp shifted by -k..k days, distinct per ticker.

    ``match="exact"`` keeps time of day (an earnings stamp at 16:00 never equals a midnight
    bar, as in the reference); ``match="date"`` truncates to the day first.
    """
    ts = F.col("event_ts")
    if match == "date":
        ts = F.date_trunc("day", ts)
    offs = F.explode(F.sequence(F.lit(-buffer_days), F.lit(buffer_days))).alias("_off")
    return (events.select(key, ts.alias("event_ts"), offs)
            .select(key, (F.col("event_ts") + F.make_dt_interval(F.col("_off"))).alias("keep_ts"))
            .distinct())


def outlier_flags(df: DataFrame, events: DataFrame | None, abs_threshold=0.50, sigma_threshold=5.0,
                  sigma_window=20, keep_event_buffer_days=1, vol_spike_mult=3.0, vol_window=20,
                  match: str = "exact", key: str = KEY, order: str = ORDER) -> DataFrame:
    """C5a-C5f: bars plus Return, candidate, NearEvent, VolSpike and drop columns."""
    w = by_key(key, order)
    out = df.withColumn("_cp", padded("Close", w))
    out = out.withColumn("Return", ratio_change("_cp", w)).drop("_cp")
    sig = roll_std("Return", w, sigma_window, max(5, sigma_window // 2))
    if "Volume" in df.columns:
        med = roll_median("Volume", w, vol_window, max(5, vol_window // 2))
        spike = flag(F.col("Volume") > med * F.lit(vol_spike_mult))
    else:
        spike = F.lit(False)
    out = out.withColumns({"_sigma": sig, "VolSpike": spike})
    abs_mask = flag(F.abs("Return") > F.lit(abs_threshold))
    sigma_mask = flag((F.col("_sigma") > 0) & (F.abs("Return") > F.lit(sigma_threshold) * F.col("_sigma")))
    out = out.withColumn("candidate", abs_mask | sigma_mask).drop("_sigma")
    if events is not None:
        keep = expand_events(events, keep_event_buffer_days, match, key).withColumn("_near", F.lit(True))
        out = (out.join(keep, (out[key] == keep[key]) & (out[order] == keep["keep_ts"]), "left")
               .drop(keep[key]).drop("keep_ts")
               .withColumn("NearEvent", F.coalesce(F.col("_near"), F.lit(False))).drop("_near"))
    else:
        out = out.withColumn("NearEvent", F.lit(False))
    return out.withColumn("drop", F.col("candidate") & ~F.col("NearEvent") & ~F.col("VolSpike"))


def clean_outliers(df: DataFrame, events: DataFrame | None = None, **params) -> DataFrame:
    """C5f: the kept bars, with the input's columns."""
    flagged = outlier_flags(df, events, **params)
    return flagged.filter(~F.col("drop")).select(*df.columns)


def outlier_log(df: DataFrame, events: DataFrame | None = None, abs_threshold=0.50,
                sigma_threshold=5.0, sigma_window=20, key: str = KEY, order: str = ORDER,
                **params) -> DataFrame:
    """C5g: one row per dropped bar with its return and the rule parameters."""
    flagged = outlier_flags(df, events, abs_threshold=abs_threshold, sigma_threshold=sigma_threshold,
                            sigma_window=sigma_window, key=key, order=order, **params)
    return (flagged.filter(F.col("drop"))
            .select(key, order, "Return", F.lit(float(abs_threshold)).alias("AbsThreshold"),
                    F.lit(float(sigma_threshold)).alias("SigmaThreshold"),
                    F.lit(int(sigma_window)).alias("SigmaWindow"), "NearEvent", "VolSpike"))


def outlier_qc(df: DataFrame, events: DataFrame | None = None, abs_threshold=0.50, sigma_threshold=5.0,
               sigma_window=20, keep_event_buffer_days=1, vol_spike_mult=3.0, vol_window=20,
               key: str = KEY, order: str = ORDER, **params) -> DataFrame:
    """C5h: per ticker counts of the rule, event counts per kind and the parameters."""
    flagged = outlier_flags(df, events, abs_threshold, sigma_threshold, sigma_window,
                            keep_event_buffer_days, vol_spike_mult, vol_window, key=key, order=order, **params)
    c, ne, vs = F.col("candidate"), F.col("NearEvent"), F.col("VolSpike")
    qc = (flagged.groupBy(key)
          .agg(F.count(F.lit(1)).alias("rows_before"),
               F.count_if(~F.col("drop")).alias("rows_after"),
               F.count_if(c).alias("n_flagged"),
               F.count_if(F.col("drop")).alias("n_dropped"),
               F.count_if(c & ne).alias("n_kept_due_to_events"),
               F.count_if(c & ~ne & vs).alias("n_kept_due_to_vol_spike")))
    if events is not None:
        names = {"split": "n_splits", "dividend": "n_dividends", "earnings": "n_earnings"}
        counts = (events.groupBy(key)
                  .agg(*[F.count_if(F.col("kind") == k).alias(names[k]) for k in EVENT_KINDS]))
        qc = qc.join(counts, key, "left")
        qc = qc.fillna(0, subset=["n_splits", "n_dividends", "n_earnings"])
    else:
        qc = qc.withColumns({n: F.lit(0).cast("bigint") for n in ("n_splits", "n_dividends", "n_earnings")})
    return qc.withColumns({
        "event_buffer_days": F.lit(int(keep_event_buffer_days)),
        "abs_threshold": F.lit(float(abs_threshold)),
        "sigma_threshold": F.lit(float(sigma_threshold)),
        "sigma_window": F.lit(int(sigma_window)),
        "vol_spike_mult": F.lit(float(vol_spike_mult)),
        "vol_window": F.lit(int(vol_window)),
    })


def cleaning_pipeline(raw: DataFrame, events: DataFrame | None = None, ord_col: str | None = "ord",
                      **params) -> DataFrame:
    """Dedupe -> prune -> outliers. Without an ingest ordinal the largest of a day's rows stays."""
    if not (ord_col and ord_col in raw.columns):
        ord_col = "_largest"
        raw = raw.withColumn(ord_col, F.struct(*[c for c in raw.columns if c not in (KEY, ORDER)]))
    df = dedupe(raw, ord_col=ord_col).drop(ord_col)
    return clean_outliers(prune_nulls(df), events, **params)
