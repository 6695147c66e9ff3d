"""Registered queries: cleaning (C1-C5h) on dirty_bars / raw_bars + corp_events."""

from __future__ import annotations

from panelspark.operators import cleaning as cl
from panelspark.plans.oracle_sql import RUN, W, rmedian, rstd
from panelspark.plans.queries_core import BARS, r
from panelspark.plans.registry import register, rounded
from panelspark.sources import testbeds as tb

DEDUPED_CTE = f"""d0 AS ({tb.DIRTY_BARS_SQL}),
dd AS (SELECT ticker, "Date", "Open", "High", "Low", "Close", "Volume", ord FROM d0
       QUALIFY row_number() OVER (PARTITION BY ticker, "Date" ORDER BY ord DESC) = 1),
pr AS (SELECT ticker, "Date", "Open", "High", "Low", "Close", coalesce("Volume", 0.0) AS "Volume" FROM dd
       WHERE coalesce("Open", "High", "Low", "Close") IS NOT NULL)"""


def outlier_ctes(src_sql: str) -> str:
    """CTEs ``ob`` (bars) .. ``fl`` (flags) for the outlier rule with corp events, k = 1."""
    return f"""ob AS ({src_sql}),
ev AS ({tb.CORP_EVENTS_SQL}),
keep AS (SELECT DISTINCT ticker, event_ts + to_days(CAST(o AS INTEGER)) AS keep_ts FROM ev, range(-1, 2) t(o)),
o1 AS (SELECT *, last_value("Close" IGNORE NULLS) OVER {RUN} AS cp FROM ob),
o2 AS (SELECT *, cp / NULLIF(lag(cp) OVER ({W}), 0) - 1 AS "Return" FROM o1),
o3 AS (SELECT *, {rstd('"Return"', 20, 10)} AS sigma, {rmedian('"Volume"', 20, 10)} AS vmed FROM o2),
fl AS (
  SELECT o3.*,
    coalesce(abs("Return") > 0.5, false) OR coalesce(sigma > 0 AND abs("Return") > 5.0 * sigma, false) AS candidate,
    k.keep_ts IS NOT NULL AS "NearEvent",
    coalesce("Volume" > vmed * 3.0, false) AS "VolSpike"
  FROM o3 LEFT JOIN keep k ON k.ticker = o3.ticker AND k.keep_ts = o3."Date"),
fl2 AS (SELECT *, candidate AND NOT "NearEvent" AND NOT "VolSpike" AS drop_ FROM fl)"""


@register("dedupe", f'WITH {DEDUPED_CTE}\nSELECT ticker, "Date", {r(BARS)} FROM dd')
def q_dedupe(spark, sf):
    return rounded(cl.dedupe(tb.dirty_bars(spark, sf)).drop("ord"))


@register("prune_nulls", f'WITH {DEDUPED_CTE}\nSELECT ticker, "Date", {r(BARS)} FROM pr')
def q_prune(spark, sf):
    return rounded(cl.prune_nulls(cl.dedupe(tb.dirty_bars(spark, sf)).drop("ord")))


@register("qc_report", f"""WITH d0 AS ({tb.DIRTY_BARS_SQL})
SELECT ticker, count(*) AS "rows", count(*) - count(DISTINCT "Date") AS dupe_dates,
  CAST(NULL AS BIGINT) AS n_na_adjclose, min("Date") AS date_min, max("Date") AS date_max
FROM d0 GROUP BY ticker""")
def q_qc(spark, sf):
    return cl.qc_report(tb.dirty_bars(spark, sf).drop("ord"))


@register("event_window", f"""WITH ev AS ({tb.CORP_EVENTS_SQL})
SELECT DISTINCT ticker, event_ts + to_days(CAST(o AS INTEGER)) AS keep_ts FROM ev, range(-1, 2) t(o)""")
def q_event_window(spark, sf):
    return cl.expand_events(tb.corp_events(spark, sf), 1)


@register("outlier_clean", f"""WITH {outlier_ctes(tb.RAW_BARS_SQL)}
SELECT ticker, "Date", {r(BARS)} FROM fl2 WHERE NOT drop_""")
def q_outlier_clean(spark, sf):
    return rounded(cl.clean_outliers(tb.raw_bars(spark, sf), tb.corp_events(spark, sf)))


@register("outlier_log", f"""WITH {outlier_ctes(tb.RAW_BARS_SQL)}
SELECT ticker, "Date", {r(['Return'])}, 0.5 AS "AbsThreshold", 5.0 AS "SigmaThreshold", 20 AS "SigmaWindow",
  "NearEvent", "VolSpike" FROM fl2 WHERE drop_""")
def q_outlier_log(spark, sf):
    return rounded(cl.outlier_log(tb.raw_bars(spark, sf), tb.corp_events(spark, sf)))


@register("outlier_qc", f"""WITH {outlier_ctes(tb.RAW_BARS_SQL)},
agg AS (
  SELECT ticker, count(*) AS rows_before, CAST(count_if(NOT drop_) AS BIGINT) AS rows_after,
    CAST(count_if(candidate) AS BIGINT) AS n_flagged, CAST(count_if(drop_) AS BIGINT) AS n_dropped,
    CAST(count_if(candidate AND "NearEvent") AS BIGINT) AS n_kept_due_to_events,
    CAST(count_if(candidate AND NOT "NearEvent" AND "VolSpike") AS BIGINT) AS n_kept_due_to_vol_spike
  FROM fl2 GROUP BY ticker),
evc AS (
  SELECT ticker, CAST(count_if(kind = 'split') AS BIGINT) AS n_splits,
    CAST(count_if(kind = 'dividend') AS BIGINT) AS n_dividends,
    CAST(count_if(kind = 'earnings') AS BIGINT) AS n_earnings
  FROM ev GROUP BY ticker)
SELECT agg.*, coalesce(n_splits, 0) AS n_splits, coalesce(n_dividends, 0) AS n_dividends,
  coalesce(n_earnings, 0) AS n_earnings, 1 AS event_buffer_days, 0.5 AS abs_threshold,
  5.0 AS sigma_threshold, 20 AS sigma_window, 3.0 AS vol_spike_mult, 20 AS vol_window
FROM agg LEFT JOIN evc USING (ticker)""")
def q_outlier_qc(spark, sf):
    return rounded(cl.outlier_qc(tb.raw_bars(spark, sf), tb.corp_events(spark, sf)))


@register("clean_pipeline", f"""WITH {DEDUPED_CTE},
{outlier_ctes('SELECT * FROM pr')}
SELECT ticker, "Date", {r(BARS)} FROM fl2 WHERE NOT drop_""")
def q_clean_pipeline(spark, sf):
    return rounded(cl.cleaning_pipeline(tb.dirty_bars(spark, sf), tb.corp_events(spark, sf)))


# ------------------------------------------------------------------ entry point A (flagship)

def _processed_sql() -> str:
    from panelspark.plans import oracle_sql as osql
    from panelspark.plans.queries_core import plain
    ctes, fcols = osql.features_ctes("cbars", "reference")
    ictes, icols = osql.interactions_ctes(fcols)
    flags = [c for c in icols if c in osql.INTERACTION_FLAGS]
    dbl = [c for c in icols if c not in osql.INTERACTION_FLAGS]
    return (f"WITH RECURSIVE {DEDUPED_CTE},\n{outlier_ctes('SELECT * FROM pr')},\n"
            f'cbars AS (SELECT ticker, "Date", "Open", "High", "Low", "Close", "Volume" FROM fl2 WHERE NOT drop_),'
            f"{ctes}{ictes}\n"
            f'SELECT ticker, "Date", {r(BARS + fcols + dbl)}, "Target", {plain(flags)} FROM inter')


@register("processed_panel", _processed_sql())
def q_processed_panel(spark, sf):
    """Entry A on dirty bars + corporate events: the whole data build of the reference."""
    from panelspark.config import PanelConfig
    from panelspark.plans.pipeline import data_build
    conf = PanelConfig()
    return rounded(data_build(tb.dirty_bars(spark, sf), tb.corp_events(spark, sf), conf))
