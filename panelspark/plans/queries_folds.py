"""Registered queries: splits, purge, calendar blocks, walk-forward folds, pooled panels (K, G).

Testbed settings (dates of the testdata span 1995-2001): final test from 2000-01-01, train
cut-off 1999-01-01, 365-day blocks, horizon 5, embargo = horizon.
"""

from __future__ import annotations

from panelspark.operators import features as fx
from panelspark.operators import folds as fo
from panelspark.plans import oracle_sql as osql
from panelspark.plans.queries_core import REF_COLS, plain, r
from panelspark.plans.registry import register, rounded
from panelspark.sources import testbeds as tb
from panelspark.session import materialize

TRAIN_CUTOFF = "1999-01-01"
VALIDATE_CUTOFF = "2000-01-01"
H = 5
SLIDING_YEARS = 2

PANEL_SQL_CACHE: dict[str, tuple[str, list[str], list[str]]] = {}


def processed_panel(spark, sf):
    """The processed panel of the reference default config on calm bars, written once (the
    fold queries read it in several branches)."""
    return fx.build_processed_panel(tb.calm_bars(spark, sf), profile="reference").transform(materialize)


def panel_ctes() -> tuple[str, list[str], list[str]]:
    """WITH text ending in CTE ``inter`` (the processed panel), feature and interaction cols."""
    if "ref" not in PANEL_SQL_CACHE:
        ctes, fcols = osql.features_ctes("bars", "reference")
        ictes, icols = osql.interactions_ctes(fcols)
        PANEL_SQL_CACHE["ref"] = (f"{osql.with_bars('bars', tb.CALM_BARS_SQL)},{ctes}{ictes}", fcols, icols)
    return PANEL_SQL_CACHE["ref"]


def fold_ctes(mode: str = "expanding", fold_len: str = "365D", align: str = "ordinal") -> str:
    """CTEs insp (purged in-sample rows), blocks, fo (fold bounds), ft (trimmed bounds)."""
    base, _, _ = panel_ctes()
    if fold_len == "365D":
        edges = "SELECT ticker, unnest(generate_series(s, e, INTERVAL 365 DAY)) AS edge FROM rng"
    else:  # quarter ends
        edges = ("SELECT ticker, edge FROM (SELECT ticker, s, e, CAST(last_day(unnest(generate_series("
                 "date_trunc('month', s), e, INTERVAL 1 MONTH))) AS TIMESTAMP) AS edge FROM rng) "
                 "WHERE month(edge) % 3 = 0 AND edge >= s AND edge <= e")
    if mode == "expanding":
        tcount = f"""tc AS (SELECT b.ticker, b.k, count(i.rn) AS c_end, 0 AS c_start FROM blocks b
  LEFT JOIN insp i ON i.ticker = b.ticker AND i."Date" < b.vs - INTERVAL {H} DAY GROUP BY b.ticker, b.k),"""
    else:
        tcount = f"""tc0 AS (SELECT b.ticker, b.k, count(i.rn) AS c_end FROM blocks b
  LEFT JOIN insp i ON i.ticker = b.ticker AND i."Date" < b.vs - INTERVAL {H} DAY GROUP BY b.ticker, b.k),
tc1 AS (SELECT b.ticker, b.k, count(i.rn) AS c_start FROM blocks b
  LEFT JOIN insp i ON i.ticker = b.ticker AND i."Date" < b.vs - INTERVAL {H} DAY - INTERVAL {SLIDING_YEARS} YEAR
  GROUP BY b.ticker, b.k),
tc AS (SELECT * FROM tc0 JOIN tc1 USING (ticker, k)),"""
    if align == "calendar":
        rng = ('rng AS (SELECT ticker, s, e FROM (SELECT DISTINCT ticker FROM insp), '
               '(SELECT min("Date") AS s, max("Date") AS e FROM insp) WHERE s < e)')
    else:
        rng = 'rng AS (SELECT ticker, min("Date") AS s, max("Date") AS e FROM insp GROUP BY ticker HAVING min("Date") < max("Date"))'
    return f"""{base},
ins0 AS (SELECT ticker, "Date", row_number() OVER (PARTITION BY ticker ORDER BY "Date") AS rn,
  count(*) OVER (PARTITION BY ticker) AS n FROM inter WHERE "Date" < TIMESTAMP '{VALIDATE_CUTOFF}'),
insp AS (SELECT ticker, "Date", rn FROM ins0 WHERE rn <= n - {H}),
{rng},
edges AS ({edges} UNION SELECT ticker, s FROM rng UNION SELECT ticker, e FROM rng),
blocks AS (SELECT * FROM (SELECT ticker, CAST(row_number() OVER (PARTITION BY ticker ORDER BY edge) - 1 AS INTEGER) AS k,
  edge AS vs, lead(edge) OVER (PARTITION BY ticker ORDER BY edge) AS ve FROM edges) WHERE ve IS NOT NULL),
vr AS (SELECT b.ticker, b.k, i."Date", row_number() OVER (PARTITION BY b.ticker, b.k ORDER BY i."Date") AS rb,
  count(*) OVER (PARTITION BY b.ticker, b.k) AS vc
  FROM blocks b JOIN insp i ON i.ticker = b.ticker AND i."Date" >= b.vs AND i."Date" < b.ve),
vv AS (SELECT ticker, k, min("Date") AS val_lo, max("Date") AS val_hi, count(*) AS n_val FROM vr
  WHERE rb <= vc - {H} GROUP BY ticker, k),
{tcount}
tt AS (SELECT tc.ticker, tc.k, tc.c_end - tc.c_start - {H} AS n_train, lo."Date" AS train_lo, hi."Date" AS train_hi
  FROM tc LEFT JOIN insp lo ON lo.ticker = tc.ticker AND lo.rn = tc.c_start + 1
  LEFT JOIN insp hi ON hi.ticker = tc.ticker AND hi.rn = tc.c_end - {H}),
fo AS (SELECT ticker, CAST(row_number() OVER (PARTITION BY ticker ORDER BY k) - 1 AS INTEGER) AS fold,
  train_lo, train_hi, val_lo, val_hi, CAST(n_train AS BIGINT) AS n_train, CAST(n_val AS BIGINT) AS n_val
  FROM vv JOIN tt USING (ticker, k) WHERE n_val >= 5 AND n_train >= 50),
ft AS (SELECT * FROM fo WHERE fold < (SELECT min(c) FROM (SELECT count(*) AS c FROM fo GROUP BY ticker)))"""


FOLD_COLS = "ticker, fold, train_lo, train_hi, val_lo, val_hi, n_train, n_val"


def bounds(spark, sf, mode="expanding", panel=None, align="ordinal"):
    p = panel if panel is not None else processed_panel(spark, sf)
    return fo.fold_bounds(p, VALIDATE_CUTOFF, H, None, "365D", mode,
                          SLIDING_YEARS if mode == "sliding" else None, align=align)


# ------------------------------------------------------------------ K1-K4

@register("split2", f"""{panel_ctes()[0]}
SELECT ticker, "Date", CASE WHEN coalesce("Date" < TIMESTAMP '{TRAIN_CUTOFF}', false) THEN 'train' ELSE 'test' END AS split
FROM inter""")
def q_split2(spark, sf):
    return fo.split2(processed_panel(spark, sf), TRAIN_CUTOFF).select("ticker", "Date", "split")


@register("split3", f"""{panel_ctes()[0]}
SELECT ticker, "Date", CASE WHEN "Date" < TIMESTAMP '{TRAIN_CUTOFF}' THEN 'train'
  WHEN "Date" < TIMESTAMP '{VALIDATE_CUTOFF}' THEN 'validate' ELSE 'test' END AS split FROM inter""")
def q_split3(spark, sf):
    return fo.split3(processed_panel(spark, sf), TRAIN_CUTOFF, VALIDATE_CUTOFF).select("ticker", "Date", "split")


def _xy_sql():
    base, fcols, icols = panel_ctes()
    flags = [c for c in icols if c in osql.INTERACTION_FLAGS]
    dbl = [c for c in fcols] + [c for c in icols if c not in osql.INTERACTION_FLAGS]
    return f'{base}\nSELECT ticker, "Date", {r(dbl)}, {plain(flags)}, "Target" FROM inter'


@register("xy_projection", _xy_sql())
def q_xy(spark, sf):
    return rounded(fo.xy_projection(processed_panel(spark, sf)))


@register("purge_tail", f"""{panel_ctes()[0]}
SELECT ticker, "Date" FROM (SELECT ticker, "Date", row_number() OVER (PARTITION BY ticker ORDER BY "Date" DESC) AS rk
  FROM inter) WHERE rk > {H}""")
def q_purge(spark, sf):
    return fo.purge_tail(processed_panel(spark, sf), H).select("ticker", "Date")


# ------------------------------------------------------------------ K6

def _blocks(spark, sf, fold_len):
    ins, _ = fo.insample_test(processed_panel(spark, sf), VALIDATE_CUTOFF, H)
    from pyspark.sql import functions as F
    ranges = ins.groupBy("ticker").agg(F.min("Date").alias("start"), F.max("Date").alias("end"))
    return fo.calendar_blocks(ranges, fold_len)


@register("calendar_blocks_365d", f"{fold_ctes('expanding', '365D')}\nSELECT ticker, k, vs, ve FROM blocks")
def q_blocks_365(spark, sf):
    return _blocks(spark, sf, "365D")


@register("calendar_blocks_quarter", f"{fold_ctes('expanding', 'Q')}\nSELECT ticker, k, vs, ve FROM blocks")
def q_blocks_q(spark, sf):
    return _blocks(spark, sf, "Q")


# ------------------------------------------------------------------ K7-K9

@register("folds_expanding", f"{fold_ctes('expanding')}\nSELECT {FOLD_COLS} FROM fo")
def q_folds_expanding(spark, sf):
    return bounds(spark, sf, "expanding")


@register("folds_sliding", f"{fold_ctes('sliding')}\nSELECT {FOLD_COLS} FROM fo")
def q_folds_sliding(spark, sf):
    return bounds(spark, sf, "sliding")


@register("folds_calendar", f"{fold_ctes('expanding', align='calendar')}\nSELECT {FOLD_COLS} FROM fo")
def q_folds_calendar(spark, sf):
    """K7 with common calendar block edges (D6 option)."""
    return bounds(spark, sf, "expanding", align="calendar")


@register("folds_trimmed", f"{fold_ctes('expanding')}\nSELECT {FOLD_COLS} FROM ft")
def q_folds_trimmed(spark, sf):
    return fo.trim_folds(bounds(spark, sf, "expanding"))


# ------------------------------------------------------------------ G1-G4

def _x_cols():
    _, fcols, icols = panel_ctes()
    return fcols, icols


def _pairs_sql():
    fcols, icols = _x_cols()
    flags = [c for c in icols if c in osql.INTERACTION_FLAGS]
    dbl = fcols + [c for c in icols if c not in osql.INTERACTION_FLAGS]
    nn = " AND ".join(f'"{c}" IS NOT NULL' for c in fcols + icols)
    return f"""{fold_ctes('expanding')},
pj AS (SELECT p.*, ft.fold, CASE WHEN p."Date" BETWEEN ft.train_lo AND ft.train_hi THEN 'train' ELSE 'val' END AS role
  FROM inter p JOIN ft ON p.ticker = ft.ticker AND (p."Date" BETWEEN ft.train_lo AND ft.train_hi OR p."Date" BETWEEN ft.val_lo AND ft.val_hi))
SELECT ticker AS "__ticker__", "Date", {r(dbl)}, {plain(flags)}, "Target", fold, role FROM pj WHERE {nn}"""


@register("global_pairs", _pairs_sql())
def q_global_pairs(spark, sf):
    panel = processed_panel(spark, sf)
    b = fo.trim_folds(bounds(spark, sf, "expanding", panel))
    return rounded(fo.global_fold_pairs(panel, b))


def _ins_test_sql(final=None):
    fcols, icols = _x_cols()
    flags = [c for c in icols if c in osql.INTERACTION_FLAGS]
    dbl = fcols + [c for c in icols if c not in osql.INTERACTION_FLAGS]
    nn = " AND ".join(f'"{c}" IS NOT NULL' for c in fcols + icols)
    body = final or f'SELECT ticker AS "__ticker__", "Date", {r(dbl)}, {plain(flags)}, "Target", role FROM it WHERE {nn}'
    return f"""{fold_ctes('expanding')},
ins AS (SELECT p.*, 'insample' AS role FROM inter p WHERE EXISTS (SELECT 1 FROM ft WHERE ft.ticker = p.ticker AND
  (p."Date" BETWEEN ft.train_lo AND ft.train_hi OR p."Date" BETWEEN ft.val_lo AND ft.val_hi))),
te AS (SELECT * EXCLUDE (rk), 'test' AS role FROM (SELECT p.*, row_number() OVER (PARTITION BY ticker ORDER BY "Date" DESC) AS rk
  FROM inter p WHERE "Date" >= TIMESTAMP '{VALIDATE_CUTOFF}') WHERE rk > {H} AND ticker IN (SELECT ticker FROM ft)),
it AS (SELECT * FROM ins UNION ALL SELECT * FROM te)
{body}"""


@register("insample_test", _ins_test_sql())
def q_insample_test(spark, sf):
    panel = processed_panel(spark, sf)
    b = fo.trim_folds(bounds(spark, sf, "expanding", panel))
    return rounded(fo.global_insample_and_test(panel, b, VALIDATE_CUTOFF, H))


@register("panel_integrity", _ins_test_sql(
    final="""SELECT CAST(sum(n) AS BIGINT) AS n_rows, count(*) AS n_keys, CAST(count_if(n > 1) AS BIGINT) AS n_dup_keys
FROM (SELECT ticker, "Date", count(*) AS n FROM it WHERE role = 'insample' GROUP BY ticker, "Date")"""))
def q_integrity(spark, sf):
    panel = processed_panel(spark, sf)
    b = fo.trim_folds(bounds(spark, sf, "expanding", panel))
    both = fo.global_insample_and_test(panel, b, VALIDATE_CUTOFF, H, dropna=False)
    from pyspark.sql import functions as F
    return fo.panel_integrity(both.filter(F.col("role") == "insample"))


@register("dropna_xy", _pairs_sql().replace("SELECT ticker AS", "SELECT ticker AS", 1))
def q_dropna_xy(spark, sf):
    """G2 on its own: the pooled pairs before dropna, then dropna (same result as G1's default)."""
    panel = processed_panel(spark, sf)
    b = fo.trim_folds(bounds(spark, sf, "expanding", panel))
    return rounded(fo.dropna_features(fo.global_fold_pairs(panel, b, dropna=False)))


def _fwt_sql():
    base, fcols, icols = panel_ctes()
    flags = [c for c in icols if c in osql.INTERACTION_FLAGS]
    dbl = fcols + [c for c in icols if c not in osql.INTERACTION_FLAGS]
    return f'{base}\nSELECT ticker AS "__ticker__", "Date", {r(dbl)}, {plain(flags)}, "Target" FROM inter'


@register("frame_with_target", _fwt_sql())
def q_frame_with_target(spark, sf):
    """Features + Target with the ticker as ``__ticker__`` (Date stays a column)."""
    return rounded(fo.frame_with_target(processed_panel(spark, sf)))
