"""DuckDB SQL text for the oracle side of each registered query.

Written independently of the Spark code from the operator definitions: plain window SQL,
and a recursive CTE for the EMA (the sequential definition, not the blocked form).
Every double output is rounded to 6 places on both sides.
"""

from __future__ import annotations

from panelspark.sources.testbeds import CALM_BARS_SQL, CORP_EVENTS_SQL, DIRTY_BARS_SQL, RAW_BARS_SQL

W = 'PARTITION BY ticker ORDER BY "Date"'


def frame(n: int) -> str:
    return f'({W} ROWS BETWEEN {n - 1} PRECEDING AND CURRENT ROW)'


RUN = f'({W} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)'


def rmean(c: str, n: int, mp: int | None = None) -> str:
    mp = n if mp is None else mp
    return f"CASE WHEN count({c}) OVER {frame(n)} >= {mp} THEN avg({c}) OVER {frame(n)} END"


def rstd(c: str, n: int, mp: int | None = None) -> str:
    mp = n if mp is None else mp
    return f"CASE WHEN count({c}) OVER {frame(n)} >= {mp} THEN stddev_samp({c}) OVER {frame(n)} END"


def rmedian(c: str, n: int, mp: int | None = None) -> str:
    mp = n if mp is None else mp
    return f"CASE WHEN count({c}) OVER {frame(n)} >= {mp} THEN median({c}) OVER {frame(n)} END"


def rnd(cols) -> str:
    return ", ".join(f'round({c}, 6) AS {c}' for c in cols)


def q(c: str) -> str:
    return f'"{c}"'


BAR_COLS = ['"Open"', '"High"', '"Low"', '"Close"', '"Volume"']


def ew_y(y: str, w: str, x: str, a: float) -> str:
    """Next EMA value with pandas' gap rule (adjust=False, ignore_na=False): the old weight
    decays on every row, a new value renormalises; a null input keeps the value."""
    q = 1.0 - a
    return (f"CASE WHEN {y} IS NULL THEN {x} WHEN {x} IS NULL THEN {y} "
            f"ELSE (({w} * {q}) * {y} + {a} * {x}) / (({w} * {q}) + {a}) END")


def ew_w(y: str, w: str, x: str, a: float) -> str:
    q = 1.0 - a
    return f"CASE WHEN {y} IS NULL THEN CAST(1.0 AS DOUBLE) WHEN {x} IS NULL THEN {w} * {q} ELSE CAST(1.0 AS DOUBLE) END"


def features_ctes(src: str, profile: str = "reference", horizon: int = 5,
                  threshold: float = 0.01, dropna: bool = True, groups=None) -> tuple[str, list[str]]:
    """CTE text ending in a CTE named ``feat`` (plus its feature column list, in order).

    ``src`` is the name of a CTE with ticker, Date, Open, High, Low, Close, Volume.
    """
    if groups is None:
        groups = (["r_1d", "sma", "rsi", "macd", "boll", "range", "gap"] if profile == "reference"
                  else ["r_1d", "lag", "sma", "vix", "rsi", "macd", "boll", "obv", "range", "gap"])
    a12, a26, a9 = 2.0 / 13.0, 2.0 / 27.0, 2.0 / 10.0
    macd_new = (f"(({ew_y('r.e12', 'r.w12', 'x.\"Close\"', a12)}) - "
                f"({ew_y('r.e26', 'r.w26', 'x.\"Close\"', a26)}))")
    fwd = ", ".join(f'lead("Close", {k}) OVER ({W}) / NULLIF("Close", 0) - 1' for k in range(1, horizon + 1))
    best = f"greatest({fwd})" if horizon > 1 else fwd
    ctes = f"""
fa AS (
  SELECT *, row_number() OVER ({W}) - 1 AS t,
    last_value("Close" IGNORE NULLS) OVER {RUN} AS cp,
    "Close" - lag("Close") OVER ({W}) AS delta,
    {rmean('"Close"', 5)} AS "SMA_5", {rmean('"Close"', 20)} AS "SMA_20",
    {rstd('"Close"', 20)} AS sd20,
    CASE WHEN coalesce({best} > {threshold}, false) THEN 1 ELSE 0 END AS "Target"
  FROM {src}),
fb AS (
  SELECT *, cp / NULLIF(lag(cp) OVER ({W}), 0) - 1 AS "Return_1d",
    CASE WHEN delta IS NULL THEN NULL ELSE greatest(delta, 0.0) END AS gain,
    CASE WHEN delta IS NULL THEN NULL ELSE greatest(-delta, 0.0) END AS loss,
    sign(coalesce(delta, 0.0)) * "Volume" AS obv_step
  FROM fa),
fc AS (
  SELECT *, {rmean('gain', 14)} AS ag, {rmean('loss', 14)} AS al,
    {rstd('"Return_1d"', 20)} AS "Volatility_20",
    lag("Return_1d", 1) OVER ({W}) AS "Return_1d_lag1", lag("Return_1d", 2) OVER ({W}) AS "Return_1d_lag2",
    lag("Return_1d", 3) OVER ({W}) AS "Return_1d_lag3", lag("Return_1d", 5) OVER ({W}) AS "Return_1d_lag5",
    sum(obv_step) OVER {RUN} AS "OBV"
  FROM fb),
ema(ticker, t, e12, w12, e26, w26, sig, ws) AS (
  SELECT ticker, t, CAST("Close" AS DOUBLE), CAST(1.0 AS DOUBLE), CAST("Close" AS DOUBLE), CAST(1.0 AS DOUBLE),
    CAST(CASE WHEN "Close" IS NULL THEN NULL ELSE 0.0 END AS DOUBLE), CAST(1.0 AS DOUBLE) FROM fa WHERE t = 0
  UNION ALL
  SELECT x.ticker, x.t,
    {ew_y('r.e12', 'r.w12', 'x."Close"', a12)}, {ew_w('r.e12', 'r.w12', 'x."Close"', a12)},
    {ew_y('r.e26', 'r.w26', 'x."Close"', a26)}, {ew_w('r.e26', 'r.w26', 'x."Close"', a26)},
    {ew_y('r.sig', 'r.ws', macd_new, a9)}, {ew_w('r.sig', 'r.ws', macd_new, a9)}
  FROM ema r JOIN fa x ON x.ticker = r.ticker AND x.t = r.t + 1),
fd AS (
  SELECT fc.*, e12 - e26 AS "MACD", sig AS "MACD_signal",
    "SMA_5" / NULLIF("SMA_20", 0) AS "SMA_ratio",
    100.0 - 100.0 / (1 + ag / NULLIF(al, 0)) AS "RSI_14",
    "SMA_20" + 2.0 * sd20 AS "BB_upper", "SMA_20" - 2.0 * sd20 AS "BB_lower",
    (("SMA_20" + 2.0 * sd20) - ("SMA_20" - 2.0 * sd20)) / NULLIF("SMA_20", 0) AS "BB_width",
    ("High" - "Low") / NULLIF("Close", 0) AS "HL_range",
    ("Close" - "Open") / NULLIF("Open", 0) AS "CO_gap"
  FROM fc JOIN ema USING (ticker, t))"""
    cols = []
    if "r_1d" in groups:
        cols.append("Return_1d")
    if "lag" in groups:
        cols += ["Return_1d_lag1", "Return_1d_lag2", "Return_1d_lag3", "Return_1d_lag5"]
    if "sma" in groups:
        cols += ["SMA_5", "SMA_20", "SMA_ratio"]
    if "vix" in groups:
        cols.append("Volatility_20")
    if "rsi" in groups:
        cols.append("RSI_14")
    if "macd" in groups:
        cols += ["MACD", "MACD_signal"]
    if "boll" in groups:
        cols += ["BB_upper", "BB_lower", "BB_width"]
    if "obv" in groups:
        cols.append("OBV")
    if "range" in groups:
        cols.append("HL_range")
    if "gap" in groups:
        cols.append("CO_gap")
    sel = ", ".join(q(c) for c in ["ticker", "Date", "Open", "High", "Low", "Close", "Volume"] + cols + ["Target"])
    where = ""
    if dropna:
        nn = ["ticker", "Date", "Open", "High", "Low", "Close", "Volume"] + cols
        where = "WHERE " + " AND ".join(f"{q(c)} IS NOT NULL" for c in nn)
    ctes += f""",
feat AS (SELECT {sel} FROM fd {where})"""
    return ctes, cols


INTERACTION_ORDER = [
    "trend_mom__sma_x_rsi", "mom_disagree__macd_minus_rsi", "move_vs_vol__ret_over_vol",
    "vol_cond__ret_x_vol", "vol_trend__bbwidth_x_smaratio", "flow_price__obvZ_x_return",
    "gap_flow__gap_x_volrel20", "lag_cross__r1_lag1_x_lag2", "lag_vol__r1_lag1_x_vol",
    "regime__rsi_lt30", "regime__rsi_gt70", "regime__above_sma20", "regime__bands_widening_1d",
    "mom_agree__sign_macd_eq_lag1"]
INTERACTION_FLAGS = {"regime__rsi_lt30", "regime__rsi_gt70", "regime__above_sma20",
                     "regime__bands_widening_1d", "mom_agree__sign_macd_eq_lag1"}


def interactions_ctes(feat_cols: list[str]) -> tuple[str, list[str]]:
    """CTE ``inter`` over ``feat``: second window stage on the trimmed frame."""
    has = lambda *cs: all(c in feat_cols for c in cs)
    defs = {}
    if has("SMA_ratio", "RSI_14"):
        defs["trend_mom__sma_x_rsi"] = '"SMA_ratio" * "RSI_14"'
    if has("MACD", "RSI_14"):
        defs["mom_disagree__macd_minus_rsi"] = '"MACD" - "RSI_14"'
    if has("Return_1d", "Volatility_20"):
        defs["move_vs_vol__ret_over_vol"] = '"Return_1d" / NULLIF("Volatility_20", 0)'
        defs["vol_cond__ret_x_vol"] = '"Return_1d" * "Volatility_20"'
    if has("BB_width", "SMA_ratio"):
        defs["vol_trend__bbwidth_x_smaratio"] = '"BB_width" * "SMA_ratio"'
    if has("OBV", "Return_1d"):
        defs["flow_price__obvZ_x_return"] = ('CASE WHEN obv_z IS NULL THEN NULL ELSE least(greatest(obv_z, -6.0), 6.0) END'
                                             ' * "Return_1d"')
    defs["gap_flow__gap_x_volrel20"] = '"CO_gap" * ("Volume" / NULLIF(vol_ma20, 0))' if has("CO_gap") else None
    if has("Return_1d_lag1", "Return_1d_lag2"):
        defs["lag_cross__r1_lag1_x_lag2"] = '"Return_1d_lag1" * "Return_1d_lag2"'
    if has("Return_1d_lag1", "Volatility_20"):
        defs["lag_vol__r1_lag1_x_vol"] = '"Return_1d_lag1" * "Volatility_20"'
    if has("RSI_14"):
        defs["regime__rsi_lt30"] = 'CASE WHEN coalesce("RSI_14" < 30, false) THEN 1 ELSE 0 END'
        defs["regime__rsi_gt70"] = 'CASE WHEN coalesce("RSI_14" > 70, false) THEN 1 ELSE 0 END'
    if has("SMA_20"):
        defs["regime__above_sma20"] = 'CASE WHEN coalesce("Close" > "SMA_20", false) THEN 1 ELSE 0 END'
    if has("BB_width"):
        defs["regime__bands_widening_1d"] = (
            f'CASE WHEN coalesce(bbw_p / NULLIF(lag(bbw_p) OVER ({W}), 0) - 1 > 0, false) THEN 1 ELSE 0 END')
    if has("MACD", "Return_1d_lag1"):
        defs["mom_agree__sign_macd_eq_lag1"] = 'CASE WHEN coalesce(sign("MACD") = sign("Return_1d_lag1"), false) THEN 1 ELSE 0 END'
    defs = {k: v for k, v in defs.items() if v is not None}
    out_cols = [c for c in INTERACTION_ORDER if c in defs]
    obv_z = (f'("OBV" - ({rmean(chr(34) + "OBV" + chr(34), 100, 20)})) / NULLIF(({rstd(chr(34) + "OBV" + chr(34), 100, 20)}), 0)'
             if has("OBV") else "NULL")
    ctes = f""",
ia AS (
  SELECT *, {obv_z} AS obv_z, {rmean('"Volume"', 20, 5)} AS vol_ma20,
    {"last_value(" + q("BB_width") + " IGNORE NULLS) OVER " + RUN if has("BB_width") else "NULL"} AS bbw_p
  FROM feat),
inter AS (
  SELECT {", ".join(q(c) for c in ["ticker", "Date", "Open", "High", "Low", "Close", "Volume"] + feat_cols + ["Target"])},
    {", ".join(f"{defs[c]} AS {q(c)}" for c in out_cols)}
  FROM ia)"""
    return ctes, out_cols


def with_bars(name: str = "bars", bars_sql: str = CALM_BARS_SQL) -> str:
    return f"WITH RECURSIVE {name} AS ({bars_sql})"


__all__ = ["CALM_BARS_SQL", "RAW_BARS_SQL", "DIRTY_BARS_SQL", "CORP_EVENTS_SQL", "features_ctes",
           "interactions_ctes", "with_bars", "rmean", "rstd", "rmedian", "frame", "RUN", "W", "q"]
