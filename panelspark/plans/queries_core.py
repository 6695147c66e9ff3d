"""Registered queries: panels, sources, features and interactions (S, F, I)."""

from __future__ import annotations

from pyspark.sql import functions as F

from panelspark.functions.windows import by_key
from panelspark.operators import features as fx
from panelspark.plans import oracle_sql as osql
from panelspark.plans.registry import NUDGE, register, rounded
from panelspark.sources import testbeds as tb

BARS = ["Open", "High", "Low", "Close", "Volume"]


def r(cols) -> str:
    return ", ".join(f'{R6(chr(34) + c + chr(34))} AS "{c}"' for c in cols)


def R6(expr: str) -> str:
    """SQL twin of ``registry.round6``."""
    return f"(round(({expr}) + {NUDGE}, 6) + 0.0)"


def plain(cols) -> str:
    return ", ".join(f'"{c}"' for c in cols)


def feat_sql(profile: str, groups=None, dropna=True, select=None, extra_ctes: str = "",
             final: str | None = None) -> str:
    ctes, cols = osql.features_ctes("bars", profile, dropna=dropna, groups=groups)
    body = final
    if body is None:
        sel = select if select is not None else cols
        body = f'SELECT ticker, "Date", {r(sel)} FROM feat'
    return f"{osql.with_bars('bars', tb.CALM_BARS_SQL)},{ctes}{extra_ctes}\n{body}"


# ---------------------------------------------------------------- panels / sources

@register("bars_calm", f'SELECT ticker, "Date", {r(BARS)} FROM ({tb.CALM_BARS_SQL})')
def q_bars_calm(spark, sf):
    return rounded(tb.calm_bars(spark, sf))


@register("bars_raw", f'SELECT ticker, "Date", {r(BARS)} FROM ({tb.RAW_BARS_SQL})')
def q_bars_raw(spark, sf):
    return rounded(tb.raw_bars(spark, sf))


@register("bars_wide", f'SELECT ticker, "Date", {r(BARS)} FROM ({tb.WIDE_BARS_SQL})')
def q_bars_wide(spark, sf):
    return rounded(tb.wide_bars(spark, sf))


@register("events_load", f"SELECT ticker, event_ts, kind FROM ({tb.CORP_EVENTS_SQL})")
def q_events(spark, sf):
    return tb.corp_events(spark, sf)


# ---------------------------------------------------------------- features

REF_COLS = ["Return_1d", "SMA_5", "SMA_20", "SMA_ratio", "RSI_14", "MACD", "MACD_signal",
            "BB_upper", "BB_lower", "BB_width", "HL_range", "CO_gap"]
FULL_FEATURES = ("r_1d", "lag", "sma", "vix", "rsi", "macd", "boll", "obv", "range", "gap")
FULL_COLS = ["Return_1d", "Return_1d_lag1", "Return_1d_lag2", "Return_1d_lag3", "Return_1d_lag5",
             "SMA_5", "SMA_20", "SMA_ratio", "Volatility_20", "RSI_14", "MACD", "MACD_signal",
             "BB_upper", "BB_lower", "BB_width", "OBV", "HL_range", "CO_gap"]


def _panel_sql(profile, cols):
    return feat_sql(profile, final=f'SELECT ticker, "Date", {r(BARS + cols)}, "Target" FROM feat')


@register("features_reference", _panel_sql("reference", REF_COLS))
def q_features_reference(spark, sf):
    return rounded(fx.make_features(tb.calm_bars(spark, sf), profile="reference"))


@register("features_full", _panel_sql("full", FULL_COLS))
def q_features_full(spark, sf):
    return rounded(fx.make_features(tb.calm_bars(spark, sf), FULL_FEATURES, profile="full"))


def _single(group: str, cols: list[str]):
    """One feature group on the raw calm bars, no warm-up drop."""
    def build(spark, sf):
        df = fx.make_features(tb.calm_bars(spark, sf), [group], profile="full", dropna=False)
        return rounded(df.select("ticker", "Date", *cols))
    sql = feat_sql("full", groups=[group], dropna=False, select=cols)
    return build, sql


for _name, _group, _cols in [
    ("return_1d", "r_1d", ["Return_1d"]),
    ("sma", "sma", ["SMA_5", "SMA_20", "SMA_ratio"]),
    ("rsi", "rsi", ["RSI_14"]),
    ("macd", "macd", ["MACD", "MACD_signal"]),
    ("bollinger", "boll", ["BB_upper", "BB_lower", "BB_width"]),
    ("obv", "obv", ["OBV"]),
    ("range", "range", ["HL_range"]),
    ("gap", "gap", ["CO_gap"]),
]:
    _fn, _sql = _single(_group, _cols)
    register(_name, _sql)(_fn)


def _lags_sql():
    return feat_sql("full", dropna=False,
                    select=["Return_1d_lag1", "Return_1d_lag2", "Return_1d_lag3", "Return_1d_lag5"])


@register("lags", _lags_sql())
def q_lags(spark, sf):
    df = fx.make_features(tb.calm_bars(spark, sf), ["r_1d", "lag"], profile="full", dropna=False)
    return rounded(df.select("ticker", "Date", "Return_1d_lag1", "Return_1d_lag2", "Return_1d_lag3",
                             "Return_1d_lag5"))


@register("volatility", feat_sql("full", dropna=False, select=["Volatility_20"]))
def q_volatility(spark, sf):
    df = fx.make_features(tb.calm_bars(spark, sf), ["r_1d", "vix"], profile="full", dropna=False)
    return rounded(df.select("ticker", "Date", "Volatility_20"))


@register("target", feat_sql("full", dropna=False,
                             final='SELECT ticker, "Date", "Target" FROM feat'))
def q_target(spark, sf):
    df = fx.add_target(tb.calm_bars(spark, sf), 5, 0.01)
    return df.select("ticker", "Date", "Target")


_Z_SQL = (f"{osql.with_bars('bars', tb.CALM_BARS_SQL)},\n"
          f"z AS (SELECT ticker, \"Date\", (\"Close\" - ({osql.rmean(chr(34) + 'Close' + chr(34), 100, 20)})) / "
          f"NULLIF(({osql.rstd(chr(34) + 'Close' + chr(34), 100, 20)}), 0) AS z FROM bars)\n"
          f"SELECT ticker, \"Date\", {R6('CASE WHEN z IS NULL THEN NULL ELSE least(greatest(z, -6.0), 6.0) END')} "
          f"AS close_z FROM z")


@register("zscore", _Z_SQL)
def q_zscore(spark, sf):
    bars = tb.calm_bars(spark, sf)
    w = by_key()
    return rounded(bars.select("ticker", "Date", fx.zscore("Close", w, 100, 20, 6.0).alias("close_z")))


# ---------------------------------------------------------------- interactions

def _inter_sql(profile, cols):
    ctes, fcols = osql.features_ctes("bars", profile)
    ictes, icols = osql.interactions_ctes(fcols)
    flags = [c for c in icols if c in osql.INTERACTION_FLAGS]
    dbl = [c for c in icols if c not in osql.INTERACTION_FLAGS]
    return (f"{osql.with_bars('bars', tb.CALM_BARS_SQL)},{ctes}{ictes}\n"
            f'SELECT ticker, "Date", {r(BARS + cols + dbl)}, "Target", {plain(flags)} FROM inter')


@register("interactions_reference", _inter_sql("reference", REF_COLS))
def q_inter_ref(spark, sf):
    return rounded(fx.build_processed_panel(tb.calm_bars(spark, sf), profile="reference"))


@register("interactions_full", _inter_sql("full", FULL_COLS))
def q_inter_full(spark, sf):
    return rounded(fx.build_processed_panel(tb.calm_bars(spark, sf), FULL_FEATURES, profile="full"))
