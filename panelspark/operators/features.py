"""Technical-indicator features, forward label (F1-F13) and interaction features.

Every feature is a window expression over ``W = partitionBy(ticker).orderBy(Date)``; the
whole stack shares one exchange on ``ticker``. Stages are separated only where a window
reads another window's output (window functions cannot nest).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelspark.functions.windows import (
    KEY, ORDER, add_ewm, by_key, clip, flag_int, padded, ratio_change, roll_mean, roll_std,
    running, safe_div)

BAR_COLS = ["Open", "High", "Low", "Close", "Volume"]

# Feature groups emitted by each profile. The reference pipeline tests the
# lag and volatility switches with a list inside a list, so they never fire ("reference").
REFERENCE_GROUPS = ("r_1d", "sma", "rsi", "macd", "boll", "obv", "range", "gap")
FULL_GROUPS = ("r_1d", "lag", "sma", "vix", "rsi", "macd", "boll", "obv", "range", "gap")
LAGS = (1, 2, 3, 5)


def parse_features(features) -> list[str]:
    if features is None:
        return list(("r_1d", "lag", "sma", "vix", "rsi", "macd", "boll", "range", "gap"))
    if isinstance(features, str):
        return [f.strip() for f in features.split(",") if f.strip()]
    features = list(features)
    if features and isinstance(features[0], str) and "," in features[0]:
        return [f.strip() for f in features[0].split(",") if f.strip()]
    return features


def active_groups(features, profile: str) -> list[str]:
    req = parse_features(features)
    allowed = REFERENCE_GROUPS if profile == "reference" else FULL_GROUPS
    return [g for g in allowed if g in req]


def add_return_1d(df: DataFrame, key=KEY, order=ORDER) -> DataFrame:
    w = by_key(key, order)
    return (df.withColumn("_cp", padded("Close", w))
            .withColumn("Return_1d", ratio_change("_cp", w)).drop("_cp"))


def add_lags(df: DataFrame, base_col="Return_1d", lags=LAGS, key=KEY, order=ORDER) -> DataFrame:
    w = by_key(key, order)
    return df.withColumns({f"{base_col}_lag{k}": F.lag(base_col, k).over(w) for k in lags})


def add_sma(df: DataFrame, short=5, long=20, key=KEY, order=ORDER) -> DataFrame:
    w = by_key(key, order)
    df = df.withColumns({f"SMA_{short}": roll_mean("Close", w, short),
                         f"SMA_{long}": roll_mean("Close", w, long)})
    return df.withColumn("SMA_ratio", F.try_divide(F.col(f"SMA_{short}"), F.col(f"SMA_{long}")))


def add_volatility(df: DataFrame, window=20, ret_col="Return_1d", key=KEY, order=ORDER) -> DataFrame:
    w = by_key(key, order)
    return df.withColumn(f"Volatility_{window}", roll_std(ret_col, w, window))


def add_rsi(df: DataFrame, window=14, key=KEY, order=ORDER) -> DataFrame:
    """Simple-mean RSI; null where the mean loss is zero."""
    w = by_key(key, order)
    delta = F.col("Close") - F.lag("Close", 1).over(w)
    df = df.withColumn("_delta", delta)
    gain = F.when(F.col("_delta").isNull(), None).otherwise(F.greatest("_delta", F.lit(0.0)))
    loss = F.when(F.col("_delta").isNull(), None).otherwise(F.greatest(-F.col("_delta"), F.lit(0.0)))
    df = df.withColumns({"_gain": gain, "_loss": loss})
    df = df.withColumns({"_ag": roll_mean("_gain", w, window), "_al": roll_mean("_loss", w, window)})
    rs = safe_div(F.col("_ag"), F.col("_al"))
    return df.withColumn(f"RSI_{window}", F.lit(100.0) - F.lit(100.0) / (F.lit(1.0) + rs)).drop(
        "_delta", "_gain", "_loss", "_ag", "_al")


def add_macd(df: DataFrame, fast=12, slow=26, signal=9, key=KEY, order=ORDER,
             block: float | None = None) -> DataFrame:
    """MACD = EMA_fast - EMA_slow, MACD_signal = EMA_signal(MACD)."""
    df = add_ewm(df, [("Close", "_ema_f", fast), ("Close", "_ema_s", slow)], key, order, block,
                 then=[("MACD", lambda: F.col("_ema_f") - F.col("_ema_s"), [("MACD", "MACD_signal", signal)])])
    return df.drop("_ema_f", "_ema_s")


def add_bollinger(df: DataFrame, window=20, n_std=2.0, key=KEY, order=ORDER) -> DataFrame:
    w = by_key(key, order)
    # The band centre is the same trailing mean as SMA_<window>; reuse it when present.
    ma = F.col(f"SMA_{window}") if f"SMA_{window}" in df.columns else roll_mean("Close", w, window)
    df = df.withColumns({"_ma": ma, "_sd": roll_std("Close", w, window)})
    df = df.withColumns({"BB_upper": F.col("_ma") + F.lit(n_std) * F.col("_sd"),
                         "BB_lower": F.col("_ma") - F.lit(n_std) * F.col("_sd")})
    return df.withColumn("BB_width", safe_div(F.col("BB_upper") - F.col("BB_lower"), F.col("_ma"))).drop(
        "_ma", "_sd")


def add_obv(df: DataFrame, key=KEY, order=ORDER) -> DataFrame:
    w = by_key(key, order)
    step = F.signum(F.coalesce(F.col("Close") - F.lag("Close", 1).over(w), F.lit(0.0))) * F.col("Volume")
    df = df.withColumn("_obv_step", step)
    return df.withColumn("OBV", F.sum("_obv_step").over(running(w))).drop("_obv_step")


def add_intraday_range(df: DataFrame) -> DataFrame:
    return df.withColumn("HL_range", safe_div(F.col("High") - F.col("Low"), F.col("Close")))


def add_gap(df: DataFrame) -> DataFrame:
    return df.withColumn("CO_gap", safe_div(F.col("Close") - F.col("Open"), F.col("Open")))


def add_target(df: DataFrame, horizon=5, threshold=0.01, key=KEY, order=ORDER) -> DataFrame:
    """Target = 1 if the best of the next ``horizon`` closes beats today by > threshold.

    Rows without any future close get 0, as in the reference (purged later by folds).
    """
    w = by_key(key, order)
    fwd = [F.try_divide(F.lead("Close", k).over(w), F.col("Close")) - F.lit(1.0)
           for k in range(1, horizon + 1)]
    best = F.greatest(*fwd) if len(fwd) > 1 else fwd[0]
    return df.withColumn("Target", flag_int(best > F.lit(threshold)))


def make_features(bars: DataFrame, features=None, horizon: int = 5, threshold: float = 0.01,
                  profile: str = "reference", dropna: bool = True, key=KEY, order=ORDER,
                  ewm_block: int | None = None) -> DataFrame:
    """the feature dispatcher. Output columns: key, order, OHLCV, features, Target."""
    groups = active_groups(features, profile)
    df = bars
    # MACD first: its null-gap routing splits the plan in two, and only the bars sit below it.
    if "macd" in groups:
        df = add_macd(df, 12, 26, 9, key, order, ewm_block)
    if "r_1d" in groups:
        df = add_return_1d(df, key, order)
    if "lag" in groups and "Return_1d" in df.columns:
        df = add_lags(df, "Return_1d", LAGS, key, order)
    if "sma" in groups:
        df = add_sma(df, 5, 20, key, order)
    if "vix" in groups and "Return_1d" in df.columns:
        df = add_volatility(df, 20, "Return_1d", key, order)
    if "rsi" in groups:
        df = add_rsi(df, 14, key, order)
    if "boll" in groups:
        df = add_bollinger(df, 20, 2.0, key, order)
    if "obv" in groups:
        df = add_obv(df, key, order)
    if "range" in groups:
        df = add_intraday_range(df)
    if "gap" in groups:
        df = add_gap(df)
    df = add_target(df, horizon, threshold, key, order)
    # Reference column order: MACD columns sit between RSI and the Bollinger bands.
    cols = [c for c in df.columns if c not in ("MACD", "MACD_signal")]
    if "MACD" in df.columns:
        at = next((i for i, c in enumerate(cols) if c in ("BB_upper", "OBV", "HL_range", "CO_gap", "Target")), len(cols))
        cols = cols[:at] + ["MACD", "MACD_signal"] + cols[at:]
    df = df.select(*cols)
    if dropna:
        df = df.na.drop("any")
    return df


def zscore(c: str, w, window=100, min_periods=20, clip_z: float | None = 6.0):
    """rolling z-score, winsorised to +-clip_z (nulls stay null)."""
    mu = roll_mean(c, w, window, min_periods)
    sd = roll_std(c, w, window, min_periods)
    z = safe_div(F.col(c) - mu, sd)
    return clip(z, -clip_z, clip_z) if clip_z is not None else z


def add_interaction_features(df: DataFrame, clip_z: float | None = 6.0, key=KEY,
                             order=ORDER) -> DataFrame:
    """Each emitted only when its inputs exist. Windows restart on the given frame,
    so call it after the warm-up ``dropna`` (R9)."""
    cols = set(df.columns)
    has = lambda *cs: all(c in cols for c in cs)
    rsi = next((c for c in df.columns if c.upper().startswith("RSI_")), None)
    w = by_key(key, order)
    ret, vol = "Return_1d", "Volatility_20"
    lag1, lag2 = "Return_1d_lag1", "Return_1d_lag2"

    # Stage 1: inputs that are windows themselves.
    pre = {}
    if has("OBV", ret):
        pre["_obv_z"] = zscore("OBV", w, 100, 20, clip_z)
    if has("CO_gap", "Volume"):
        pre["_vol_ma20"] = roll_mean("Volume", w, 20, 5)
    if has("BB_width"):
        pre["_bbw_p"] = F.last("BB_width", ignorenulls=True).over(running(w))
    df = df.withColumns(pre) if pre else df

    out = {}
    if rsi and has("SMA_ratio"):
        out["trend_mom__sma_x_rsi"] = F.col("SMA_ratio") * F.col(rsi)
    if rsi and has("MACD"):
        out["mom_disagree__macd_minus_rsi"] = F.col("MACD") - F.col(rsi)
    if has(ret, vol):
        out["move_vs_vol__ret_over_vol"] = safe_div(F.col(ret), F.col(vol))
        out["vol_cond__ret_x_vol"] = F.col(ret) * F.col(vol)
    if has("BB_width", "SMA_ratio"):
        out["vol_trend__bbwidth_x_smaratio"] = F.col("BB_width") * F.col("SMA_ratio")
    if has("OBV", ret):
        out["flow_price__obvZ_x_return"] = F.col("_obv_z") * F.col(ret)
    if has("CO_gap", "Volume"):
        out["gap_flow__gap_x_volrel20"] = F.col("CO_gap") * safe_div(F.col("Volume"), F.col("_vol_ma20"))
    if has(lag1, lag2):
        out["lag_cross__r1_lag1_x_lag2"] = F.col(lag1) * F.col(lag2)
    if has(lag1, vol):
        out["lag_vol__r1_lag1_x_vol"] = F.col(lag1) * F.col(vol)
    if rsi:
        out["regime__rsi_lt30"] = flag_int(F.col(rsi) < 30)
        out["regime__rsi_gt70"] = flag_int(F.col(rsi) > 70)
    if has("Close", "SMA_20"):
        out["regime__above_sma20"] = flag_int(F.col("Close") > F.col("SMA_20"))
    if has("BB_width"):
        out["regime__bands_widening_1d"] = flag_int(ratio_change("_bbw_p", w) > 0)
    if has("MACD", lag1):
        out["mom_agree__sign_macd_eq_lag1"] = flag_int(F.signum("MACD") == F.signum(lag1))
    df = df.withColumns(out)
    return df.drop(*[c for c in ("_obv_z", "_vol_ma20", "_bbw_p") if c in df.columns])


def build_processed_panel(bars: DataFrame, features=None, horizon=5, threshold=0.01,
                          profile="reference", add_int_features=True, key=KEY, order=ORDER) -> DataFrame:
    """Pipeline stages 4-5: features + label, warm-up dropna, then interactions."""
    df = make_features(bars, features, horizon, threshold, profile, True, key, order)
    return add_interaction_features(df, key=key, order=order) if add_int_features else df
