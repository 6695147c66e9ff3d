"""Feature stack on one ticker against a pandas re-statement of the definitions."""

import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from panelspark.operators import cleaning as cl
from panelspark.operators import features as fx
from panelspark.sources import testbeds as tb
from tests.conftest import SF001


def pandas_features(d: pd.DataFrame) -> pd.DataFrame:
    out = d.copy()
    c = out["Close"]
    out["Return_1d"] = c.ffill() / c.ffill().shift(1) - 1
    out["SMA_5"] = c.rolling(5).mean()
    out["SMA_20"] = c.rolling(20).mean()
    out["SMA_ratio"] = out["SMA_5"] / out["SMA_20"]
    delta = c.diff()
    ag = delta.clip(lower=0).rolling(14).mean()
    al = (-delta.clip(upper=0)).rolling(14).mean()
    out["RSI_14"] = 100 - 100 / (1 + ag / al.replace(0, np.nan))
    macd = c.ewm(span=12, adjust=False).mean() - c.ewm(span=26, adjust=False).mean()
    out["MACD"] = macd
    out["MACD_signal"] = macd.ewm(span=9, adjust=False).mean()
    ma, sd = c.rolling(20).mean(), c.rolling(20).std()
    out["BB_upper"], out["BB_lower"] = ma + 2 * sd, ma - 2 * sd
    out["BB_width"] = (out["BB_upper"] - out["BB_lower"]) / ma.replace(0, np.nan)
    out["HL_range"] = (out["High"] - out["Low"]) / c.replace(0, np.nan)
    out["CO_gap"] = (c - out["Open"]) / out["Open"].replace(0, np.nan)
    fwd = pd.concat([c.shift(-k) / c - 1 for k in range(1, 6)], axis=1).max(axis=1)
    out["Target"] = (fwd > 0.01).astype(int)
    return out.dropna()


def test_reference_profile_matches_pandas(spark):
    bars = tb.calm_bars(spark, SF001)
    tk = bars.groupBy("ticker").count().orderBy(F.col("count").desc(), "ticker").first()["ticker"]
    one = bars.filter(F.col("ticker") == tk)
    got = fx.make_features(one).orderBy("Date").toPandas().reset_index(drop=True)
    raw = one.orderBy("Date").toPandas()
    exp = pandas_features(raw).reset_index(drop=True)
    assert list(got.columns[2:]) == ["Open", "High", "Low", "Close", "Volume", "Return_1d", "SMA_5", "SMA_20",
                                     "SMA_ratio", "RSI_14", "MACD", "MACD_signal", "BB_upper", "BB_lower",
                                     "BB_width", "HL_range", "CO_gap", "Target"]
    assert len(got) == len(exp)
    for c in exp.columns:
        if c in ("ticker", "Date"):
            continue
        assert np.allclose(got[c].astype(float), exp[c].astype(float), atol=1e-9), c


def test_warmup_drop_is_19_rows_per_ticker(spark):
    bars = tb.calm_bars(spark, SF001)
    n_bars = bars.groupBy("ticker").count()
    n_feat = fx.make_features(bars).groupBy("ticker").count().withColumnRenamed("count", "f")
    diff = n_bars.join(n_feat, "ticker").select((F.col("count") - F.col("f")).alias("d")).distinct().collect()
    assert {r["d"] for r in diff} == {19}


def test_interactions_restart_after_dropna(spark):
    bars = tb.calm_bars(spark, SF001)
    p = fx.build_processed_panel(bars)
    first = p.groupBy("ticker").agg(F.min("Date").alias("Date"))
    gf = p.join(first, ["ticker", "Date"]).select("gap_flow__gap_x_volrel20").collect()
    # the 20-row volume mean needs 5 rows of the trimmed frame, so the first row is null
    assert all(r[0] is None for r in gf)


def test_drift_fixture_fires_sigma_rule(spark):
    # With the current return inside its own sigma, only drifting series can fire.
    # 40 closes with returns alternating 0.9% / 1.1%, then one 8% jump.
    closes = [100.0]
    for i in range(39):
        closes.append(closes[-1] * (1.009 if i % 2 == 0 else 1.011))
    closes.append(closes[-1] * 1.08)
    pdf = pd.DataFrame({"ticker": "D", "Date": pd.date_range("2020-01-01", periods=len(closes)),
                        "Open": closes, "High": closes, "Low": closes, "Close": closes, "Volume": 100.0})
    df = spark.createDataFrame(pdf).withColumn("Date", F.col("Date").cast("timestamp_ntz"))
    flags = cl.outlier_flags(df, None).orderBy("Date").toPandas()
    ret = pd.Series(closes).pct_change()
    sig = ret.rolling(20, min_periods=10).std()
    exp = ((ret.abs() > 0.5) | ((sig > 0) & (ret.abs() > 5 * sig))).fillna(False)
    assert list(flags["candidate"]) == list(exp)
    assert flags["candidate"].sum() >= 1
