"""Window helpers against pandas definitions (null semantics, blocked EMA)."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from panelspark.functions.windows import add_ewm, by_key, padded, ratio_change, roll_mean, roll_median, roll_std
from panelspark.sources import testbeds as tb
from tests.conftest import SF001


def _one_ticker(spark):
    bars = tb.calm_bars(spark, SF001)
    tk = bars.groupBy("ticker").count().orderBy(F.col("count").desc(), "ticker").first()["ticker"]
    return bars.filter(F.col("ticker") == tk)


@pytest.mark.parametrize("block", [None, 40, 200])
def test_blocked_ewm_matches_pandas(spark, block):
    df = _one_ticker(spark)
    out = add_ewm(df, [("Close", "e12", 12), ("Close", "e26", 26)], block=block)
    got = out.orderBy("Date").toPandas()
    ref = got["Close"].ewm(span=12, adjust=False).mean()
    ref26 = got["Close"].ewm(span=26, adjust=False).mean()
    assert np.allclose(got["e12"], ref, rtol=0, atol=1e-9)
    assert np.allclose(got["e26"], ref26, rtol=0, atol=1e-9)


def test_ewm_null_gaps_follow_pandas(spark):
    df = _one_ticker(spark)
    holes = df.withColumn("Close", F.when(F.dayofmonth("Date").isin(3, 4, 13), None).otherwise(F.col("Close")))
    out = add_ewm(holes, [("Close", "e9", 9)]).orderBy("Date").toPandas()
    ref = out["Close"].astype("float64").ewm(span=9, adjust=False).mean()
    assert np.allclose(out["e9"].astype("float64"), ref, atol=1e-9, equal_nan=True)


def test_rolling_and_pct_change_null_semantics(spark):
    vals = [1.0, None, 2.0, 4.0, None, None, 8.0, 3.0, 5.0, 7.0]
    pdf = pd.DataFrame({"ticker": "T", "Date": pd.date_range("2020-01-01", periods=len(vals)), "x": vals})
    df = spark.createDataFrame(pdf).withColumn("Date", F.col("Date").cast("timestamp_ntz"))
    w = by_key()
    df = df.withColumn("_p", padded("x", w))
    out = df.select("Date", "x", ratio_change("_p", w).alias("pc"), roll_mean("x", w, 3).alias("m3"),
                    roll_mean("x", w, 3, 2).alias("m3_2"), roll_std("x", w, 3, 2).alias("s3_2"),
                    roll_median("x", w, 4, 2).alias("med")).orderBy("Date").toPandas()
    s = pd.Series(vals, dtype="float64")
    exp_pc = s.ffill() / s.ffill().shift(1) - 1
    assert np.allclose(out["pc"].astype(float), exp_pc, equal_nan=True)
    assert np.allclose(out["m3"].astype(float), s.rolling(3).mean(), equal_nan=True)
    assert np.allclose(out["m3_2"].astype(float), s.rolling(3, min_periods=2).mean(), equal_nan=True)
    assert np.allclose(out["s3_2"].astype(float), s.rolling(3, min_periods=2).std(), equal_nan=True)
    assert np.allclose(out["med"].astype(float), s.rolling(4, min_periods=2).median(), equal_nan=True)
