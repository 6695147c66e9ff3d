"""Fold properties, metric definitions on hand fixtures, closed-form stratified split."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from panelspark.operators import features as fx
from panelspark.operators import folds as fo
from panelspark.operators import metrics as me
from panelspark.operators import search as se
from panelspark.sources import testbeds as tb
from tests.conftest import SF001


def test_fold_bounds_properties(spark):
    panel = fx.make_features(tb.calm_bars(spark, SF001)).checkpoint()
    b = fo.fold_bounds(panel, "2000-01-01", 5).toPandas()
    assert len(b) > 0
    for r in b.itertuples():
        assert r.train_lo <= r.train_hi < r.val_lo <= r.val_hi
        assert r.train_hi < r.val_lo - pd.Timedelta(days=5) or r.train_hi <= r.val_lo - pd.Timedelta(days=5)
        assert r.n_train >= 50 and r.n_val >= 5
        assert r.val_hi < pd.Timestamp("2000-01-01")
    # folds numbered 0..k-1 per ticker
    for _, g in b.groupby("ticker"):
        assert sorted(g["fold"]) == list(range(len(g)))
    trimmed = fo.trim_folds(fo.fold_bounds(panel, "2000-01-01", 5)).toPandas()
    counts = trimmed.groupby("ticker")["fold"].count()
    assert counts.nunique() == 1 and counts.iloc[0] == b.groupby("ticker")["fold"].count().min()


def test_calendar_alignment_shares_windows(spark):
    panel = fx.make_features(tb.calm_bars(spark, SF001)).checkpoint()
    b = fo.fold_bounds(panel, "2000-01-01", 5, align="calendar").toPandas()
    assert len(b) > 0
    # every validation range of one block index lies inside one common 365-day window
    starts = panel.filter(F.col("Date") < F.lit("2000-01-01").cast("timestamp_ntz")).agg(F.min("Date")).first()[0]
    for r in b.itertuples():
        k_lo = (r.val_lo - starts).days // 365
        k_hi = (r.val_hi - starts).days // 365
        assert k_lo == k_hi
    for r in b.itertuples():
        assert r.train_hi < r.val_lo and r.n_train >= 50 and r.n_val >= 5


def test_insample_has_unique_keys(spark):
    panel = fx.build_processed_panel(tb.calm_bars(spark, SF001)).checkpoint()
    b = fo.trim_folds(fo.fold_bounds(panel, "2000-01-01", 5))
    it = fo.global_insample_and_test(panel, b, "2000-01-01", 5, dropna=False)
    r = fo.panel_integrity(it.filter(F.col("role") == "insample")).first()
    assert r["n_dup_keys"] == 0 and r["n_rows"] == r["n_keys"]


def _ev(spark, y, s):
    pdf = pd.DataFrame({"Date": pd.date_range("2020-01-01", periods=len(y)), "ticker": "T", "y": y, "score": s})
    df = spark.createDataFrame(pdf).withColumn("Date", F.col("Date").cast("timestamp_ntz"))
    return me.build_eval_frame(df.withColumn("proba", me.sigmoid(F.col("score"))), "score", "proba", "y", True)


def test_auc_ap_hand_computed(spark):
    y = [0, 0, 1, 1, 1, 0, 1, 0]
    s = [0.1, 0.4, 0.35, 0.8, 0.4, 0.2, 0.9, 0.6]
    ev = _ev(spark, y, s)
    # Mann-Whitney with ties counted half
    pos = [v for v, t in zip(s, y) if t == 1]
    neg = [v for v, t in zip(s, y) if t == 0]
    exp_auc = sum((p > n) + 0.5 * (p == n) for p in pos for n in neg) / (len(pos) * len(neg))
    assert abs(me.roc_auc(ev).first()[0] - exp_auc) < 1e-12
    # AP = sum over distinct thresholds (desc) of delta recall * precision
    order = sorted(set(s), reverse=True)
    ap, P = 0.0, sum(y)
    for t in order:
        sel = [yy for vv, yy in zip(s, y) if vv >= t]
        here = sum(yy for vv, yy in zip(s, y) if vv == t)
        ap += here / P * (sum(sel) / len(sel))
    assert abs(me.average_precision(ev).first()[0] - ap) < 1e-12


def test_sweep_recall_non_increasing(spark):
    rng = np.random.default_rng(0)
    y = rng.integers(0, 2, 300).tolist()
    s = (rng.normal(size=300) + np.array(y)).round(3).tolist()
    sw = me.sweep_thresholds(_ev(spark, y, s)).orderBy("thr").toPandas()
    assert (np.diff(sw["recall"]) <= 1e-12).all()
    assert 0.0 in set(sw["thr"])


def _published_stratified(y, k):
    """The published StratifiedKFold(shuffle=False) assignment, written directly."""
    y = np.asarray(y)
    _, y_idx, y_inv = np.unique(y, return_index=True, return_inverse=True)
    _, class_perm = np.unique(y_idx, return_inverse=True)
    y_enc = class_perm[y_inv]
    n_classes = len(y_idx)
    y_order = np.sort(y_enc)
    alloc = np.asarray([np.bincount(y_order[i::k], minlength=n_classes) for i in range(k)])
    folds = np.empty(len(y), dtype=int)
    for c in range(n_classes):
        folds[y_enc == c] = np.arange(k).repeat(alloc[:, c])
    return folds


def test_stratified_closed_form(spark):
    rng = np.random.default_rng(1)
    for trial in range(4):
        n = int(rng.integers(20, 80))
        y = rng.integers(0, 2, n)
        pdf = pd.DataFrame({"__ticker__": ["A"] * n, "Date": pd.date_range("2020-01-01", periods=n), "Target": y})
        df = spark.createDataFrame(pdf).withColumn("Date", F.col("Date").cast("timestamp_ntz"))
        got = se.stratified_folds(df, 3).orderBy("Date").toPandas()["inner_fold"].tolist()
        assert got == _published_stratified(y, 3).tolist()


def test_no_folds_is_an_error(spark):
    some = spark.createDataFrame([("A", 0)], "ticker string, fold int")
    assert fo.require_folds(some) is some
    with pytest.raises(RuntimeError):
        fo.require_folds(some.where("fold > 0"))


def test_score_table_feeds_every_curve(spark, tmp_path):
    rnd = np.random.RandomState(5)
    score, y = rnd.randint(-6, 7, 400) / 4, rnd.randint(0, 2, 400)
    rows = [(f"2020-01-{1 + i % 28:02d}", f"T{i % 3}", int(b), float(a)) for i, (a, b) in enumerate(zip(score, y))]
    ev = me.build_eval_frame(spark.createDataFrame(rows, "Date string, ticker string, y int, score double").selectExpr("cast(Date as timestamp_ntz) Date", "ticker", "y", "score"),
                             proba_col=None)
    got = me.score_table(ev).orderBy("idx").collect()
    values = sorted(set(score), reverse=True)
    assert [r.score for r in got] == values and [r.idx for r in got] == list(range(1, len(values) + 1))
    for i, r in enumerate(got):
        assert (r.tps, r.fps, r.P, r.N) == ((y[score >= r.score] == 1).sum(), (y[score >= r.score] == 0).sum(), y.sum(), (1 - y).sum())
        after = (None, None) if i + 1 == len(values) else (got[i + 1].pos, got[i + 1].neg)
        assert (r.next_pos, r.next_neg) == after
    grid = me.sweep_grid(me.score_table(ev))
    assert grid == pytest.approx(sorted({*np.quantile(score, me.SWEEP_QUANTILES).tolist(), 0.0}))
    frames = me.full_evaluation(ev, str(tmp_path))
    assert set(frames) == {"predictions", "stats", "sweep", "roc_curve", "pr_curve", "confusion", "class_report", "gains", "ap_by_ticker", "rolling_accuracy"}
    assert frames["sweep"].count() == len(grid) and (tmp_path / "final_test_predictions.csv").exists()
    stats, pairs = frames["stats"].first(), (score[y == 1][:, None] - score[y == 0][None, :])
    assert stats.roc_auc == pytest.approx(((pairs > 0) + 0.5 * (pairs == 0)).mean())
    at = {(r.thr_name, r.y, r.pred): r.n for r in frames["confusion"].collect()}
    assert at["youden", 1, 1] == ((score >= stats.best_youden_thr) & (y == 1)).sum() and at["thr0", 0, 1] == ((score >= 0) & (y == 0)).sum()
    assert me.full_evaluation(ev.limit(0))["roc_curve"].count() == 1


def test_sweep_grid_leaves_out_null_and_nan(spark):
    v = [float("nan"), None, 3.0, 1.0, 2.0, 2.0, float("nan")]
    ev = spark.createDataFrame([(x, i % 2) for i, x in enumerate(v)], "score double, y int")
    assert me.sweep_grid(me.score_table(ev)) == pytest.approx(sorted({*np.quantile([3, 1, 2, 2], me.SWEEP_QUANTILES).tolist(), 0.0}))
    assert me.sweep_grid(me.score_table(ev.limit(0))) == [0.0]
