"""Evaluation operators (E1-E15): the data behind every report of the reference.

Input is an evaluation frame ``(Date, ticker, y, score, proba, "pred@0", score_is_margin)``.
All that depends on a global score order (ROC, PR, AP, the sweep and its quantile grid) reads one
``score_table``: a row per distinct score (a hash aggregate with map-side combine) with running sums,
totals and the following score's counts, from one range shuffle of ``functions.ordered``. Per-ticker
variants use plain windows partitioned by ticker. Sweeps bin the scores into the (<= 100-value) grid
and take cumulative counts over the grid.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from panelspark.functions.ordered import exact_quantiles_multi, rolling_mean_global, row_numbers, running_sums
from panelspark.session import materialize
from panelspark.sources.files import write_table_csv

# Fixed values of the reference: sigmoid clip, quantile grid, bins, gains epsilon.
SIGMOID_CLIP = 50.0
SWEEP_QUANTILES = [round(0.01 * k, 2) for k in range(1, 100)]
CALIBRATION_BINS = 10
GAINS_EPS = 1e-9
ROLLING_WINDOW = 50


def sigmoid(c: Column) -> Column:
    """1 / (1 + exp(-x)) with x clipped to +-50."""
    x = F.least(F.greatest(c, F.lit(-SIGMOID_CLIP)), F.lit(SIGMOID_CLIP))
    return F.lit(1.0) / (F.lit(1.0) + F.exp(-x))


def scores_and_proba(margin: Column | None, own: Column | None, strategy: str = "auto") -> tuple[Column, Column]:
    """(score, probability of class 1) of a model that has a margin, a probability of its own, or both.

    The score is the margin, else the own probability. ``auto``: own probability, else the margin's
    sigmoid; ``model``: own probability, else null; ``sigmoid``: the margin's sigmoid, else null;
    ``none``: null."""
    if margin is None and own is None:
        raise ValueError("a model needs a margin or a probability")
    null = F.lit(None).cast("double")
    squashed = null if margin is None else sigmoid(margin)
    choices = {"auto": squashed if own is None else own, "model": null if own is None else own, "sigmoid": squashed, "none": null}
    if strategy not in choices:
        raise ValueError(f"strategy is one of {sorted(choices)}")
    return (own if margin is None else margin), choices[strategy]


def build_eval_frame(df: DataFrame, score_col: str = "score", proba_col: str | None = "proba",
                     y_col: str = "y", score_is_margin: bool = True, date_col: str | None = "Date",
                     ticker_col: str | None = "ticker") -> DataFrame:
    """Evaluation frame; default threshold 0 for margins, 0.5 for probabilities."""
    thr = 0.0 if score_is_margin else 0.5
    score = F.col(score_col).cast("double") + F.lit(0.0)  # fold -0.0 into 0.0 (R11)
    return df.select(
        (F.col(date_col) if date_col else F.lit(None).cast("timestamp_ntz")).alias("Date"),
        (F.col(ticker_col) if ticker_col else F.lit("ALL")).alias("ticker"),
        F.col(y_col).cast("int").alias("y"),
        score.alias("score"),
        (F.col(proba_col).cast("double") if proba_col else F.lit(None).cast("double")).alias("proba"),
        (score >= F.lit(thr)).cast("int").alias("pred@0"),
        F.lit(score_is_margin).alias("score_is_margin"))


# ------------------------------------------------------------------ per-score table

def score_counts(ev: DataFrame, by: list[str] | None = None, score_col: str = "score",
                 y_col: str = "y") -> DataFrame:
    """One row per distinct (by.., score) with positive and negative counts."""
    by = by or []
    return ev.groupBy(*by, score_col).agg(
        F.count_if(F.col(y_col) == 1).alias("pos"), F.count_if(F.col(y_col) != 1).alias("neg"))


def score_table(ev: DataFrame, score_col: str = "score", y_col: str = "y") -> DataFrame:
    """One row per distinct score, best first: ``score, pos, neg, tps, fps, idx, next_pos, next_neg, P, N``.

    tps/fps count the rows with this score or more, idx numbers the scores, next_* are the counts at the
    score that follows. One range shuffle gives all of it; AUC, AP, both curves, the sweep's grid and the
    sweep itself are scans of this table (``materialize`` it for several of them)."""
    sc = score_counts(ev, None, score_col, y_col).withColumnRenamed(score_col, "score").withColumn("_one", F.lit(1))
    out = running_sums(sc, "score", ["pos", "neg", "_one"], descending=True, leads=["pos", "neg"], totals_as={"pos": "P", "neg": "N"})
    return out.withColumnsRenamed({"cum_pos": "tps", "cum_neg": "fps", "cum__one": "idx"}).drop("_one")


def _cumulative(sc: DataFrame, by: list[str], score_col: str = "score", scan: str = "window") -> DataFrame:
    """tps/fps = positives/negatives with score >= this score (descending scan), per group of ``by``.

    ``scan="window"``: many bounded groups (tickers) -> a window per group. ``"bucketed"``: few
    large groups -> bucketed running sums per group, no group lands in one task."""
    if scan == "bucketed":
        out = running_sums(sc, score_col, ["pos", "neg"], descending=True, by=by, totals_as={"pos": "P", "neg": "N"})
        return out.withColumnsRenamed({"cum_pos": "tps", "cum_neg": "fps"})
    w = Window.partitionBy(*by).orderBy(F.col(score_col).desc()).rowsBetween(Window.unboundedPreceding, 0)
    tot = Window.partitionBy(*by)
    return sc.withColumns({"tps": F.sum("pos").over(w), "fps": F.sum("neg").over(w), "P": F.sum("pos").over(tot), "N": F.sum("neg").over(tot)})


def _auc() -> Column:
    term = F.col("neg") * (F.col("tps") - F.col("pos") + F.col("pos") / F.lit(2.0))
    return F.try_divide(F.sum(term), F.first("P") * F.first("N")).alias("roc_auc")


def _ap() -> Column:
    prec = F.col("tps") / (F.col("tps") + F.col("fps"))
    return F.coalesce(F.try_divide(F.sum(F.col("pos") * prec), F.first("P")), F.lit(0.0)).alias("average_precision")


def _by_score(ev: DataFrame, by: list[str], score_col: str, y_col: str, scan: str) -> DataFrame:
    return _cumulative(score_counts(ev, by, score_col, y_col), by, score_col, scan) if by else score_table(ev, score_col, y_col)


def roc_auc(ev: DataFrame, by: list[str] | None = None, score_col: str = "score", y_col: str = "y",
            scan: str = "window") -> DataFrame:
    """E5: trapezoidal AUC with tied scores grouped: sum(neg * (tps_before + pos/2)) / (P N)."""
    by = by or []
    return _by_score(ev, by, score_col, y_col, scan).groupBy(*by).agg(_auc())


def average_precision(ev: DataFrame, by: list[str] | None = None, score_col: str = "score",
                      y_col: str = "y", scan: str = "window") -> DataFrame:
    """AP = sum over distinct scores (desc) of (pos/P) * precision; 0 without positives."""
    by = by or []
    return _by_score(ev, by, score_col, y_col, scan).groupBy(*by).agg(_ap())


def roc_curve(ev: DataFrame | None, drop_intermediate: bool = True, score_col: str = "score",
              y_col: str = "y", table: DataFrame | None = None) -> DataFrame:
    """E5 curve: (point, fpr, tpr, threshold), origin first with a null threshold.

    ``drop_intermediate`` drops collinear points like the reference's library default: those whose
    steps to them and from them are the same. ``table``: the score table, where it is at hand."""
    pts = score_table(ev, score_col, y_col) if table is None else table
    if drop_intermediate:
        same_step = (F.col("pos") == F.col("next_pos")) & (F.col("neg") == F.col("next_neg"))
        pts = pts.filter((F.col("idx") == 1) | ~F.coalesce(same_step, F.lit(False)))
    curve = pts.select(F.col("idx").cast("bigint").alias("point"),
                       F.try_divide(F.col("fps"), F.col("N")).alias("fpr"),
                       F.try_divide(F.col("tps"), F.col("P")).alias("tpr"), F.col("score").alias("threshold"))
    origin = curve.sparkSession.range(1).select(
        F.lit(0).cast("bigint").alias("point"), F.lit(0.0).alias("fpr"), F.lit(0.0).alias("tpr"),
        F.lit(None).cast("double").alias("threshold"))
    return origin.unionByName(curve)


def pr_curve(ev: DataFrame | None, score_col: str = "score", y_col: str = "y", table: DataFrame | None = None) -> DataFrame:
    """E7 curve: per distinct threshold precision and recall, plus the end point (1, 0)."""
    cum = score_table(ev, score_col, y_col) if table is None else table
    prec = F.coalesce(F.try_divide(F.col("tps"), F.col("tps") + F.col("fps")), F.lit(0.0))
    rec = F.when(F.col("P") == 0, F.lit(1.0)).otherwise(F.col("tps") / F.col("P"))
    curve = cum.select(F.col("score").alias("threshold"), prec.alias("precision"), rec.alias("recall"))
    end = curve.sparkSession.range(1).select(
        F.lit(None).cast("double").alias("threshold"), F.lit(1.0).alias("precision"), F.lit(0.0).alias("recall"))
    return curve.unionByName(end)


# ------------------------------------------------------------------ threshold sweep

def sweep_grid(table: DataFrame) -> list[float]:
    """Grid = 99 linear quantiles of the scores plus 0.0, distinct and sorted (<= 100 values,
    a bounded fitted parameter), from a score table: a score fills the places its count gives it."""
    known = F.col("score").isNotNull() & ~F.isnan("score")
    size = F.col("pos") + F.col("neg")
    n, above = table.agg(F.sum(F.when(known, size)), F.sum(F.when(F.isnan("score"), size))).first()
    if not n:
        return [0.0]
    places = {q: (n - 1) * q for q in SWEEP_QUANTILES}
    need = sorted({int(f(p)) for p in places.values() for f in (math.floor, math.ceil)})
    last = F.lit(int(n + (above or 0))) - (F.col("tps") + F.col("fps"))  # places before this score, from the least up
    held = F.filter(F.array(*[F.lit(r).cast("bigint") for r in need]), lambda r: (r >= last) & (r < last + size))
    at = {int(row[1]): float(row[0]) for row in table.filter(known).select("score", F.explode(held)).collect()}  # at most 198 places
    values = {at[math.floor(p)] + (at[math.ceil(p)] - at[math.floor(p)]) * (p - math.floor(p)) for p in places.values()}
    return sorted(values | {0.0})


def sweep_thresholds(ev: DataFrame | None, grid: list[float] | None = None, score_col: str = "score",
                     y_col: str = "y", table: DataFrame | None = None) -> DataFrame:
    """Per threshold acc, f1, precision, recall, fpr, youden (0 where undefined)."""
    table = materialize(score_table(ev, score_col, y_col)) if table is None else table
    spark = table.sparkSession
    grid = sorted(set(grid)) if grid is not None else sweep_grid(table)
    # bucket b = number of grid values <= score; score >= grid[j] <=> b >= j + 1 (0-based j)
    arr = F.array(*[F.lit(float(g)) for g in grid])
    bucket = F.size(F.filter(arr, lambda g: g <= F.col("score")))
    counts = table.groupBy(bucket.alias("b")).agg(F.sum("pos").alias("pos"), F.sum("neg").alias("neg"))
    P = counts.select(F.sum("pos")).scalar()
    N = counts.select(F.sum("neg")).scalar()
    # The grid and the bucket counts both hold at most len(grid) + 1 rows.
    thr = spark.createDataFrame([(j + 1, float(g)) for j, g in enumerate(grid)], "b int, thr double")
    j = thr.join(F.broadcast(counts), "b", "left").fillna(0, subset=["pos", "neg"])
    w = Window.orderBy(F.col("b").desc()).rowsBetween(Window.unboundedPreceding, 0)
    tp = F.sum("pos").over(w)
    fp = F.sum("neg").over(w)
    m = j.select("thr", tp.alias("tp"), fp.alias("fp"))
    tp, fp = F.col("tp"), F.col("fp")
    fn, tn = P - tp, N - fp
    z = F.lit(0.0)
    tpr = F.when(tp + fn > 0, tp / (tp + fn)).otherwise(z)
    fpr = F.when(fp + tn > 0, fp / (fp + tn)).otherwise(z)
    prec = F.when(tp + fp > 0, tp / (tp + fp)).otherwise(z)
    acc = (tp + tn) / (P + N)
    f1 = F.when(2 * tp + fp + fn > 0, 2 * tp / (2 * tp + fp + fn)).otherwise(z)
    return m.select("thr", acc.alias("acc"), f1.alias("f1"), prec.alias("precision"), tpr.alias("recall"),
                    fpr.alias("fpr"), (tpr - fpr).alias("youden"))


def best_thresholds(sweep: DataFrame) -> DataFrame:
    """Threshold of the first maximum (lowest threshold among ties) of Youden and F1."""
    return sweep.agg(F.max_by("thr", F.struct(F.col("youden"), -F.col("thr"))).alias("best_youden_thr"),
                     F.max_by("thr", F.struct(F.col("f1"), -F.col("thr"))).alias("best_f1_thr"))


# ------------------------------------------------------------------ labels at a threshold

def confusion(ev: DataFrame, thr, score_col: str = "score", y_col: str = "y") -> DataFrame:
    """2x2 counts (y, pred) at a threshold (a number or a Column), zeros included."""
    t = thr if isinstance(thr, Column) else F.lit(float(thr))
    pred = (F.col(score_col) >= t).cast("int")
    agg = ev.agg(*[F.count_if((F.col(y_col) == a) & (pred == b)).alias(f"c{a}{b}") for a in (0, 1) for b in (0, 1)])
    return agg.select(F.explode(F.array(*[F.struct(F.lit(a).alias("y"), F.lit(b).alias("pred"),
                                                   F.col(f"c{a}{b}").alias("n"))
                                          for a in (0, 1) for b in (0, 1)])).alias("c")).select("c.*")


def class_report(ev: DataFrame, thr, score_col: str = "score", y_col: str = "y",
                 pred_col: str | None = None) -> DataFrame:
    """Precision, recall, f1, support per class; accuracy, macro and weighted averages."""
    if pred_col is None:
        t = thr if isinstance(thr, Column) else F.lit(float(thr))
        pred = (F.col(score_col) >= t).cast("int")
    else:
        pred = F.col(pred_col).cast("int")
    y = F.col(y_col)
    a = ev.agg(F.count_if((y == 1) & (pred == 1)).alias("tp"), F.count_if((y == 0) & (pred == 1)).alias("fp"),
               F.count_if((y == 1) & (pred == 0)).alias("fn"), F.count_if((y == 0) & (pred == 0)).alias("tn"))
    z = F.lit(0.0)

    def cls(tp, fp, fn, label):
        p = F.when(tp + fp > 0, tp / (tp + fp)).otherwise(z)
        r = F.when(tp + fn > 0, tp / (tp + fn)).otherwise(z)
        f = F.when(p + r > 0, 2 * p * r / (p + r)).otherwise(z)
        return p, r, f, (tp + fn)

    tp, fp, fn, tn = F.col("tp"), F.col("fp"), F.col("fn"), F.col("tn")
    p1, r1, f1, s1 = cls(tp, fp, fn, "1")
    p0, r0, f0, s0 = cls(tn, fn, fp, "0")
    n = s0 + s1
    rows = [
        ("0", p0, r0, f0, s0), ("1", p1, r1, f1, s1),
        ("accuracy", F.lit(None).cast("double"), F.lit(None).cast("double"), (tp + tn) / n, n),
        ("macro avg", (p0 + p1) / 2, (r0 + r1) / 2, (f0 + f1) / 2, n),
        ("weighted avg", (p0 * s0 + p1 * s1) / n, (r0 * s0 + r1 * s1) / n, (f0 * s0 + f1 * s1) / n, n),
    ]
    arr = F.array(*[F.struct(F.lit(lbl).alias("label"), p.cast("double").alias("precision"),
                             r.cast("double").alias("recall"), f.cast("double").alias("f1"),
                             s.cast("bigint").alias("support")) for lbl, p, r, f, s in rows])
    return a.select(F.explode(arr).alias("r")).select("r.*")


def label_metrics(df: DataFrame, y_col: str, pred_col: str) -> DataFrame:
    """Accuracy, AUC of hard labels (= (1 + tpr - fpr) / 2) and the confusion counts."""
    y, p = F.col(y_col), F.col(pred_col)
    a = df.agg(F.count_if((y == 1) & (p == 1)).alias("tp"), F.count_if((y == 0) & (p == 1)).alias("fp"),
               F.count_if((y == 1) & (p == 0)).alias("fn"), F.count_if((y == 0) & (p == 0)).alias("tn"))
    tp, fp, fn, tn = F.col("tp"), F.col("fp"), F.col("fn"), F.col("tn")
    tpr = F.try_divide(tp, tp + fn)
    fpr = F.try_divide(fp, fp + tn)
    return a.select(((tp + tn) / (tp + fp + fn + tn)).alias("accuracy"),
                    ((F.lit(1.0) + tpr - fpr) / 2).alias("roc_auc"), "tp", "fp", "fn", "tn")


# ------------------------------------------------------------------ calibration, brier

def calibration(ev: DataFrame, n_bins: int = CALIBRATION_BINS, proba_col: str = "proba",
                y_col: str = "y") -> DataFrame:
    """Quantile bins of the probability; bin = number of inner edges strictly below p.
    Empty bins do not appear. Returns nothing when no probabilities exist."""
    probs = [i / n_bins for i in range(n_bins + 1)]
    valid = ev.filter(F.col(proba_col).isNotNull() & ~F.isnan(proba_col))
    e = exact_quantiles_multi(valid, [proba_col], probs)[proba_col]
    if e[0] is None:
        return ev.sparkSession.createDataFrame([], "bin int, mean_predicted double, fraction_positive double, count bigint")
    inner = F.array(*[F.lit(float(v)) for v in e[1:-1]])
    b = F.size(F.filter(inner, lambda x: x < F.col(proba_col)))
    return (valid.groupBy(b.alias("bin"))
            .agg(F.avg(proba_col).alias("mean_predicted"), F.avg(F.col(y_col).cast("double")).alias("fraction_positive"),
                 F.count(F.lit(1)).alias("count")))


def brier(ev: DataFrame, proba_col: str = "proba", y_col: str = "y") -> DataFrame:
    """Mean squared difference of probability and label."""
    return ev.agg(F.avg(F.pow(F.col(proba_col) - F.col(y_col), 2)).alias("brier"))


# ------------------------------------------------------------------ gains, per ticker, rolling

def gains(ev: DataFrame, proba_col: str = "proba", score_col: str = "score", y_col: str = "y") -> DataFrame:
    """Rows by probability (score if none) descending, ties by (Date, ticker); share of
    rows vs share of positives captured."""
    has_p = ev.filter(F.col(proba_col).isNotNull() & ~F.isnan(proba_col)).limit(1).count() > 0
    key = proba_col if has_p else score_col
    base = ev.select("Date", "ticker", F.col(y_col).cast("bigint").alias("_pos"), F.col(key).alias("_k"))
    ranked = row_numbers(base, [("_k", True), ("Date", False), ("ticker", False)], "rank", sum_cols=["_pos"])
    n = ev.select(F.count(F.lit(1))).scalar()
    p = ev.select(F.sum(F.col(y_col))).scalar()
    return ranked.select("Date", "ticker", "rank", (F.col("rank") / n).alias("pct"),
                         (F.col("cum__pos") / (p + F.lit(GAINS_EPS))).alias("captured"))


def ap_by_ticker(ev: DataFrame) -> DataFrame:
    """Average precision per ticker, best first."""
    return average_precision(ev, ["ticker"]).orderBy(F.col("average_precision").desc(), "ticker")


def rolling_accuracy(ev: DataFrame, window: int = ROLLING_WINDOW, pred_col: str = "pred@0",
                     y_col: str = "y") -> DataFrame:
    """Accuracy over the last ``window`` rows in (Date, ticker) order."""
    ok = ev.select("Date", "ticker", (F.col(f"`{pred_col}`") == F.col(y_col)).cast("double").alias("_ok"))
    ranked = row_numbers(ok, [("Date", False), ("ticker", False)], "rn")
    out = rolling_mean_global(ranked, "rn", "_ok", window, "rolling_accuracy")
    return out.select("Date", "ticker", "rolling_accuracy")


def auc_and_ap(ev: DataFrame | None, score_col: str = "score", y_col: str = "y", table: DataFrame | None = None) -> DataFrame:
    """E5 + E7 from one score table: one row with roc_auc and average_precision."""
    return (score_table(ev, score_col, y_col) if table is None else table).agg(_auc(), _ap())


def full_stats(ev: DataFrame | None, table: DataFrame | None = None, sweep: DataFrame | None = None) -> DataFrame:
    """E15's stats: one row with roc_auc, average_precision, best_youden_thr, best_f1_thr."""
    table = materialize(score_table(ev)) if table is None else table
    best = best_thresholds(sweep_thresholds(ev, table=table) if sweep is None else sweep)
    return auc_and_ap(ev, table=table).select(
        "roc_auc", "average_precision",
        best.select("best_youden_thr").scalar().alias("best_youden_thr"),
        best.select("best_f1_thr").scalar().alias("best_f1_thr"))


def full_evaluation(ev: DataFrame, out_dir: str | None = None, predictions_name: str = "final_test_predictions.csv",
                    rolling_window: int = ROLLING_WINDOW) -> dict[str, DataFrame]:
    """Every frame of the evaluation by name, all score curves from one written score table.

    ``stats`` (one row), ``sweep``, ``roc_curve``, ``pr_curve``, ``calibration``, ``confusion`` and
    ``class_report`` (at threshold 0 and at the best Youden threshold: ``thr_name, thr``), ``gains``,
    ``ap_by_ticker``, ``rolling_accuracy`` and ``predictions`` (the evaluation frame). With ``out_dir`` the
    predictions are written there as CSV. ``calibration`` is missing where no row has a probability."""
    ev = materialize(ev)
    table = materialize(score_table(ev))
    sweep = materialize(sweep_thresholds(ev, table=table))
    stats = materialize(full_stats(ev, table=table, sweep=sweep))
    cuts = {"thr0": 0.0, "youden": stats.first()["best_youden_thr"]}

    def at_cuts(report) -> DataFrame:
        parts = [report(ev, thr).withColumns({"thr_name": F.lit(name), "thr": F.lit(float(thr))}) for name, thr in cuts.items()]
        return parts[0].unionByName(parts[1])

    out = {"predictions": ev, "stats": stats, "sweep": sweep, "roc_curve": roc_curve(ev, table=table), "pr_curve": pr_curve(ev, table=table),
           "confusion": at_cuts(confusion), "class_report": at_cuts(class_report), "gains": gains(ev),
           "ap_by_ticker": ap_by_ticker(ev), "rolling_accuracy": rolling_accuracy(ev, rolling_window)}
    if not ev.filter(F.col("proba").isNotNull() & ~F.isnan("proba")).isEmpty():
        out["calibration"] = calibration(ev)
    if out_dir is not None:
        write_table_csv(ev, f"{out_dir.rstrip('/')}/{predictions_name}")
    return out
