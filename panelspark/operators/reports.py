"""Notebook-level queries (N1-N9): baselines, sweep summaries, panel info."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelspark.functions.ordered import row_numbers
from panelspark.functions.windows import by_key
from panelspark.operators import metrics as me

LABEL = "Target"


def naive_persistence(df: DataFrame, lag: int = 5, mode: str = "per_ticker", key: str = "ticker",
                      order: str = "Date") -> DataFrame:
    """prediction = label ``lag`` rows earlier; rows without one are dropped.

    ``per_ticker`` shifts inside each ticker. ``global`` reproduces the reference, which
    shifts the concatenated panel (tickers in order), so a ticker's first rows take the
    previous ticker's last labels: rows get a global number and are joined to number - lag."""
    if mode == "per_ticker":
        out = df.withColumn("NaivePred", F.lag(LABEL, lag).over(by_key(key, order)))
    else:
        rn = row_numbers(df.select(key, order, LABEL), [(key, False), (order, False)], "_rn")
        prev = rn.select((F.col("_rn") + lag).alias("_rn"), F.col(LABEL).alias("NaivePred"))
        out = df.join(rn.select(key, order, "_rn"), [key, order]).join(prev, "_rn", "left").drop("_rn")
    return out.filter(F.col("NaivePred").isNotNull())


def label_report(df: DataFrame, pred_col: str, y_col: str = LABEL) -> DataFrame:
    """E6 as used by N1/N2: accuracy, AUC of hard labels, confusion counts."""
    return me.label_metrics(df, y_col, pred_col)


def dummy_baseline(df: DataFrame, train_cutoff: str, order: str = "Date") -> DataFrame:
    """train/test split at a cut-off, majority class of train predicted on test."""
    cut = F.lit(train_cutoff).cast("timestamp_ntz")
    is_train = F.coalesce(F.col(order) < cut, F.lit(False))
    train, test = df.filter(is_train), df.filter(~is_train)
    maj = (train.groupBy(LABEL).agg(F.count(F.lit(1)).alias("n"))
           .agg(F.max_by(LABEL, F.struct(F.col("n"), -F.col(LABEL))).alias("m")).select("m").scalar())
    return test.withColumn("DummyPred", F.coalesce(maj, F.lit(0)).cast("int"))


def sweep_curves(inner: DataFrame, param: str = "param", metric: str = "metric") -> DataFrame:
    """N3 + N4 in one pass: mean inner metric by (outer fold, param) and by param
    (``outer_fold`` null on the overall rows)."""
    fold, value = F.col("outer_fold"), F.col(param)
    return inner.groupingSets([[fold, value], [value]], fold, value).agg(F.avg(metric).alias(f"mean_{metric}"))


def param_box(outer: DataFrame, param: str = "param") -> DataFrame:
    """Box statistics of the chosen parameter (quartiles, 1.5 IQR whiskers)."""
    q = outer.agg(F.percentile(param, F.array(*[F.lit(p) for p in (0.0, 0.25, 0.5, 0.75, 1.0)])).alias("q"))
    iqr = F.col("q")[3] - F.col("q")[1]
    return q.select(F.col("q")[0].alias("min"), F.col("q")[1].alias("q1"), F.col("q")[2].alias("median"),
                    F.col("q")[3].alias("q3"), F.col("q")[4].alias("max"),
                    (F.col("q")[1] - 1.5 * iqr).alias("whisker_lo"), (F.col("q")[3] + 1.5 * iqr).alias("whisker_hi"))


def box_rows(box: DataFrame) -> DataFrame:
    """The statistics of ``param_box`` one a row: ``report, key, x, y`` with the name as key."""
    names = ["min", "q1", "median", "q3", "max", "whisker_lo", "whisker_hi"]
    pairs = F.explode(F.array(*[F.struct(F.lit(n).alias("key"), F.col(n).alias("x")) for n in names])).alias("s")
    return box.select(pairs).select(F.lit("box").alias("report"), "s.key", "s.x", F.lit(None).cast("double").alias("y"))


def fold_series(outer: DataFrame) -> DataFrame:
    """Per-outer-fold validation AUC and accuracy, by fold."""
    return outer.select("fold", "val_auc", "val_accuracy").orderBy("fold")


def rename_results(inner: DataFrame, outer: DataFrame, param_name: str, metric_name: str = "auc"):
    """The reference's renames (param -> C/alpha, metric -> auc) and the median parameter."""
    i = inner.withColumnsRenamed({"param": param_name, "metric": metric_name})
    o = outer.withColumnsRenamed({"param": param_name, "inner_mean_metric": f"inner_mean_{metric_name}"})
    med = o.agg(F.median(param_name).alias(f"final_{param_name}"))
    return i, o.orderBy("fold"), med


def log_grid(lo_exp: float, hi_exp: float, n: int) -> list[float]:
    """``n`` log-spaced values from 10**lo_exp to 10**hi_exp (e.g. -4..0 by 15)."""
    if n == 1:
        return [10.0 ** lo_exp]
    return [10.0 ** (lo_exp + (hi_exp - lo_exp) * i / (n - 1)) for i in range(n)]


def panel_info(df: DataFrame) -> DataFrame:
    """One row per column: non-null count and type, plus the total row count."""
    n = F.count(F.lit(1))
    agg = df.agg(n.alias("__rows"), *[F.count(F.col(f"`{c}`")).alias(f"nn_{i}") for i, c in enumerate(df.columns)])
    types = dict(df.dtypes)
    arr = F.array(*[F.struct(F.lit(c).alias("column"), F.lit(types[c]).alias("dtype"),
                             F.col(f"nn_{i}").alias("non_null"), F.col("__rows").alias("rows"))
                    for i, c in enumerate(df.columns)])
    return agg.select(F.explode(arr).alias("r")).select("r.*")
