"""Registered queries: preprocessing, splits, baselines, models, search, reports, inspection.

Exact parts (medians, scaling, one-hot categories, stratified split, baselines, panel info)
have DuckDB oracles. Fitted models (Spark ML solvers) are registered without one; the driver
checks rows only. Iterations, trees, repeats and draws are the operators' defaults, which are the
reference's.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from panelspark.operators import features as fx
from panelspark.operators import folds as fo
from panelspark.operators import inspect as ins
from panelspark.operators import margin_sweep as ms
from panelspark.operators import metrics as me
from panelspark.operators import models as mo
from panelspark.operators import reports as rp
from panelspark.operators import search as se
from panelspark.plans import oracle_sql as osql
from panelspark.plans.queries_core import R6, r
from panelspark.plans.queries_folds import H, TRAIN_CUTOFF, VALIDATE_CUTOFF, fold_ctes, panel_ctes
from panelspark.plans.registry import register, rounded
from panelspark.session import wide_plan_settings
from panelspark.sources import testbeds as tb
from panelspark.session import materialize

# The reference's grids.
SVC_GRID = rp.log_grid(-4, 0, 15)
SGD_GRID = rp.log_grid(-6, -2, 12)


def _panel(spark, sf):
    wide_plan_settings(spark)
    return fx.build_processed_panel(tb.calm_bars(spark, sf), profile="reference").transform(materialize)


def _pairs(spark, sf):
    panel = _panel(spark, sf)
    b = fo.trim_folds(fo.fold_bounds(panel, VALIDATE_CUTOFF, H))
    return fo.global_fold_pairs(panel, b).transform(materialize)


def _ins_test(spark, sf):
    panel = _panel(spark, sf)
    b = fo.trim_folds(fo.fold_bounds(panel, VALIDATE_CUTOFF, H))
    return fo.global_insample_and_test(panel, b, VALIDATE_CUTOFF, H).transform(materialize)


def _num_cols(df):
    return fo.feature_columns(df)


def _x_cols():
    _, fcols, icols = panel_ctes()
    return fcols + icols


# ------------------------------------------------------------------ M1-M3 (exact)

def _prep_sql():
    parts = []
    for c in _x_cols():
        parts.append(f"""SELECT '{c}' AS feature, {R6(f'quantile_cont("{c}", 0.5)')} AS median,
  {R6(f'avg("{c}")')} AS mean, {R6(f'CASE WHEN stddev_pop("{c}") = 0 THEN 1.0 ELSE stddev_pop("{c}") END')} AS scale
FROM it WHERE role = 'insample'""")
    nn = " AND ".join(f'"{c}" IS NOT NULL' for c in _x_cols())
    return (fold_ctes('expanding').replace("WITH RECURSIVE", "WITH RECURSIVE", 1) + f""",
ins_ AS (SELECT p.*, 'insample' AS role FROM inter p WHERE EXISTS (SELECT 1 FROM ft WHERE ft.ticker = p.ticker AND
  (p."Date" BETWEEN ft.train_lo AND ft.train_hi OR p."Date" BETWEEN ft.val_lo AND ft.val_hi))),
it AS (SELECT * FROM ins_ WHERE {nn})
""" + "\nUNION ALL\n".join(parts))


@register("prep_impute_scale", _prep_sql())
def q_prep(spark, sf):
    it = _ins_test(spark, sf)
    tr = it.filter(F.col("role") == "insample")
    cols = _num_cols(tr)
    med = mo.fit_medians(tr, cols)
    sc = mo.fit_scaler(mo.apply_impute(tr, med), cols)
    rows = [(c, med[c], sc[c][0], sc[c][1]) for c in cols]
    return rounded(spark.createDataFrame(rows, "feature string, median double, mean double, scale double"))


@register("prep_onehot", fold_ctes('expanding') + """
SELECT ticker AS category, CAST(row_number() OVER (ORDER BY ticker) - 1 AS INTEGER) AS position
FROM (SELECT DISTINCT ticker FROM ft)""")
def q_onehot(spark, sf):
    it = _ins_test(spark, sf)
    tr = it.filter(F.col("role") == "insample")
    idx = mo.onehot_stages()[0].fit(tr)
    return spark.createDataFrame([(c, i) for i, c in enumerate(idx.labels)], "category string, position int")


def _strat_sql():
    nn = " AND ".join(f'"{c}" IS NOT NULL' for c in _x_cols())
    return fold_ctes('expanding') + f""",
tr AS (SELECT p.ticker, p."Date", p."Target" FROM inter p JOIN ft ON p.ticker = ft.ticker AND ft.fold = 0
  AND p."Date" BETWEEN ft.train_lo AND ft.train_hi WHERE {nn}),
cls AS (SELECT "Target" AS c, count(*) AS m FROM tr GROUP BY 1),
first_ AS (SELECT "Target" AS fc FROM tr ORDER BY ticker, "Date" LIMIT 1),
ord_ AS (SELECT c, m, CASE WHEN c = (SELECT fc FROM first_) THEN 0 ELSE 1 END AS o FROM cls),
pos AS (SELECT c, m, coalesce(sum(m) OVER (ORDER BY o ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS s FROM ord_),
alloc AS (SELECT c, i, (CASE WHEN s + m <= i THEN 0 ELSE (s + m - i - 1) // 3 + 1 END)
                     - (CASE WHEN s <= i THEN 0 ELSE (s - i - 1) // 3 + 1 END) AS a
  FROM pos, (SELECT 0 AS i UNION ALL SELECT 1 UNION ALL SELECT 2) k),
sedges AS (SELECT c, i, coalesce(sum(a) OVER (PARTITION BY c ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS lo,
  sum(a) OVER (PARTITION BY c ORDER BY i ROWS UNBOUNDED PRECEDING) AS hi FROM alloc),
rk AS (SELECT *, row_number() OVER (PARTITION BY "Target" ORDER BY ticker, "Date") - 1 AS q FROM tr)
SELECT rk.ticker AS "__ticker__", rk."Date", CAST(e.i AS INTEGER) AS inner_fold
FROM rk JOIN sedges e ON e.c = rk."Target" AND rk.q >= e.lo AND rk.q < e.hi"""


@register("stratified_split", _strat_sql())
def q_strat(spark, sf):
    pairs = _pairs(spark, sf)
    tr = pairs.filter((F.col("fold") == 0) & (F.col("role") == "train"))
    return se.stratified_folds(tr, 3).select("__ticker__", "Date", "inner_fold")


def _strat_all_sql():
    nn = " AND ".join(f'"{c}" IS NOT NULL' for c in _x_cols())
    return fold_ctes('expanding') + f""",
tr AS (SELECT ft.fold, p.ticker, p."Date", p."Target" FROM inter p JOIN ft ON p.ticker = ft.ticker
  AND p."Date" BETWEEN ft.train_lo AND ft.train_hi WHERE {nn}),
first_ AS (SELECT fold, arg_min("Target", row(ticker, "Date")) AS fc FROM tr GROUP BY 1),
cls AS (SELECT fold, "Target" AS c, count(*) AS m FROM tr GROUP BY 1, 2),
pos AS (SELECT cls.fold, c, m, coalesce(sum(m) OVER (PARTITION BY cls.fold ORDER BY (c <> fc)
  ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS s FROM cls JOIN first_ ON first_.fold = cls.fold),
numbered AS (SELECT pos.fold, c, i, (SELECT count(*) FROM range(CAST(s AS BIGINT), CAST(s + m AS BIGINT)) g(v) WHERE v % 3 = i) AS a
  FROM pos, (SELECT 0 AS i UNION ALL SELECT 1 UNION ALL SELECT 2) k),
sedges AS (SELECT *, sum(a) OVER (PARTITION BY fold, c ORDER BY i ROWS UNBOUNDED PRECEDING) AS hi FROM numbered),
rk AS (SELECT *, row_number() OVER (PARTITION BY fold, "Target" ORDER BY ticker, "Date") - 1 AS q FROM tr)
SELECT CAST(rk.fold AS INTEGER) AS fold, rk.ticker AS "__ticker__", rk."Date", CAST(e.i AS INTEGER) AS inner_fold
FROM rk JOIN sedges e ON e.fold = rk.fold AND e.c = rk."Target" AND rk.q >= e.hi - e.a AND rk.q < e.hi"""


@register("stratified_split_folds", _strat_all_sql())
def q_strat_all(spark, sf):
    tr = _pairs(spark, sf).filter(F.col("role") == "train")
    return (se.stratified_folds(tr, 3, by="fold")
            .select(F.col("fold").cast("int").alias("fold"), "__ticker__", "Date", "inner_fold"))


def _shuffled_sql():
    nn = " AND ".join(f'"{c}" IS NOT NULL' for c in _x_cols())
    return fold_ctes('expanding') + f""",
tr AS (SELECT ft.fold, p.ticker, p."Date", p."Target" FROM inter p JOIN ft ON p.ticker = ft.ticker
  AND p."Date" BETWEEN ft.train_lo AND ft.train_hi WHERE {nn})
SELECT fold, ticker AS "__ticker__", "Date", "Target", CAST((row_number() OVER (PARTITION BY fold, "Target"
  ORDER BY md5(concat_ws('|', '42', ticker, CAST("Date" AS VARCHAR)))) - 1) % 3 AS INTEGER) AS inner_fold FROM tr"""


@register("shuffled_split", _shuffled_sql())
def q_shuffled(spark, sf):
    tr = _pairs(spark, sf).filter(F.col("role") == "train")
    return se.shuffled_folds(tr, 3, 42, by="fold").select("fold", "__ticker__", "Date", "Target", "inner_fold")


# ------------------------------------------------------------------ baselines

def _label_sql(src: str, pred: str) -> str:
    y = '"Target"'
    acc = R6(f"CAST(count_if({y} = {pred}) AS DOUBLE) / count(*)")
    tpr = f"CAST(count_if({y} = 1 AND {pred} = 1) AS DOUBLE) / NULLIF(count_if({y} = 1), 0)"
    fpr = f"CAST(count_if({y} = 0 AND {pred} = 1) AS DOUBLE) / NULLIF(count_if({y} = 0), 0)"
    auc = R6(f"(1.0 + {tpr} - {fpr}) / 2")
    cells = ", ".join(f"CAST(count_if({y} = {a} AND {pred} = {b}) AS BIGINT) AS {n}"
                      for a, b, n in [(1, 1, "tp"), (0, 1, "fp"), (1, 0, "fn"), (0, 0, "tn")])
    return f"SELECT {acc} AS accuracy, {auc} AS roc_auc, {cells} FROM {src}"


def _base_panel_sql():
    ctes, _ = osql.features_ctes("bars", "reference", groups=[])
    return f"{osql.with_bars('bars', tb.CALM_BARS_SQL)},{ctes}"


def _base_panel(spark, sf):
    return fx.make_features(tb.calm_bars(spark, sf), features=[], profile="reference")


@register("naive_per_ticker", _base_panel_sql() + """,
nv AS (SELECT *, lag("Target", 5) OVER (PARTITION BY ticker ORDER BY "Date") AS p FROM feat)
""" + _label_sql("nv WHERE p IS NOT NULL", "p"))
def q_naive_tk(spark, sf):
    return rounded(rp.label_report(rp.naive_persistence(_base_panel(spark, sf), 5, "per_ticker"), "NaivePred"))


@register("naive_global", _base_panel_sql() + """,
nv AS (SELECT *, lag("Target", 5) OVER (ORDER BY ticker, "Date") AS p FROM feat)
""" + _label_sql("nv WHERE p IS NOT NULL", "p"))
def q_naive_gl(spark, sf):
    return rounded(rp.label_report(rp.naive_persistence(_base_panel(spark, sf), 5, "global"), "NaivePred"))


@register("dummy", _base_panel_sql() + f""",
tr AS (SELECT * FROM feat WHERE "Date" < TIMESTAMP '{TRAIN_CUTOFF}'),
maj AS (SELECT arg_max("Target", row(n, -"Target")) AS m FROM (SELECT "Target", count(*) AS n FROM tr GROUP BY 1)),
te AS (SELECT *, (SELECT m FROM maj) AS p FROM feat WHERE NOT coalesce("Date" < TIMESTAMP '{TRAIN_CUTOFF}', false))
""" + _label_sql("te", "p"))
def q_dummy(spark, sf):
    return rounded(rp.label_report(rp.dummy_baseline(_base_panel(spark, sf), TRAIN_CUTOFF), "DummyPred"))


def _info_sql():
    base, fcols, icols = panel_ctes()
    cols = ["ticker", "Date", "Open", "High", "Low", "Close", "Volume"] + fcols + ["Target"] + icols
    parts = [f"SELECT '{c}' AS \"column\", count(\"{c}\") AS non_null, count(*) AS \"rows\" FROM inter" for c in cols]
    return base + "\n" + "\nUNION ALL\n".join(parts)


@register("panel_info", _info_sql())
def q_info(spark, sf):
    df = fx.build_processed_panel(tb.calm_bars(spark, sf), profile="reference")
    return rp.panel_info(df).drop("dtype")


# ------------------------------------------------------------------ models and search (rows only)

def _lr(c):
    return lambda weight: mo.logistic_regression(c, weight)


@register("cv_logreg")
def q_cv_logreg(spark, sf):
    pairs = _pairs(spark, sf)
    return rounded(se.cv_loop(pairs, _num_cols(pairs.drop("fold", "role")), _lr, 1.0, "logreg"))


def _split_pairs(spark, sf):
    """Pooled pairs, the training rows with their inner fold."""
    pairs = _pairs(spark, sf)
    train = se.stratified_folds(pairs.filter(F.col("role") == "train"), 3, by="fold")
    val = pairs.filter(F.col("role") == "val").withColumn("inner_fold", F.lit(None).cast("int"))
    return train.unionByName(val).transform(materialize)


def _sweep(spark, sf, solver, grid):
    pairs = _split_pairs(spark, sf)
    return solver(pairs, _num_cols(pairs.drop("fold", "role", "inner_fold")), grid)


@register("svm_sweep")
def q_svm_sweep(spark, sf):
    inner, outer, final = _sweep(spark, sf, ms.svc_sweep, SVC_GRID)
    return rounded(outer.withColumn("final_param", F.lit(final)))


@register("sgd_sweep")
def q_sgd_sweep(spark, sf):
    inner, outer, final = _sweep(spark, sf, ms.sgd_sweep, SGD_GRID)
    return rounded(outer.withColumn("final_param", F.lit(final)))


@register("sweep_reports")
def q_sweep_reports(spark, sf):
    """N3-N7 over a real sweep: curves (grouping-set union), box stats, fold series, median."""
    inner, outer, _ = _sweep(spark, sf, ms.svc_sweep, SVC_GRID)
    i, o, med = rp.rename_results(inner, outer, "C")
    curves = rp.sweep_curves(inner).select(F.lit("curve").alias("report"), F.col("outer_fold").cast("string").alias("key"),
                                           F.col("param").alias("x"), F.col("mean_metric").alias("y"))
    box = rp.box_rows(rp.param_box(outer))
    series = rp.fold_series(outer).select(F.lit("fold").alias("report"), F.col("fold").cast("string").alias("key"),
                                          F.col("val_auc").alias("x"), F.col("val_accuracy").alias("y"))
    m = med.select(F.lit("median").alias("report"), F.lit(None).cast("string").alias("key"),
                   F.col("final_C").alias("x"), F.lit(None).cast("double").alias("y"))
    return rounded(curves.unionByName(box).unionByName(series).unionByName(m))


def _forest():
    return mo.BaggedForest(n_trees=400, seed=42)


def _rf_model(spark, sf):
    it = _ins_test(spark, sf)
    tr = it.filter(F.col("role") == "insample")
    cols = _num_cols(tr.drop("role"))
    return it, cols, mo.fit_pipeline(tr, cols, _forest(), "forest", scale=False)


@register("rf_importance")
def q_rf_importance(spark, sf):
    _, _, m = _rf_model(spark, sf)
    return rounded(ins.impurity_importance(m, top=30))


def _names_sql():
    listed = ", ".join(f"({i}, '{c}')" for i, c in enumerate(_x_cols()))
    return fold_ctes('expanding') + f""",
named AS (SELECT '__ticker___' || ticker AS feature, row_number() OVER (ORDER BY ticker) AS place FROM (SELECT DISTINCT ticker FROM ft))
SELECT CAST(position AS INTEGER) AS position, feature FROM (VALUES {listed}) v(position, feature)
UNION ALL SELECT CAST({len(_x_cols()) - 1} + place AS INTEGER), feature FROM named"""


@register("feature_names", _names_sql())
def q_feature_names(spark, sf):
    it = _ins_test(spark, sf)
    tr = it.filter(F.col("role") == "insample")
    return ins.feature_names(mo.fit_preparation(tr, _num_cols(tr.drop("role")), scale=False))


@register("final_test")
def q_final_test(spark, sf):
    """M17 + E15: forest fitted on the in-sample rows, final-test stats."""
    it = _ins_test(spark, sf)
    cols = _num_cols(it.drop("role"))
    _, ev = se.final_test(it, cols, _forest(), "forest", scale=False)
    ev = ev.transform(materialize)
    return rounded(me.full_stats(ev).withColumn("n_test", F.lit(ev.count())))


@register("perm_importance")
def q_perm(spark, sf):
    it, cols, m = _rf_model(spark, sf)
    test = it.filter(F.col("role") == "test")
    return rounded(ins.permutation_importance(m, test, cols, seed=42))


@register("partial_dependence")
def q_pdp(spark, sf):
    it, cols, m = _rf_model(spark, sf)
    test = it.filter(F.col("role") == "test")
    # The five features the reference inspects.
    feats = ["HL_range", "SMA_ratio", "MACD", "BB_width", "MACD_signal"]
    return rounded(ins.partial_dependence(m, test, feats, grid_resolution=60).drop("feature2", "value2"))


@register("partial_dependence_pairs")
def q_pdp_pairs(spark, sf):
    it, cols, m = _rf_model(spark, sf)
    test = it.filter(F.col("role") == "test")
    return rounded(ins.partial_dependence(m, test, [("SMA_ratio", "MACD"), ("HL_range", "BB_width")], grid_resolution=20))


@register("rf_search")
def q_rf_search(spark, sf):
    """M14 + M15: seeded random search per outer fold, best fold."""
    pairs = _pairs(spark, sf)
    cols = _num_cols(pairs.drop("fold", "role"))
    cv = se.random_search(pairs, cols, inner_splits=3, seed=42)
    return rounded(se.best_fold(cv))
