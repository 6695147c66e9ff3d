"""Registered queries: reports over result tables (N3-N7, M15), probability strategies (E1, M16), result files
(S7, S8), CSV ingest with ordinals and header groups (S1, C1), and skipped tickers (K9).

The result tables are derived from ``lineitem`` by plain aggregates, so that the reports are exact and
their work grows with the input; the sweeps that fill them in practice are in ``queries_models``.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from panelspark.operators import cleaning as cl
from panelspark.operators import folds as fo
from panelspark.operators import metrics as me
from panelspark.operators import reports as rp
from panelspark.operators import search as se
from panelspark.plans import queries_clean  # noqa: F401  (its oracle is shared)
from panelspark.plans.queries_core import BARS, R6, r
from panelspark.plans.queries_folds import H, VALIDATE_CUTOFF, fold_ctes, processed_panel
from panelspark.plans.queries_metrics import eval_sql, scored
from panelspark.plans.registry import ORACLES, register, rounded
from panelspark.sources import files as fs
from panelspark.sources import testbeds as tb

_RESULTS = """WITH inner_ AS (SELECT CAST(l_linenumber % 4 AS INTEGER) AS outer_fold, CAST(l_suppkey % 3 AS INTEGER) AS inner_split,
  CAST(l_partkey % 15 AS DOUBLE) / 8 AS param, 0.5 + avg(l_discount) AS metric FROM lineitem GROUP BY 1, 2, 3),
outer_ AS (SELECT CAST(l_linenumber AS INTEGER) AS fold, CAST(min(l_partkey) % 15 AS DOUBLE) / 8 + CAST(l_linenumber AS DOUBLE) / 16 AS param,
  0.5 + avg(l_tax) AS inner_mean_metric, round(0.5 + avg(l_discount), 3) AS val_auc,
  CAST(count_if(l_returnflag = 'R') AS DOUBLE) / count(*) AS val_accuracy, count(*) AS n_val FROM lineitem GROUP BY l_linenumber)
"""


def _results(spark, sf):
    li = spark.read.parquet(f"{sf}/lineitem.parquet")
    inner = li.groupBy((F.col("l_linenumber") % 4).cast("int").alias("outer_fold"), (F.col("l_suppkey") % 3).cast("int").alias("inner_split"),
                       ((F.col("l_partkey") % 15).cast("double") / 8).alias("param")).agg((F.lit(0.5) + F.avg("l_discount").cast("double")).alias("metric"))
    outer = li.groupBy(F.col("l_linenumber").cast("int").alias("fold")).agg(
        ((F.min("l_partkey") % 15).cast("double") / 8 + F.first("l_linenumber").cast("double") / 16).alias("param"),
        (F.lit(0.5) + F.avg("l_tax").cast("double")).alias("inner_mean_metric"), F.round(F.lit(0.5) + F.avg("l_discount").cast("double"), 3).alias("val_auc"),
        (F.count_if(F.col("l_returnflag") == "R").cast("double") / F.count(F.lit(1))).alias("val_accuracy"), F.count(F.lit(1)).alias("n_val"))
    return inner, outer


@register("report_curves", _RESULTS + f"""SELECT outer_fold, param, {R6('avg(metric)')} AS mean_metric FROM inner_
GROUP BY GROUPING SETS ((outer_fold, param), (param))""")
def q_curves(spark, sf):
    """N3 + N4: mean inner metric by outer fold and parameter, and by parameter."""
    return rounded(rp.sweep_curves(_results(spark, sf)[0]))


@register("report_box", _RESULTS + f""", q AS (SELECT quantile_cont(param, [0.0, 0.25, 0.5, 0.75, 1.0]) AS q FROM outer_),
s AS (SELECT unnest(['min', 'q1', 'median', 'q3', 'max', 'whisker_lo', 'whisker_hi']) AS key,
  unnest([q[1], q[2], q[3], q[4], q[5], q[2] - 1.5 * (q[4] - q[2]), q[4] + 1.5 * (q[4] - q[2])]) AS x FROM q)
SELECT key, {R6('x')} AS x FROM s""")
def q_box(spark, sf):
    """Every box statistic of the chosen parameters."""
    return rounded(rp.box_rows(rp.param_box(_results(spark, sf)[1])).select("key", "x"))


@register("report_folds", _RESULTS + f"SELECT fold, {r(['val_auc', 'val_accuracy'])} FROM outer_")
def q_fold_series(spark, sf):
    """Validation AUC and accuracy by fold."""
    return rounded(rp.fold_series(_results(spark, sf)[1]))


@register("report_renamed", _RESULTS + f"""SELECT 'inner' AS "table", param AS "C", {R6('metric')} AS auc, NULL AS "final_C" FROM inner_
UNION ALL SELECT 'outer', param, {R6('inner_mean_metric')}, NULL FROM outer_
UNION ALL SELECT 'final', NULL, NULL, {R6('median(param)')} FROM outer_""")
def q_renamed(spark, sf):
    """The renamed result tables and the median parameter."""
    inner, outer, final = rp.rename_results(*_results(spark, sf), "C")
    null = F.lit(None).cast("double")
    i = inner.select(F.lit("inner").alias("table"), "C", "auc", null.alias("final_C"))
    o = outer.select(F.lit("outer").alias("table"), "C", F.col("inner_mean_auc").alias("auc"), null.alias("final_C"))
    f = final.select(F.lit("final").alias("table"), null.alias("C"), null.alias("auc"), "final_C")
    return rounded(i.unionByName(o).unionByName(f))


@register("best_fold", _RESULTS + f"""SELECT fold, {r(['val_auc', 'param'])}, n_val FROM outer_ ORDER BY val_auc DESC, outer_.fold LIMIT 1""")
def q_best_fold(spark, sf):
    """The fold with the best validation AUC, the lowest on ties."""
    return rounded(se.best_fold(_results(spark, sf)[1], "val_auc").select("fold", "val_auc", "param", "n_val"))


_STRATEGIES = ("auto", "model", "sigmoid", "none")
_KINDS = {"margin": (True, False), "both": (True, True), "probability": (False, True)}


def _strategy_sql():
    sig, own = "1.0 / (1.0 + exp(-least(greatest(m, -50.0), 50.0)))", "p"
    parts = []
    for kind, (has_margin, has_own) in _KINDS.items():
        for s in _STRATEGIES:
            auto = own if has_own else sig
            proba = {"auto": auto, "model": own if has_own else "NULL", "sigmoid": sig if has_margin else "NULL", "none": "NULL"}[s]
            score = "m" if has_margin else own
            parts.append(f"""SELECT '{kind}' AS kind, '{s}' AS strategy, "Date", ticker, {R6(f'CAST({score} AS DOUBLE)')} AS score,
  {R6(f'CAST({proba} AS DOUBLE)')} AS proba, CAST({score} >= {0.0 if has_margin else 0.5} AS INTEGER) AS "pred@0" FROM mp""")
    return eval_sql(", mp AS (SELECT *, 80.0 * score AS m, 0.25 + 0.5 * proba AS p FROM ev) " + " UNION ALL ".join(parts))


@register("proba_strategies", _strategy_sql())
def q_strategies(spark, sf):
    """E1 + M16 + E2: every probability strategy over models with a margin, a probability, or both."""
    ev = scored(spark, sf).withColumns({"m": F.lit(80.0) * F.col("score"), "p": F.lit(0.25) + F.lit(0.5) * F.col("proba")})
    out = None
    for kind, (has_margin, has_own) in _KINDS.items():
        for s in _STRATEGIES:
            score, proba = me.scores_and_proba(F.col("m") if has_margin else None, F.col("p") if has_own else None, s)
            frame = me.build_eval_frame(ev.select("Date", "ticker", "y", score.alias("score"), proba.alias("proba")), score_is_margin=has_margin)
            part = frame.select(F.lit(kind).alias("kind"), F.lit(s).alias("strategy"), "Date", "ticker", "score", "proba", "pred@0")
            out = part if out is None else out.unionByName(part)
    return rounded(out)


@register("metrics_roundtrip", eval_sql(f"SELECT {r(['thr', 'acc', 'f1', 'precision', 'recall', 'fpr', 'youden'])} FROM sw2"))
def q_metrics_file(spark, sf):
    """A metrics table written as CSV and read back with its types."""
    sweep = me.sweep_thresholds(scored(spark, sf)).select("thr", "acc", "f1", "precision", "recall", "fpr", "youden")
    path = fs.write_table_csv(sweep, fs.new_scratch(spark, "metrics_csv"))
    return rounded(fs.read_table_csv(spark, path, sweep.schema))


@register("predictions_roundtrip", eval_sql(f'SELECT "Date", ticker, y, {r(["score", "proba"])}, "pred@0" FROM ev'))
def q_predictions_file(spark, sf):
    """The prediction frame written as CSV and read back with its types."""
    frame = scored(spark, sf).select("Date", "ticker", "y", "score", "proba", "pred@0")
    path = fs.write_table_csv(frame, fs.new_scratch(spark, "predictions_csv"))
    return rounded(fs.read_table_csv(spark, path, frame.schema))


def _evaluation_sql():
    cells = lambda cols: ", ".join(f"CAST({R6(f'CAST({c} AS DOUBLE)')} AS DOUBLE) AS {n}" for n, c in zip("tabcd", cols))
    roc = """(SELECT 0 AS idx, 0.0 AS fpr, 0.0 AS tpr, NULL AS score UNION ALL SELECT idx, fps / "N", tps / "P", score
  FROM (SELECT *, lag(tps) OVER (ORDER BY idx) AS tp_p, lag(fps) OVER (ORDER BY idx) AS fp_p, lead(tps) OVER (ORDER BY idx) AS tp_n,
    lead(fps) OVER (ORDER BY idx) AS fp_n, max(idx) OVER () AS n_pts FROM cu) nb
  WHERE idx = 1 OR idx = n_pts OR fp_p - 2 * fps + fp_n <> 0 OR tp_p - 2 * tps + tp_n <> 0) rc"""
    pr = """(SELECT score, tps / (tps + fps) AS p, tps / "P" AS r FROM cu UNION ALL SELECT NULL, 1.0, 0.0) pc"""
    stats = """(SELECT (SELECT sum(neg * (tps - pos + pos / 2.0)) / (sum(pos) * sum(neg)) FROM cu) AS auc,
  (SELECT sum(pos * tps / (tps + fps)) / sum(pos) FROM cu) AS ap, best_youden_thr, best_f1_thr FROM best) st"""
    parts = [("stats", ["NULL", "auc", "ap", "best_youden_thr", "best_f1_thr"], stats),
             ("sweep", ["thr", "acc", "f1", '"precision"', "recall"], "sw2"), ("roc_curve", ["score", "fpr", "tpr", "NULL", "NULL"], roc),
             ("pr_curve", ["score", "p", "r", "NULL", "NULL"], pr), ("predictions", ["NULL", "y", "score", "proba", '"pred@0"'], "ev")]
    return eval_sql(" UNION ALL ".join(f"SELECT '{n}' AS frame, {cells(cols)} FROM {source}" for n, cols, source in parts))


@register("full_evaluation", _evaluation_sql())
def q_full_evaluation(spark, sf):
    """Statistics, sweep and curves of one score table, and the predictions as written and read back."""
    path = fs.new_scratch(spark, "evaluation")
    frames = me.full_evaluation(scored(spark, sf, write_once=False), path)
    frames["predictions"] = fs.read_table_csv(spark, f"{path}/final_test_predictions.csv", frames["predictions"].schema)
    cells = {"stats": [None, "roc_auc", "average_precision", "best_youden_thr", "best_f1_thr"], "sweep": ["thr", "acc", "f1", "precision", "recall"],
             "roc_curve": ["threshold", "fpr", "tpr", None, None], "pr_curve": ["threshold", "precision", "recall", None, None],
             "predictions": [None, "y", "score", "proba", "pred@0"]}
    out = None
    for name, cols in cells.items():
        part = frames[name].select(F.lit(name).alias("frame"), *[(F.col(f"`{c}`") if c else F.lit(None)).cast("double").alias(n) for n, c in zip("tabcd", cols)])
        out = part if out is None else out.unionByName(part)
    return rounded(out)


MIN_TRAIN = 880


@register("skipped_tickers", f"""{fold_ctes('expanding')}
SELECT t.ticker, CAST(count(u.ticker) AS BIGINT) AS n_folds, count(u.ticker) = 0 AS skipped FROM (SELECT DISTINCT ticker FROM inter) t
LEFT JOIN (SELECT ticker FROM fo WHERE n_train >= {MIN_TRAIN}) u ON u.ticker = t.ticker GROUP BY 1""")
def q_skipped(spark, sf):
    """K9: folds of every ticker and those that yield none, at a larger least training size."""
    panel = processed_panel(spark, sf)
    bounds = fo.fold_bounds(panel, VALIDATE_CUTOFF, H, None, "365D", "expanding", None, min_train=MIN_TRAIN)
    used = bounds.groupBy("ticker").agg(F.count(F.lit(1)).alias("n_folds"), F.lit(False).alias("skipped"))
    none = fo.skipped_tickers(panel, bounds).select("ticker", F.lit(0).cast("bigint").alias("n_folds"), F.lit(True).alias("skipped"))
    return used.unionByName(none)


@register("csv_header_groups", f'SELECT ticker, "Date", {r(BARS)} FROM ({tb.CALM_BARS_SQL})')
def q_header_groups(spark, sf):
    """One folder of files whose headers differ in order, case and spacing."""
    bars = tb.calm_bars(spark, sf).withColumn("day", F.date_format("Date", "yyyy-MM-dd"))
    odd = F.pmod(F.xxhash64("ticker"), F.lit(2)) == 1
    path = fs.new_scratch(spark, "mixed_csv")
    one = bars.where(odd).select("ticker", F.col("day").alias("Date"), *BARS)
    two = bars.where(~odd).select("ticker", *[F.col(c).alias(f" {c.upper()} ") for c in reversed(BARS)], F.col("day").alias(" date"))
    for part in (one, two):
        part.write.mode("append").partitionBy("ticker").option("header", True).csv(path)
    return rounded(fs.load_csv_bars(spark, path).select("ticker", "Date", *BARS))


@register("csv_clean_pipeline", ORACLES["clean_pipeline"])
def q_csv_clean(spark, sf):
    """S1 + C1: CSV files with repeated days, of which the last row counts, to the cleaned panel."""
    dirty = tb.dirty_bars(spark, sf)
    path = fs.new_scratch(spark, "dirty_csv")
    cols = [c for c in dirty.columns if c not in ("ticker", "Date", "ord")]
    (dirty.repartition("ticker").sortWithinPartitions("ticker", "ord").select("ticker", F.date_format("Date", "yyyy-MM-dd").alias("Date"), *cols)
     .write.partitionBy("ticker").option("header", True).csv(path))
    raw = fs.load_csv_bars(spark, path, with_ord=True)
    return rounded(cl.cleaning_pipeline(raw, tb.corp_events(spark, sf)).select("ticker", "Date", *cols))
