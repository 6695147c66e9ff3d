"""Registered queries: evaluation operators E1-E15 on the ``scored`` testbed.

scored = default feature panel of calm bars with y = Target, score = round(1 - SMA_ratio, 6)
(+0.0), proba = sigmoid(50 * score); the score is a margin, so the default threshold is 0.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from panelspark.operators import features as fx
from panelspark.operators import metrics as me
from panelspark.plans import oracle_sql as osql
from panelspark.plans.queries_core import R6, r
from panelspark.plans.registry import register, round6, rounded
from panelspark.sources import testbeds as tb
from panelspark.session import materialize


def scored(spark, sf, write_once: bool = True):
    """The eval frame, written once to the checkpoint folder: every metric reads it several
    times (quantiles, scalar totals, curves), as the reference keeps its frame in memory."""
    f = fx.make_features(tb.calm_bars(spark, sf), profile="reference")
    score = round6(F.lit(1.0) - F.col("SMA_ratio"))
    s = f.select("Date", "ticker", F.col("Target").alias("y"), score.alias("score"))
    s = s.withColumn("proba", me.sigmoid(F.lit(50.0) * F.col("score")))
    ev = me.build_eval_frame(s, "score", "proba", "y", True)
    return ev.transform(materialize) if write_once else ev


def eval_sql(body: str) -> str:
    ctes, _ = osql.features_ctes("bars", "reference")
    return f"""{osql.with_bars('bars', tb.CALM_BARS_SQL)},{ctes},
sc AS (SELECT "Date", ticker, CAST("Target" AS INTEGER) AS y, {R6('1 - "SMA_ratio"')} AS score FROM feat),
ev AS (SELECT "Date", ticker, y, score, 1.0 / (1.0 + exp(-least(greatest(50.0 * score, -50.0), 50.0))) AS proba,
  CAST(score >= 0 AS INTEGER) AS "pred@0", true AS score_is_margin FROM sc),
sc2 AS (SELECT score, count_if(y = 1) AS pos, count_if(y <> 1) AS neg FROM ev GROUP BY score),
cu AS (SELECT *, sum(pos) OVER (ORDER BY score DESC ROWS UNBOUNDED PRECEDING) AS tps,
  sum(neg) OVER (ORDER BY score DESC ROWS UNBOUNDED PRECEDING) AS fps,
  sum(pos) OVER () AS "P", sum(neg) OVER () AS "N",
  row_number() OVER (ORDER BY score DESC) AS idx FROM sc2),
grid AS (SELECT DISTINCT unnest(list_append(quantile_cont(score, {[round(0.01 * k, 2) for k in range(1, 100)]}), 0.0)) AS thr FROM ev),
cnt AS (SELECT thr, CAST(count_if(score >= thr AND y = 1) AS DOUBLE) AS tp, CAST(count_if(score >= thr AND y <> 1) AS DOUBLE) AS fp,
  CAST(count_if(score < thr AND y = 1) AS DOUBLE) AS fn, CAST(count_if(score < thr AND y <> 1) AS DOUBLE) AS tn
  FROM grid, ev GROUP BY thr),
sw AS (SELECT thr, (tp + tn) / (tp + tn + fp + fn) AS acc,
  CASE WHEN 2 * tp + fp + fn > 0 THEN 2 * tp / (2 * tp + fp + fn) ELSE 0.0 END AS f1,
  CASE WHEN tp + fp > 0 THEN tp / (tp + fp) ELSE 0.0 END AS "precision",
  CASE WHEN tp + fn > 0 THEN tp / (tp + fn) ELSE 0.0 END AS recall,
  CASE WHEN fp + tn > 0 THEN fp / (fp + tn) ELSE 0.0 END AS fpr FROM cnt),
sw2 AS (SELECT *, recall - fpr AS youden FROM sw),
best AS (SELECT arg_max(thr, row(youden, -thr)) AS best_youden_thr, arg_max(thr, row(f1, -thr)) AS best_f1_thr FROM sw2)
{body}"""


def _q(name, sql, fn):
    register(name, eval_sql(sql))(fn)


_q("eval_frame", f'SELECT "Date", ticker, y, {r(["score", "proba"])}, "pred@0", score_is_margin FROM ev',
   lambda spark, sf: rounded(scored(spark, sf)))

_q("sweep", f'SELECT {r(["thr", "acc", "f1", "precision", "recall", "fpr", "youden"])} FROM sw2',
   lambda spark, sf: rounded(me.sweep_thresholds(scored(spark, sf))))

_q("best_thresholds", f'SELECT {r(["best_youden_thr", "best_f1_thr"])} FROM best',
   lambda spark, sf: rounded(me.best_thresholds(me.sweep_thresholds(scored(spark, sf)))))

_q("roc_auc", f'SELECT {R6("sum(neg * (tps - pos + pos / 2.0)) / (sum(pos) * sum(neg))")} AS roc_auc FROM cu',
   lambda spark, sf: rounded(me.roc_auc(scored(spark, sf))))

_q("avg_precision", f'SELECT {R6("coalesce(sum(pos * tps / (tps + fps)) / NULLIF(sum(pos), 0), 0.0)")} AS average_precision FROM cu',
   lambda spark, sf: rounded(me.average_precision(scored(spark, sf))))

def _roc_curve_sql():
    body = f"""SELECT CAST(idx AS BIGINT) AS point, {R6('fps / "N"')} AS fpr, {R6('tps / "P"')} AS tpr, {R6('score')} AS threshold
FROM (SELECT *, lag(tps) OVER (ORDER BY idx) AS tp_p, lag(fps) OVER (ORDER BY idx) AS fp_p,
  lead(tps) OVER (ORDER BY idx) AS tp_n, lead(fps) OVER (ORDER BY idx) AS fp_n, max(idx) OVER () AS n_pts FROM cu) nb
WHERE idx = 1 OR idx = n_pts OR fp_p - 2 * fps + fp_n <> 0 OR tp_p - 2 * tps + tp_n <> 0
UNION ALL SELECT CAST(0 AS BIGINT) AS point, 0.0 AS fpr, 0.0 AS tpr, CAST(NULL AS DOUBLE) AS threshold"""
    return body


_q("roc_curve", _roc_curve_sql(), lambda spark, sf: rounded(me.roc_curve(scored(spark, sf))))

_q("pr_curve", f"""SELECT {R6('score')} AS threshold, {R6('coalesce(tps / NULLIF(tps + fps, 0), 0.0)')} AS "precision",
  {R6('CASE WHEN "P" = 0 THEN 1.0 ELSE tps / "P" END')} AS recall FROM cu
UNION ALL SELECT CAST(NULL AS DOUBLE), 1.0, 0.0""",
   lambda spark, sf: rounded(me.pr_curve(scored(spark, sf))))

_q("calibration", f"""
SELECT CAST(len(list_filter(e[2:10], lambda x: x < proba)) AS INTEGER) AS bin, {R6('avg(proba)')} AS mean_predicted,
  {R6('avg(CAST(y AS DOUBLE))')} AS fraction_positive, count(*) AS count
FROM ev, (SELECT quantile_cont(proba, [0.0, 0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9, 1.0]) AS e FROM ev) q
GROUP BY 1""", lambda spark, sf: rounded(me.calibration(scored(spark, sf))))

_q("brier", f"SELECT {R6('avg(pow(proba - y, 2))')} AS brier FROM ev",
   lambda spark, sf: rounded(me.brier(scored(spark, sf))))


def _confusion(spark, sf):
    ev = scored(spark, sf)
    best = me.best_thresholds(me.sweep_thresholds(ev)).select("best_youden_thr").scalar()
    a = me.confusion(ev, 0.0).withColumn("thr_name", F.lit("thr0"))
    b = me.confusion(ev, best).withColumn("thr_name", F.lit("youden"))
    return a.unionByName(b)


_q("confusion", """
SELECT thr_name, CAST(yy AS INTEGER) AS y, CAST(pp AS INTEGER) AS pred, CAST(count_if(y = yy AND CAST(score >= t AS INTEGER) = pp) AS BIGINT) AS n
FROM ev, (SELECT 'thr0' AS thr_name, 0.0 AS t UNION ALL SELECT 'youden', best_youden_thr FROM best) th,
  (SELECT 0 AS yy UNION ALL SELECT 1) a, (SELECT 0 AS pp UNION ALL SELECT 1) b
GROUP BY thr_name, yy, pp""", _confusion)


def _class_report(spark, sf):
    ev = scored(spark, sf)
    best = me.best_thresholds(me.sweep_thresholds(ev)).select("best_youden_thr").scalar()
    a = me.class_report(ev, 0.0).withColumn("thr_name", F.lit("thr0"))
    b = me.class_report(ev, best).withColumn("thr_name", F.lit("youden"))
    return rounded(a.unionByName(b))


_q("class_report", f"""
, cm AS (SELECT thr_name, CAST(count_if(y = 1 AND score >= t) AS DOUBLE) AS tp, CAST(count_if(y = 0 AND score >= t) AS DOUBLE) AS fp,
  CAST(count_if(y = 1 AND score < t) AS DOUBLE) AS fn, CAST(count_if(y = 0 AND score < t) AS DOUBLE) AS tn
  FROM ev, (SELECT 'thr0' AS thr_name, 0.0 AS t UNION ALL SELECT 'youden', best_youden_thr FROM best) th GROUP BY thr_name),
pc AS (SELECT thr_name, tp, fp, fn, tn,
  CASE WHEN tp + fp > 0 THEN tp / (tp + fp) ELSE 0.0 END AS p1, CASE WHEN tp + fn > 0 THEN tp / (tp + fn) ELSE 0.0 END AS r1,
  CASE WHEN tn + fn > 0 THEN tn / (tn + fn) ELSE 0.0 END AS p0, CASE WHEN tn + fp > 0 THEN tn / (tn + fp) ELSE 0.0 END AS r0,
  tp + fn AS s1, tn + fp AS s0 FROM cm),
pf AS (SELECT *, CASE WHEN p1 + r1 > 0 THEN 2 * p1 * r1 / (p1 + r1) ELSE 0.0 END AS f1_,
  CASE WHEN p0 + r0 > 0 THEN 2 * p0 * r0 / (p0 + r0) ELSE 0.0 END AS f0_, s0 + s1 AS n FROM pc),
rep AS (
  SELECT thr_name, '0' AS label, p0 AS "precision", r0 AS recall, f0_ AS f1, s0 AS support FROM pf
  UNION ALL SELECT thr_name, '1', p1, r1, f1_, s1 FROM pf
  UNION ALL SELECT thr_name, 'accuracy', NULL, NULL, (tp + tn) / n, n FROM pf
  UNION ALL SELECT thr_name, 'macro avg', (p0 + p1) / 2, (r0 + r1) / 2, (f0_ + f1_) / 2, n FROM pf
  UNION ALL SELECT thr_name, 'weighted avg', (p0 * s0 + p1 * s1) / n, (r0 * s0 + r1 * s1) / n, (f0_ * s0 + f1_ * s1) / n, n FROM pf)
SELECT thr_name, label, {r(['precision', 'recall', 'f1'])}, CAST(support AS BIGINT) AS support FROM rep""",
   _class_report)

_q("gains", f"""SELECT "Date", ticker, CAST(rk AS BIGINT) AS "rank", {R6('rk / n')} AS pct, {R6('cum / (p + 1e-9)')} AS captured
FROM (SELECT "Date", ticker, row_number() OVER (ORDER BY proba DESC, "Date", ticker) AS rk,
  sum(y) OVER (ORDER BY proba DESC, "Date", ticker ROWS UNBOUNDED PRECEDING) AS cum,
  count(*) OVER () AS n, sum(y) OVER () AS p FROM ev) g""",
   lambda spark, sf: rounded(me.gains(scored(spark, sf))))

_q("ap_by_ticker", f"""SELECT ticker, {R6('coalesce(sum(pos * tps / (tps + fps)) / NULLIF(sum(pos), 0), 0.0)')} AS average_precision
FROM (SELECT ticker, score, pos, neg, sum(pos) OVER (PARTITION BY ticker ORDER BY score DESC ROWS UNBOUNDED PRECEDING) AS tps,
  sum(neg) OVER (PARTITION BY ticker ORDER BY score DESC ROWS UNBOUNDED PRECEDING) AS fps
  FROM (SELECT ticker, score, count_if(y = 1) AS pos, count_if(y <> 1) AS neg FROM ev GROUP BY ticker, score) s) t
GROUP BY ticker""", lambda spark, sf: rounded(me.ap_by_ticker(scored(spark, sf))))

_q("rolling_accuracy", f"""SELECT "Date", ticker,
  {R6('CASE WHEN count(*) OVER (ORDER BY "Date", ticker ROWS BETWEEN 49 PRECEDING AND CURRENT ROW) >= 50 THEN avg(CAST("pred@0" = y AS DOUBLE)) OVER (ORDER BY "Date", ticker ROWS BETWEEN 49 PRECEDING AND CURRENT ROW) END')} AS rolling_accuracy
FROM ev""", lambda spark, sf: rounded(me.rolling_accuracy(scored(spark, sf))))

_q("full_stats", f"""SELECT {R6('(SELECT sum(neg * (tps - pos + pos / 2.0)) / (sum(pos) * sum(neg)) FROM cu)')} AS roc_auc,
  {R6('(SELECT coalesce(sum(pos * tps / (tps + fps)) / NULLIF(sum(pos), 0), 0.0) FROM cu)')} AS average_precision,
  {R6('best_youden_thr')} AS best_youden_thr, {R6('best_f1_thr')} AS best_f1_thr FROM best""",
   lambda spark, sf: rounded(me.full_stats(scored(spark, sf))))
