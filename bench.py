"""Benchmark the headline plans at $BENCH_SF_DIR (default /root/testdata/sf0.1).

Prints one JSON line: {"metric", "value" (total seconds), "unit", "queries": {...}, "sf"}.
Each query is forced with the ``noop`` sink, so every column is computed and nothing is
collected to the driver.
"""

from __future__ import annotations

import json
import os
import re
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import functions as F  # noqa: E402

from panelspark.config import PanelConfig  # noqa: E402
from panelspark.operators import cleaning as cl  # noqa: E402
from panelspark.operators import features as fx  # noqa: E402
from panelspark.operators import folds as fo  # noqa: E402
from panelspark.operators import metrics as me  # noqa: E402
from panelspark.plans.pipeline import data_build  # noqa: E402
from panelspark.session import get_spark  # noqa: E402
from panelspark.sources import testbeds as tb  # noqa: E402
from panelspark.session import materialize  # noqa: E402

FULL = ("r_1d", "lag", "sma", "vix", "rsi", "macd", "boll", "obv", "range", "gap")


def run(df):
    df.write.format("noop").mode("overwrite").save()


def main():
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = get_spark(f"local[{cpus}]", int(os.environ.get("BENCH_SHUFFLE_PARTITIONS", cpus)))
    m = re.search(r"sf([0-9.]+)", sf_dir)
    sf = float(m.group(1)) if m else None
    conf = PanelConfig(validate_cutoff="2000-01-01", train_cutoff="1999-01-01")

    def q_bars():
        run(tb.wide_bars(spark, sf_dir))

    def q_features():
        # 1,000 tickers at sf0.1: full feature profile, dropna, interactions.
        run(fx.build_processed_panel(tb.wide_bars(spark, sf_dir), FULL, profile="full"))

    def q_clean():
        run(cl.outlier_flags(tb.raw_bars(spark, sf_dir), tb.corp_events(spark, sf_dir)))

    def q_pipeline():
        run(data_build(tb.dirty_bars(spark, sf_dir), tb.corp_events(spark, sf_dir), conf))

    def q_folds():
        panel = fx.make_features(tb.wide_bars(spark, sf_dir), profile="reference").transform(materialize)
        b = fo.trim_folds(fo.fold_bounds(panel, conf.validate_cutoff, conf.horizon))
        run(fo.global_fold_pairs(panel, b))

    def q_metrics():
        f = fx.make_features(tb.wide_bars(spark, sf_dir), profile="reference")
        s = f.select("Date", "ticker", F.col("Target").alias("y"),
                     (F.round(F.lit(1.0) - F.col("SMA_ratio"), 6) + F.lit(0.0)).alias("score"))
        s = s.withColumn("proba", me.sigmoid(F.lit(50.0) * F.col("score")))
        frames = me.full_evaluation(me.build_eval_frame(s))
        for name in ("stats", "roc_curve", "gains", "rolling_accuracy"):
            run(frames[name])

    plan = [("bars_wide", q_bars), ("features_full_wide", q_features), ("outliers_raw", q_clean),
            ("data_build_dirty", q_pipeline), ("folds_pairs_wide", q_folds), ("metrics_wide", q_metrics)]
    only = set(sys.argv[1:])
    times = {}
    for name, fn in plan:
        if only and name not in only:
            continue
        t0 = time.time()
        fn()
        times[name] = round(time.time() - t0, 3)
    print(json.dumps({"metric": "panel_pipeline_total", "value": round(sum(times.values()), 3),
                      "unit": "sec", "queries": times, "sf": sf}))


if __name__ == "__main__":
    main()
