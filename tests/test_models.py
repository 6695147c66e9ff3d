"""Regularisation, tree limits and large ids."""

import pytest
from pyspark.sql import functions as F

from panelspark.functions.ordered import row_numbers, running_sums
from panelspark.operators import models as mo
from panelspark.operators import reports as rp
from panelspark.operators import search as se
from panelspark.plans import queries_models as qm


def test_regularisation_follows_training_weight(spark):
    assert mo.logistic_regression(0.5, 4000.0).getRegParam() == pytest.approx(1 / 2000)
    assert mo.linear_svc(0.01, 10_000.0).getRegParam() == pytest.approx(0.01)
    with pytest.raises(ValueError):
        mo.random_forest(max_depth=31)


def test_fit_passes_the_row_count(spark):
    rows = [("T" if i % 2 else "U", float(i), int(i > 50)) for i in range(100)]
    df = spark.createDataFrame(rows, "__ticker__ string, x double, Target int")
    seen = []

    def factory(weight):
        seen.append(weight)
        return mo.linear_svc(1.0, weight, max_iter=50)

    scored = mo.fit_pipeline(df, ["x"], factory, "svc").transform(df)
    assert seen == [100.0]
    assert scored.where((F.col("score") > 0).cast("int") != F.col("Target")).count() <= 5


def test_inner_folds_of_every_outer_fold_at_once(spark):
    rows = [(f, f"T{d % 3}", d, int((d * 7 + f) % 5 < 2)) for f in range(3) for d in range(20 + 7 * f)]
    df = spark.createDataFrame(rows, "fold int, __ticker__ string, Date int, Target int")
    for split in (se.stratified_folds, se.shuffled_folds):
        got = {tuple(r) for r in split(df, 3, by="fold").select("fold", "__ticker__", "Date", "inner_fold").collect()}
        want = {(f, *r) for f in range(3) for r in split(df.where(F.col("fold") == f), 3).select("__ticker__", "Date", "inner_fold").collect()}
        assert got == want and len(got) == len(rows)


def test_global_order_with_hot_key(spark):
    df = spark.range(0, 400, 1, 7).select(F.when(F.col("id") < 300, F.lit(5)).otherwise(F.col("id")).alias("k"), F.col("id").alias("d"))
    got = {r.d: (r.rn, r.cum_d) for r in row_numbers(df, [("k", True), ("d", False)], "rn", sum_cols=["d"]).collect()}
    order, total = sorted(range(400), key=lambda d: (-(5 if d < 300 else d), d)), 0
    for i, d in enumerate(order):
        total += d
        assert got[d] == (i + 1, total)
    sums = running_sums(df.groupBy("k").agg(F.count("*").alias("n")), "k", ["n"]).orderBy("k").collect()
    assert [r.cum_n for r in sums] == [300 + i for i in range(101)]


def test_box_rows_hold_every_statistic(spark):
    got = {r.key: r.x for r in rp.box_rows(rp.param_box(spark.createDataFrame([(float(i),) for i in range(5)], "param double"))).collect()}
    assert got == {"min": 0.0, "q1": 1.0, "median": 2.0, "q3": 3.0, "max": 4.0, "whisker_lo": -2.0, "whisker_hi": 6.0}


def test_registered_models_have_the_reference_sizes():
    forest = qm._forest()
    assert (forest.n_trees, forest.max_depth) == (400, 30)
    assert (len(qm.SVC_GRID), len(qm.SGD_GRID)) == (15, 12)
