"""Multi-model margin solver, bagged forests, and forests as arrays, against Spark's own fits and scoring."""

import gc
import math
import weakref

import numpy as np
import pytest
from py4j.java_gateway import JavaObject
from pyspark.ml.classification import DecisionTreeClassificationModel, LinearSVC, RandomForestClassificationModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from panelspark.functions.ordered import exact_quantiles_stacked
from panelspark.operators import forest_tables as ft
from panelspark.operators import inspect as ins
from panelspark.operators import margin_sweep as ms
from panelspark.operators import models as mo
from panelspark.operators import search as se
from panelspark.operators import stored_forest as sf

COLS = ["a", "b", "c"]


@pytest.fixture(scope="module")
def pairs(spark):
    rnd, rows = np.random.RandomState(4), []
    for fold in range(2):
        for i in range(120 + 180 * fold):
            x = rnd.randn(3) * [1, 5, 0.2]
            y = int(x[0] + 0.3 * x[1] + rnd.randn() > 0.4)
            role = "val" if i % 5 == 0 else "train"
            rows.append((f"T{i % 4}", i, *[None if rnd.rand() < 0.05 else float(v) for v in x], y, fold, role, None if role == "val" else i % 3))
    return spark.createDataFrame(rows, f"{mo.TICKER_COL} string, Date int, a double, b double, c double, {mo.LABEL} int, fold int, role string, inner_fold int").coalesce(1).cache()


def hinge(df, coefficients, intercept, reg, weights):
    x = np.array([r[0] for r in df.select(vector_to_array("features")).collect()])
    y = np.array([r[0] for r in df.select(mo.LABEL).collect()])
    w = weights[y]
    u = 1 - (2 * y - 1) * (x @ coefficients + intercept)
    return float(w @ np.maximum(u, 0) / w.sum() + reg / 2 * coefficients @ coefficients)


@pytest.mark.parametrize("balanced", [True, False])
def test_every_model_is_as_good_as_sparks_own_fit(spark, pairs, balanced):
    reg = ms.svc_penalty if balanced else ms.sgd_penalty
    grid = [0.003, 1.0] if balanced else [1e-5, 1e-2]
    _, preps, models = ms.fit_all(pairs, COLS, grid, reg, balanced, 3)
    assert len(models) == 2 * 4 * 2 and all(m.done and m.converged for m in models)
    for m in [m for m in models if m.split == ms.REFIT and m.fold == 1]:
        train = pairs.where((F.col("fold") == m.fold) & (F.col("role") == "train") & (F.col("inner_fold") != m.split))
        prep = mo.fit_preparation(train, COLS)
        own = preps[m.fold, m.split]
        assert prep.rows == own.rows
        assert [prep.medians[c] for c in COLS] == pytest.approx(own.median.tolist())
        assert [prep.scale[c] for c in COLS] == [pytest.approx((a, b)) for a, b in zip(own.mean, own.std)]
        data = mo.balanced_weights(prep.vectors(train)).withColumn("_w", F.col("_w") if balanced else F.lit(1.0))
        fit = LinearSVC(regParam=m.reg, standardization=False, maxIter=40, tol=1e-6, weightCol="_w", featuresCol="features", labelCol=mo.LABEL).fit(data)
        spark_objective = hinge(data, fit.coefficients.toArray(), fit.intercept, m.reg, own.weight)
        mine = hinge(data, np.r_[m.num[:-1], m.tick], m.num[-1], m.reg, own.weight)
        assert mine == pytest.approx(m.objective, abs=1e-9)
        assert mine <= spark_objective + 1e-4


def test_sweep_tables(spark, pairs):
    inner, outer, final = ms.svc_sweep(pairs, COLS, [0.01, 0.1, 1.0])
    assert inner.count() == 2 * 3 * 3 and outer.count() == 2
    means = {(r["outer_fold"], r["param"]): r["m"] for r in inner.groupBy("outer_fold", "param").agg(F.avg("metric").alias("m")).collect()}
    chosen = []
    for r in outer.collect():
        best = max(means[r["fold"], p] for p in (0.01, 0.1, 1.0))
        assert r["inner_mean_metric"] == pytest.approx(best) and r["converged"] == 1.0 and 0.5 < r["val_auc"] <= 1
        chosen.append(r["param"])
    assert final == pytest.approx(sum(sorted(chosen)) / 2)


def test_stacked_quantiles(spark):
    rnd = np.random.RandomState(1)
    groups = {"a": rnd.randn(31).round(1), "b": rnd.randn(4), "c": np.array([2.0])}
    df = spark.createDataFrame([(k, float(v)) for k, vs in groups.items() for v in vs], "_c string, _v double")
    got = exact_quantiles_stacked(df, [0.1, 0.5])
    for k, v in groups.items():
        assert got[k] == pytest.approx(np.quantile(v, [0.1, 0.5]).tolist())


def test_bags_weigh_classes_alike(spark, pairs):
    train = pairs.where("role = 'train' and fold = 1")
    keys = [mo.TICKER_COL, "Date"]
    weights = mo.bag_class_weights(train, 6, 42, keys)
    assert sorted(weights) == list(range(6)) and len({tuple(w.values()) for w in weights.values()}) > 1
    for bag, w in weights.items():
        drawn = train.withColumn("n", mo.bag_draws(F.lit(bag), 42, keys))
        by = F.when(F.col(mo.LABEL) == 1, F.lit(w[1])).otherwise(F.lit(w[0]))
        sums = [r[1] for r in drawn.groupBy(mo.LABEL).agg(F.sum(F.col("n") * by)).collect()]
        assert sums[0] == pytest.approx(sums[1]) and sum(sums) == pytest.approx(drawn.agg(F.sum("n")).first()[0])
    draws = spark.range(20_000).select(mo.bag_draws(F.lit(1), 7, ["id"]).alias("n"))
    mean, var = draws.agg(F.avg("n"), F.var_pop("n")).first()
    assert mean == pytest.approx(1, abs=0.03) and var == pytest.approx(1, abs=0.05)


@pytest.fixture(scope="module")
def forest(pairs):
    train = pairs.where("role = 'train' and fold = 1")
    return mo.fit_pipeline(train, COLS, mo.BaggedForest(n_trees=7, trees_a_bag=3, max_depth=6), "forest", scale=False)


def test_bagged_forest_joins_its_trees(spark, pairs, forest):
    clf = forest.spark_model.stages[-1]
    assert clf.getNumTrees == 7 and sum(clf.featureImportances.toArray()) == pytest.approx(1)
    names = [r.feature for r in ins.feature_names(forest).orderBy("position").collect()]
    assert names == COLS + [f"{mo.TICKER_COL}_T{i}" for i in range(4)]
    assert ins.impurity_importance(forest, 3).count() == 3


def test_forest_arrays_score_as_the_model(spark, pairs, forest):
    test = pairs.where("role = 'val'")
    trees = ft.tables(forest.spark_model.stages[-1], spark)
    x = np.array([r[0] for r in ft.feature_rows(forest, test).collect()])
    want = sorted(r[0] for r in forest.transform(test).select("proba").collect())
    got = sorted(ft.grid_sums(trees, x[i : i + 1], [0], [x[i, :1]])[0] for i in range(len(x)))
    assert got == pytest.approx(want)
    donors = np.random.RandomState(0).randn(len(x), 3, 4)
    grids = [np.sort(donors[:n, j, 0]) for j, n in enumerate((5, 3, 1))]
    scores = ft.swapped_scores(trees, x, [2, 0, 1], donors)
    sums = ft.single_grid_sums(trees, x, [2, 0, 1], grids)
    for j, feature in enumerate([2, 0, 1]):
        assert sums[j] == pytest.approx(ft.grid_sums(trees, x, [feature], [grids[j]]))
        for k in range(4):
            swapped = x.copy()
            swapped[:, feature] = donors[:, j, k]
            plain = [ft.grid_sums(trees, swapped[i : i + 1], [feature], [swapped[i, feature : feature + 1]])[0] for i in range(len(x))]
            assert scores[:, j, k] == pytest.approx(plain)


def test_partial_dependence_of_features_and_pairs(spark, pairs, forest):
    test = pairs.where("role = 'val'")
    rows = ins.partial_dependence(forest, test, ["a", ("b", "c")], grid_resolution=5).collect()
    assert len(rows) == 5 + 25
    for r in rows[::4]:
        at = test.withColumn(r.feature, F.lit(r.value))
        at = at.withColumn(r.feature2, F.lit(r.value2)) if r.feature2 else at
        assert forest.transform(at).agg(F.avg("proba")).first()[0] == pytest.approx(r.average)


def test_permutation_importance(spark, pairs, forest, monkeypatch):
    seen = []

    def both(model, joined, ids, cols, label, key):
        walked = keep(model, joined, ids, cols, label, key)
        copies = ins._permuted_copies(model, joined, cols, label, key)
        for out in (walked, copies):
            seen.append(sorted((r["_col"], r["_rep"], r["y"], round(r["score"], 9)) for r in out.select("_col", "_rep", "y", "score").collect()))
        return walked

    keep = ins._permuted
    monkeypatch.setattr(ins, "_permuted", both)
    test = pairs.where("role = 'val' and fold = 1")
    rows = {r.feature: r for r in ins.permutation_importance(forest, test, COLS, n_repeats=3).collect()}
    assert seen[0] == seen[1] and len(seen[0]) == 60 * 3 * 3
    assert set(rows) == set(COLS) and rows["b"].importance_mean > rows["c"].importance_mean
    assert all(math.isfinite(r.importance_std) for r in rows.values())


def test_smaller_draws_take_the_first_trees(spark, pairs):
    train = pairs.where("role = 'train' and fold = 0")
    known = mo.balanced_weights(mo.fit_preparation(train, COLS, scale=False).vectors(train))
    draw = {"n_estimators": 5, "max_depth": 4, "min_samples_leaf": 2, "max_features": "sqrt", "bootstrap": True, "max_samples": None, "criterion": "gini"}
    big, small = se.fit_draws(known, [draw, {**draw, "n_estimators": 2}], 1, 2)
    assert (big.getNumTrees, small.getNumTrees) == (5, 2)
    assert [t.toDebugString.split("\n")[1:] for t in big.trees[:2]] == [t.toDebugString.split("\n")[1:] for t in small.trees]


def test_random_search(spark, pairs, monkeypatch):
    monkeypatch.setattr(se, "sample_space", lambda n, seed: [{"n_estimators": 2 + j, "max_depth": 3, "min_samples_leaf": 1 + j} for j in range(n)])
    got = se.random_search(pairs.drop("inner_fold").where("fold = 0"), COLS, n_iter=2, inner_splits=2, parallelism=2).collect()
    assert [r.fold for r in got] == [0] and got[0].draw in (0, 1) and got[0].n_val == 24


def test_a_fit_makes_no_python_object_a_tree(spark, pairs, monkeypatch):
    train = pairs.where("role = 'train' and fold = 0")
    known = mo.balanced_weights(mo.fit_preparation(train, COLS, scale=False).vectors(train))
    made = []
    monkeypatch.setattr(DecisionTreeClassificationModel, "__init__", lambda self, java=None: made.append(java))
    model = mo.random_forest(4, max_depth=3).fit(known)
    assert mo.joined_forest([model], 2).getNumTrees == 2 and model.transform(known).count() == known.count()
    assert not made
    monkeypatch.undo()
    assert len(model.trees) == 4


def test_search_lets_each_forest_go(spark, pairs, monkeypatch):
    """One fit at a time: the forests before are gone when one is scored, and the draw chosen in each fold is the best."""
    draws = [{"n_estimators": 2 + j % 2, "max_depth": 2 + j, "min_samples_leaf": 1 + 3 * j} for j in range(2)]
    monkeypatch.setattr(se, "sample_space", lambda n, seed: draws)
    alive, most, transform, score, scored = weakref.WeakSet(), [], RandomForestClassificationModel.transform, getattr(se, "score_draws", None), []

    def counted(self, *a):
        alive.add(self)
        most.append(len(alive))
        return transform(self, *a)

    monkeypatch.setattr(RandomForestClassificationModel, "transform", counted)
    monkeypatch.setattr(se, "score_draws", lambda *a: (scored.append((a[0], score(*a))), scored[-1][1])[1], raising=False)
    got = se.random_search(pairs.drop("inner_fold"), COLS, n_iter=2, inner_splits=2, parallelism=1).collect()
    assert len(most) == 2 * 2 * 2 + 2 and max(most) == 1
    monkeypatch.undo()
    tables, stacked = scored[0]
    auc = {}
    for (k, i), (known, asked, rows) in tables.items():
        assert known.count() == rows
        for j, d in enumerate(draws):
            want = se.forest_from(d, 42).fit(known).transform(asked).select("y", vector_to_array("probability")[1].alias("score"))
            own = stacked.where(f"fold = {k} and split = {i} and draw = {j}").select("y", "score")
            assert sorted(map(tuple, own.collect())) == sorted(map(tuple, want.collect()))
            auc.setdefault((k, j), []).append(se._auc(want.withColumnRenamed("y", mo.LABEL)))
    for r in got:
        best = min(range(2), key=lambda j: (-sum(auc[r.fold, j]) / 2, j))
        assert (r.draw, r.best_params) == (best, str(sorted(draws[best].items())))


def test_a_bagged_forest_is_written_bag_by_bag(spark, pairs, monkeypatch):
    """The driver joins no bags, and the table scores as Spark's own forest of the same trees."""
    models, join, add = [], mo.joined_forest, sf.Saved.add
    monkeypatch.setattr(mo, "joined_forest", lambda *a: pytest.fail("the whole forest in the driver"))
    monkeypatch.setattr(sf.Saved, "add", lambda self, part, model: (models.append((part, model)), add(self, part, model))[1])
    monkeypatch.setattr(sf, "NODES", 40)
    monkeypatch.setattr(sf, "BLOCK", 16)
    train, val = (pairs.where(f"role = '{r}' and fold = 1") for r in ("train", "val"))
    fitted = mo.fit_pipeline(train, COLS, mo.BaggedForest(n_trees=7, trees_a_bag=3, max_depth=6), "forest", scale=False)
    own = fitted.spark_model.stages[-1]
    spark_forest = join([m for _, m in sorted(models, key=lambda x: x[0])])
    assert own.getNumTrees == 7 and own.nodes == sum(t.numNodes for t in spark_forest.trees) > 3 * sf.NODES
    assert own.featureImportances.toArray() == pytest.approx(spark_forest.featureImportances.toArray())
    columns = [vector_to_array(c).alias(c) for c in ("rawPrediction", "probability")]
    vectors = mo.PipelineModel(fitted.spark_model.stages[:-1]).transform(fitted.prepare(val)).select(mo.TICKER_COL, "Date", "features")
    got, want = ({(r[0], r[1]): r for r in m.transform(vectors).select(mo.TICKER_COL, "Date", *columns, "prediction").collect()} for m in (own, spark_forest))
    assert set(got) == set(want) and len(got) == val.count()
    for k, r in want.items():
        assert [*got[k].rawPrediction, *got[k].probability, got[k].prediction] == pytest.approx([*r.rawPrediction, *r.probability, r.prediction])
    alone = ins.partial_dependence(fitted, val, ["a"], grid_resolution=4).collect()
    for r in alone:
        assert fitted.transform(val.withColumn("a", F.lit(r.value))).agg(F.avg("proba")).first()[0] == pytest.approx(r.average)
    assert len(alone) == 4 and own.transform(vectors.limit(0)).count() == 0


def test_a_saved_bag_is_let_go(spark, pairs, forest):
    """No handle on a saved bag's trees or writer is left: the JVM keeps what a handle names."""
    train = pairs.where("role = 'train' and fold = 1")
    known = mo.balanced_weights(mo.PipelineModel(forest.spark_model.stages[:-1]).transform(forest.prepare(train)))
    model = mo.random_forest(3, max_depth=3).fit(known)
    gc.collect()
    gc.disable()
    try:
        before = {id(o) for o in gc.get_objects() if issubclass(type(o), JavaObject)}
        assert sf.Saved(spark, 3).add(0, model)[0] == 3
        names = [o.getClass().getName() for o in gc.get_objects() if issubclass(type(o), JavaObject) and id(o) not in before]
    finally:
        gc.enable()
    assert not [n for n in names if "DecisionTree" in n or "Writer" in n]


def test_bags_at_once_follow_the_heap(spark, pairs, monkeypatch):
    """More rows, fewer bags beside each other; a larger heap, more of them, up to a slot each."""
    at = [mo.bags_at_once(heap, rows, 10, 12) for heap, rows in ((750 << 20, 40_000), (2 << 30, 40_000), (750 << 20, 80_000), (750 << 20, 10**9), (750 << 20, 0))]
    assert at == [5, 12, 2, 1, 12]
    asked, pool = [], mo.ThreadPool
    monkeypatch.setattr(mo, "ThreadPool", lambda n: (asked.append(n), pool(n))[1])
    monkeypatch.setattr(mo, "HEAP_A_ROW", 1 << 50)
    train = pairs.where("role = 'train' and fold = 1")
    small = mo.fit_pipeline(train, COLS, mo.BaggedForest(n_trees=2, trees_a_bag=1, max_depth=2), "forest", scale=False)
    assert asked == [1] and small.spark_model.stages[-1].getNumTrees == 2


def test_permuted_scores_of_tree_groups(spark, pairs, forest, monkeypatch):
    """Blocks of rows meet groups of trees, none of which holds the forest."""
    test = pairs.where("role = 'val' and fold = 1")
    whole = ins.permutation_importance(forest, test, COLS, n_repeats=2).collect()
    seen, walk = [], sf.StoredForest.meet
    monkeypatch.setattr(sf, "NODES", 40)
    monkeypatch.setattr(sf, "BLOCK", 16)
    monkeypatch.setattr(sf.StoredForest, "meet", lambda self, rows, *a: (seen.append(self.nodes), walk(self, rows, *a))[1])
    cut = ins.permutation_importance(forest, test, COLS, n_repeats=2).collect()
    assert len(seen) >= 2 and min(seen) > 2 * sf.NODES
    for a, b in zip(whole, cut, strict=True):
        assert [a.feature, *a[1:]] == [b.feature, *map(pytest.approx, b[1:])]


def test_pairs_of_features_by_tree_groups(spark, pairs, forest, monkeypatch):
    """Grids of pairs add up over blocks of rows and groups of trees."""
    test = pairs.where("role = 'val'")
    whole = ins.partial_dependence(forest, test, [("a", "b")], grid_resolution=6).collect()
    monkeypatch.setattr(sf, "NODES", 40)
    monkeypatch.setattr(sf, "BLOCK", 16)
    cut = ins.partial_dependence(forest, test, [("a", "b")], grid_resolution=6)
    assert "FlatMapCoGroupsInArrow" in cut._jdf.queryExecution().optimizedPlan().toString()
    for a, b in zip(whole, cut.collect(), strict=True):
        assert [*a[:4], a.average] == [*b[:4], pytest.approx(b.average)]
