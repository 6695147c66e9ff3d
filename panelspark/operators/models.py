"""Preprocessing and model pipelines (M1-M9, M16) on Spark ML.

Fitted preprocessing parameters are aggregates computed by Spark (medians with the
distributed exact quantile, means and population deviations with one ``agg``); only the
parameters (one number per column) reach the driver. One-hot encoding and the classifiers
are Spark ML stages, so fitting and scoring run on the executors.

Parity notes (see README): imputation, scaling and one-hot encoding follow the reference's
definitions exactly; the classifiers are Spark ML's (L-BFGS / OWL-QN solvers, Spark's random
forest), so fitted coefficients and trees are close to, not equal to, the reference's.
"""

from __future__ import annotations

import math
from dataclasses import dataclass, field
from multiprocessing.pool import ThreadPool

from pyspark import SparkContext
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import (DecisionTreeClassificationModel, LinearSVC, LogisticRegression, RandomForestClassificationModel,
                                       RandomForestClassifier)
from pyspark.ml.feature import OneHotEncoder, StringIndexer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelspark.functions.ordered import exact_quantiles_multi
from panelspark.operators import metrics as me
from panelspark.operators.stored_forest import Saved
from panelspark.session import materialize

TICKER_COL = "__ticker__"
LABEL = "Target"
# The reference solvers' stopping tolerances.
TOLERANCE = 1e-4
SGD_TOLERANCE = 1e-3
ROWS_A_TASK = 100_000
TREES_A_BAG = 10
HEAP_A_ROW = 350  # bytes of the driver's heap for a row and tree of a bag that is fitted (measured: about 140 MB for 10 trees of sf0.1, at most)


# ------------------------------------------------------------------ M1-M3

def fit_medians(df: DataFrame, cols: list[str]) -> dict[str, float | None]:
    """M1 fit: interpolated median per column, nulls ignored (numpy nanmedian)."""
    q = exact_quantiles_multi(df, cols, [0.5])
    return {c: q[c][0] for c in cols}


def apply_impute(df: DataFrame, medians: dict) -> DataFrame:
    return df.withColumns({c: F.coalesce(F.col(c).cast("double"), F.lit(m if m is not None else 0.0))
                           for c, m in medians.items()})


def fit_scaler(df: DataFrame, cols: list[str]) -> dict[str, tuple[float, float]]:
    """M2 fit: mean and population std per column; a constant column scales by 1."""
    if not cols:
        return {}
    row = df.agg(*[F.avg(c).alias(f"m_{i}") for i, c in enumerate(cols)],
                 *[F.stddev_pop(c).alias(f"s_{i}") for i, c in enumerate(cols)]).collect()[0]
    out = {}
    for i, c in enumerate(cols):
        m, s = row[f"m_{i}"], row[f"s_{i}"]
        out[c] = (m if m is not None else 0.0, s if s not in (None, 0.0) else 1.0)
    return out


def apply_scale(df: DataFrame, params: dict) -> DataFrame:
    return df.withColumns({c: (F.col(c) - F.lit(m)) / F.lit(s) for c, (m, s) in params.items()})


def onehot_stages(cat_col: str = TICKER_COL) -> list:
    """M3: categories in sorted order, unseen categories -> all zeros."""
    idx = StringIndexer(inputCol=cat_col, outputCol=f"{cat_col}_idx", handleInvalid="keep",
                        stringOrderType="alphabetAsc")
    enc = OneHotEncoder(inputCols=[f"{cat_col}_idx"], outputCols=[f"{cat_col}_oh"], dropLast=True)
    return [idx, enc]


# ------------------------------------------------------------------ M4-M8

def logistic_regression(C: float, weight: float, max_iter: int = 2000):
    """M6: L2 logistic regression. C weighs the summed loss, regParam the mean one: regParam =
    1 / (C ``weight``), the number of training rows (or their summed weights)."""
    return LogisticRegression(regParam=1.0 / (C * weight), elasticNetParam=0.0, standardization=False, maxIter=max_iter, tol=TOLERANCE,
                              featuresCol="features", labelCol=LABEL)


def linear_svc(C: float, weight: float, max_iter: int = 3000):
    """M7: linear SVM (hinge) with balanced class weights; regParam = 1 / (C sum of weights)."""
    return LinearSVC(regParam=1.0 / (C * weight), standardization=False, maxIter=max_iter, tol=TOLERANCE, weightCol="_w",
                     featuresCol="features", labelCol=LABEL)


def sgd_hinge(alpha: float = 1e-4, max_iter: int = 100):
    """M8: averaged-SGD hinge objective; the same objective as ``LinearSVC(regParam=alpha)``
    (the averaging of the SGD iterates is not reproduced)."""
    return LinearSVC(regParam=alpha, standardization=False, maxIter=max_iter, tol=SGD_TOLERANCE, featuresCol="features",
                     labelCol=LABEL)


class ForestModel(RandomForestClassificationModel):
    """Spark's forest without a Python object a tree. Listing a model's parameters reads its attributes, the cached
    ``trees`` among them, which makes (and keeps) a wrapper of each tree, one thread at a time; a property is left out."""

    @property
    def trees(self) -> list[DecisionTreeClassificationModel]:
        return [DecisionTreeClassificationModel(t) for t in self._call_java("trees")]


class Forest(RandomForestClassifier):
    def _create_model(self, java_model) -> ForestModel:
        return ForestModel(java_model)


def random_forest(n_trees: int = 400, seed: int = 42, max_depth: int = 30, **kw):
    """M5: one Spark forest with balanced class weights over all rows. Spark's trees are at most 30
    levels deep; an unbounded reference depth is asked for as 30. Rows keep their node of every tree,
    so finished levels don't travel with each task."""
    if max_depth > 30:
        raise ValueError(f"max_depth {max_depth} is beyond the 30 levels of Spark's trees")
    kw = {"cacheNodeIds": True, "checkpointInterval": 10, "maxMemoryInMB": 2048, **kw}
    return Forest(numTrees=n_trees, seed=seed, maxDepth=max_depth, weightCol="_w",
                  featuresCol="features", labelCol=LABEL, **kw)


def bag_draws(bag, seed: int, keys: list[str]) -> Column:
    """How often a row is drawn into ``bag``: Poisson(1) from a seeded hash of the row's keys, so a
    row's draws don't depend on its partition."""
    u = F.pmod(F.xxhash64(F.lit(seed), bag, *keys), F.lit(1 << 30)) / F.lit(float(1 << 30))
    below, total, term = [], 0.0, math.exp(-1)
    for k in range(13):
        total += term
        below.append(total)
        term /= k + 1
    return sum(((u >= F.lit(x)).cast("double") for x in below[1:]), (u >= F.lit(below[0])).cast("double"))


def bag_class_weights(df: DataFrame, n_bags: int, seed: int, keys: list[str], label: str = LABEL) -> dict[int, dict[int, float]]:
    """Balanced class weights of every bag, n / (2 n_class) over its own draws: one grouped pass."""
    bags = F.explode(F.sequence(F.lit(0), F.lit(n_bags - 1))).alias("bag")
    drawn = df.select(*keys, label, bags).withColumn("n", bag_draws(F.col("bag"), seed, keys))
    counts: dict = {}
    for r in drawn.groupBy("bag", label).agg(F.sum("n").alias("n")).collect():  # two rows a bag
        counts.setdefault(r["bag"], {})[int(r[label])] = r["n"]
    return {b: {y: sum(c.values()) / (2 * n) if n else 0.0 for y, n in c.items()} for b, c in counts.items()}


def bags_at_once(heap: int, rows: int, trees: int, slots: int) -> int:
    """How many bags the driver's heap has room for beside each other, at most one a task slot."""
    return max(1, min(slots, heap // max(1, HEAP_A_ROW * rows * trees)))


@dataclass
class BaggedForest:
    """M5 with ``class_weight="balanced_subsample"``: rows are drawn into bags, each bag has its own class
    weights, and ``trees_a_bag`` trees grow on each (1: a bag a tree, as in the reference; they differ by
    the features tried at each node). Bags are fitted a few at a time over one cached table and written
    as they are done, so the driver holds ``parallelism`` bags at most (None: as many as its heap has room
    for); the model is a table of trees."""
    n_trees: int = 400
    seed: int = 42
    max_depth: int = 30
    trees_a_bag: int = TREES_A_BAG
    keys: tuple = (TICKER_COL, "Date")
    parallelism: int | None = None
    options: dict = field(default_factory=dict)

    def fit(self, vectors: DataFrame):
        keys = list(self.keys)
        known = vectors.select(*keys, "features", LABEL).transform(materialize)
        rows, sc = known.count(), known.sparkSession.sparkContext
        known = known.coalesce(max(1, rows // ROWS_A_TASK)).cache()
        at_once = self.parallelism or bags_at_once(sc._jvm.java.lang.Runtime.getRuntime().maxMemory(), rows, self.trees_a_bag, sc.defaultParallelism)
        sizes = [self.trees_a_bag] * (self.n_trees // self.trees_a_bag)
        sizes += [self.n_trees % self.trees_a_bag] * (self.n_trees % self.trees_a_bag > 0)
        weights = bag_class_weights(known, len(sizes), self.seed, keys)

        def grow(bag: int):
            w = weights.get(bag, {})
            by_class = F.when(F.col(LABEL) == 1, F.lit(w.get(1, 0.0))).otherwise(F.lit(w.get(0, 0.0)))
            drawn = known.withColumn("_w", bag_draws(F.lit(bag), self.seed, keys) * by_class).where("_w > 0")
            tree = {"bootstrap": False, "featureSubsetStrategy": "sqrt", **self.options}
            return saved.add(bag, random_forest(sizes[bag], self.seed + bag, self.max_depth, **tree).fit(drawn))

        saved = Saved(vectors.sparkSession, self.trees_a_bag)
        try:
            with ThreadPool(at_once) as pool:
                return saved.stored(pool.map(grow, range(len(sizes)), chunksize=1))
        finally:
            known.unpersist()


def joined_forest(models: list[RandomForestClassificationModel], first_trees: int | None = None) -> RandomForestClassificationModel:
    """One forest of all trees of several (or of the first so many), each with one vote."""
    sc = SparkContext._active_spark_context
    ml = sc._jvm.org.apache.spark.ml.classification
    trees = [t for m in models for t in m._java_obj.trees()][:first_trees]
    array = sc._gateway.new_array(ml.DecisionTreeClassificationModel, len(trees))
    for i, t in enumerate(trees):
        array[i] = t
    first = models[0]
    java = ml.RandomForestClassificationModel(f"{first.uid}_joined", array, first.numFeatures, first.numClasses)
    java.set(java.numTrees(), len(trees))
    return ForestModel(java).setFeaturesCol("features")


def balanced_weights(df: DataFrame, label: str = LABEL) -> DataFrame:
    """w = n / (2 n_class), the reference's ``class_weight="balanced"``."""
    n = df.select(F.count(F.lit(1))).scalar()
    pos = df.select(F.sum(F.col(label))).scalar()
    w = F.when(F.col(label) == 1, n / (F.lit(2.0) * pos)).otherwise(n / (F.lit(2.0) * (n - pos)))
    return df.withColumn("_w", w.cast("double"))


@dataclass
class FittedPanelModel:
    """A fitted pipeline: impute (+ scale) -> one-hot ticker -> assemble -> classifier."""
    num_cols: list[str]
    medians: dict
    scale: dict
    spark_model: PipelineModel
    kind: str
    meta: dict = field(default_factory=dict)

    def prepare(self, df: DataFrame) -> DataFrame:
        out = apply_impute(df, self.medians)
        return apply_scale(out, self.scale) if self.scale else out

    def transform(self, df: DataFrame, proba_strategy: str = "auto") -> DataFrame:
        """Adds ``score`` (margin when the model has one, else probability) and ``proba`` by the
        strategy (E1)."""
        out = self.spark_model.transform(self.prepare(df))
        margin = vector_to_array("rawPrediction")[1] if self.kind in ("svc", "logreg") else None  # [-margin, margin]
        own = vector_to_array("probability")[1] if self.kind != "svc" else None
        score, proba = me.scores_and_proba(margin, own, proba_strategy)
        return out.withColumns({"score": score + F.lit(0.0), "proba": proba})

    def feature_names(self) -> list[str]:
        """Names in the order the classifier sees them: numeric, then one-hot."""
        # handleInvalid="keep" adds an "unseen" slot which dropLast removes: one slot per label.
        labels = list(self.spark_model.stages[0].labels)
        return list(self.num_cols) + [f"{TICKER_COL}_{c}" for c in labels]


@dataclass
class Prepared:
    """Preprocessing fitted on one training set: what every classifier of a grid shares."""
    num_cols: list[str]
    medians: dict
    scale: dict
    encoder: PipelineModel
    rows: int

    def feature_names(self) -> list[str]:
        """Names in the order a classifier sees them: numeric, then one-hot."""
        return list(self.num_cols) + [f"{TICKER_COL}_{c}" for c in self.encoder.stages[0].labels]

    def vectors(self, df: DataFrame) -> DataFrame:
        out = apply_impute(df, self.medians)
        return self.encoder.transform(apply_scale(out, self.scale) if self.scale else out)


def fit_preparation(train: DataFrame, num_cols: list[str], scale: bool = True, cat_col: str = TICKER_COL) -> Prepared:
    """M1-M3 on ``train``."""
    medians = fit_medians(train, num_cols)
    prepped = apply_impute(train, medians)
    sc = fit_scaler(prepped, num_cols) if scale else {}
    stages = onehot_stages(cat_col) + [
        VectorAssembler(inputCols=list(num_cols) + [f"{cat_col}_oh"], outputCol="features", handleInvalid="keep")]
    encoder = Pipeline(stages=stages).fit(apply_scale(prepped, sc) if sc else prepped)
    return Prepared(list(num_cols), medians, sc, encoder, train.count())


def weighted(df: DataFrame, model) -> DataFrame:
    """``df`` with balanced weights, if ``model`` takes some."""
    if isinstance(model, BaggedForest):
        return df  # weighs each bag by itself
    takes = model.hasParam("weightCol") and model.isDefined("weightCol") and model.getOrDefault("weightCol") == "_w"
    return balanced_weights(df) if takes and "_w" not in df.columns else df


def fit_pipeline(train: DataFrame, num_cols: list[str], model, kind: str, scale: bool = True,
                 cat_col: str = TICKER_COL) -> FittedPanelModel:
    """M4 / M5: fit preprocessing on ``train`` and then the classifier (an estimator, or a function
    that makes it of the summed training weights, which balanced weights leave at the row count)."""
    prep = fit_preparation(train, num_cols, scale, cat_col)
    if callable(model):
        model = model(float(prep.rows))  # a factory
    fitted = model.fit(weighted(prep.vectors(train), model))
    return FittedPanelModel(prep.num_cols, prep.medians, prep.scale, PipelineModel([*prep.encoder.stages, fitted]), kind)
