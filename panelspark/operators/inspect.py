"""Feature inspection (X1-X4): names, impurity importance, permutation importance, partial
dependence. All predictions run through one ``transform`` over a stacked frame; nothing is
looped row by row on the driver."""

from __future__ import annotations

import itertools
import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelspark.functions.ordered import order_statistics_multi, row_numbers
from panelspark.operators import forest_tables as ft
from panelspark.operators import metrics as me
from panelspark.operators import models as mo
from panelspark.session import materialize

TK = mo.TICKER_COL


def feature_names(model: mo.FittedPanelModel | mo.Prepared) -> DataFrame:
    """Transformed feature names in the order the classifier sees them; the fitted preparation
    alone knows them."""
    names = model.feature_names()
    from pyspark.sql import SparkSession
    s = SparkSession.getActiveSession()
    return s.createDataFrame([(i, n) for i, n in enumerate(names)], "position int, feature string")


def impurity_importance(model: mo.FittedPanelModel, top: int = 30) -> DataFrame | None:
    """Impurity importances zipped with X1, best first, top k; None without importances."""
    clf = model.spark_model.stages[-1]
    if not hasattr(clf, "featureImportances"):
        return None
    imp = clf.featureImportances.toArray().tolist()
    names = model.feature_names()
    from pyspark.sql import SparkSession
    s = SparkSession.getActiveSession()
    df = s.createDataFrame([(n, float(v)) for n, v in zip(names, imp)], "feature string, importance double")
    return df.orderBy(F.col("importance").desc(), "feature").limit(top)


def _coprime(n: int, seed: int) -> int:
    a = (seed * 2654435761) % max(n, 1) or 1
    while math.gcd(a, n) != 1:
        a += 1
    return a


def permutation_importance(model: mo.FittedPanelModel, test: DataFrame, cols: list[str], n_repeats: int = 10,
                           seed: int = 42, scoring: str = "roc_auc", label: str = "Target") -> DataFrame:
    """Per input column, mean drop of the score over ``n_repeats`` seeded permutations.

    Rows get dense ids 0..N-1 (levelled ranking on (ticker, Date)); repeat r permutes ids by
    the bijection id -> (a_r id + b_r) mod N (gcd(a_r, N) = 1) and fetches the donor row with
    an equi-join on the permuted id. (column, repeat) variants are stacked and scored in one
    transform; metrics are computed per (column, repeat) group."""
    ids = row_numbers(test, [(TK, False), ("Date", False)], "_id").withColumn("_id", F.col("_id") - 1).transform(materialize)
    n = ids.count()
    base_sc = model.transform(ids)
    metric = me.roc_auc if scoring == "roc_auc" else me.average_precision
    key = "proba" if model.kind == "forest" else "score"
    base = metric(base_sc.select(F.col(label).alias("y"), F.col(key).alias("score"))).collect()[0][0]
    donors = ids.select(F.col("_id").alias("_pid"), *[F.col(c).alias(f"_d_{c}") for c in cols])
    ab = [(_coprime(n, seed + 7919 * rep), (seed * 31 + rep * 104729) % max(n, 1)) for rep in range(n_repeats)]
    reps = F.explode(F.array(*[F.struct(F.lit(rep).alias("r"), F.lit(a).cast("bigint").alias("a"),
                                         F.lit(b).cast("bigint").alias("b")) for rep, (a, b) in enumerate(ab)]))
    perm = (ids.select("*", reps.alias("_p"))
            .withColumns({"_rep": F.col("_p.r"), "_pid": ((F.col("_id").cast("decimal(19,0)") * F.col("_p.a").cast("decimal(18,0)") + F.col("_p.b"))
                                                                % F.lit(n)).cast("bigint")})
            .drop("_p"))
    ev = _permuted(model, perm.join(donors, "_pid"), ids, cols, label, key).transform(materialize)
    # few groups, each as large as the test set: bucketed scan instead of a per-group window
    per = metric(ev, by=["_col", "_rep"], scan="bucketed")
    val = "roc_auc" if scoring == "roc_auc" else "average_precision"
    return (per.groupBy("_col").agg((F.lit(base) - F.avg(val)).alias("importance_mean"),
                                     F.stddev_pop(F.lit(base) - F.col(val)).alias("importance_std"))
            .withColumnRenamed("_col", "feature").orderBy(F.col("importance_mean").desc(), "feature"))


def _permuted(model: mo.FittedPanelModel, joined: DataFrame, ids: DataFrame, cols: list[str], label: str, key: str) -> DataFrame:
    """``_col, _rep, y, score``: only these are written, never a variant's features. A forest scores all
    repeats of a column in one walk; other models score the variants as they are made."""
    if model.kind == "forest" and not model.scale:
        took = joined.groupBy("_id").agg(*[F.transform(F.sort_array(F.collect_list(F.struct("_rep", F.col(f"_d_{c}").alias("v")))), lambda s: s["v"]).alias(f"_d_{c}")
                                           for c in cols])  # one value a repeat
        return ft.permuted_scores(model, ids.join(took, "_id"), cols, label)
    return _permuted_copies(model, joined, cols, label, key)


def _permuted_copies(model: mo.FittedPanelModel, joined: DataFrame, cols: list[str], label: str, key: str) -> DataFrame:
    stacked = joined.withColumn("_col", F.explode(F.array(*[F.lit(c) for c in cols])))
    stacked = stacked.withColumns({c: F.when(F.col("_col") == c, F.col(f"_d_{c}")).otherwise(F.col(c)) for c in cols})
    return model.transform(stacked).select("_col", "_rep", F.col(label).alias("y"), F.col(key).alias("score"))


def _mquantiles(values_at, n: int, probs, alphap: float = 0.4, betap: float = 0.4):
    """Plotting-position quantiles (alphap = betap = 0.4) from order statistics."""
    out = []
    for p in probs:
        m = alphap + p * (1.0 - alphap - betap)
        aleph = n * p + m
        k = min(max(int(math.floor(aleph)), 1), n - 1)
        gamma = min(max(aleph - k, 0.0), 1.0)
        out.append((1.0 - gamma) * values_at(k - 1) + gamma * values_at(k))
    return out


def grid_values(data: DataFrame, features: list[str], grid_resolution: int, percentiles=(0.05, 0.95)) -> dict[str, list[float]]:
    """X4's grids: the distinct values when fewer than ``grid_resolution``, else an even grid between the
    5th and 95th plotting-position percentiles."""
    grids = {}
    distinct = {c: data.select(c).distinct().limit(grid_resolution).count() for c in features}
    for c in features:
        if distinct[c] < grid_resolution:
            grids[c] = sorted(float(r[0]) for r in data.select(c).distinct().collect() if r[0] is not None)
    need = [c for c in features if c not in grids]
    if need:
        counts = data.agg(*[F.count_if(F.col(c).isNotNull() & ~F.isnan(F.col(c).cast("double"))).alias(c) for c in need]).first().asDict()
        ranks = {}  # the order statistics that the plotting positions use
        for c in need:
            for p in percentiles:
                k = min(max(int(math.floor(counts[c] * p + 0.4 + p * 0.2)), 1), max(counts[c] - 1, 1))
                ranks.setdefault(c, []).extend([k - 1, min(k, counts[c] - 1)])
        stats = order_statistics_multi(data, need, ranks)
        for c in need:
            lo, hi = _mquantiles(lambda r, c=c: stats[c][min(r, counts[c] - 1)], counts[c], percentiles)
            grids[c] = [lo + (hi - lo) * i / (grid_resolution - 1) for i in range(grid_resolution)]
    return grids


def partial_dependence(model: mo.FittedPanelModel, data: DataFrame, features: list, grid_resolution: int = 50,
                       percentiles=(0.05, 0.95)) -> DataFrame:
    """``feature, feature2, value, value2, average``: mean predicted probability with a feature, or both of
    a pair, set to each cell of its grid. ``features`` lists names and pairs of names; feature2 and value2
    are null for single features."""
    jobs = [(f,) if isinstance(f, str) else tuple(f) for f in features]
    grids = grid_values(data, sorted({c for job in jobs for c in job}), grid_resolution, percentiles)
    spark = data.sparkSession
    cells = [(j, i, job[0], job[1] if len(job) > 1 else None, float(v[0]), float(v[1]) if len(v) > 1 else None)
             for j, job in enumerate(jobs) for i, v in enumerate(itertools.product(*[grids[c] for c in job]))]
    named = spark.createDataFrame(cells, "job int, cell int, feature string, feature2 string, value double, value2 double")
    if model.kind == "forest" and not model.scale:
        found = ft.dependence(model, data, [(job, [grids[c] for c in job]) for job in jobs])
        out = named.join(found, ["job", "cell"])
    else:
        names = sorted(grids)
        stacked = data.crossJoin(F.broadcast(named.withColumnsRenamed({c: f"_{c}" for c in named.columns})))  # the grid's cells
        at = {c: F.when(F.col("_feature") == c, F.col("_value")).when(F.col("_feature2") == c, F.col("_value2")).otherwise(F.col(c)) for c in names}
        sc = model.transform(stacked.withColumns(at))
        score = "proba" if model.kind != "svc" else "score"
        out = (sc.groupBy(*[F.col(f"_{c}").alias(c) for c in named.columns]).agg(F.avg(score).alias("average")))
    return out.select("feature", "feature2", "value", "value2", "average").orderBy("feature", "feature2", "value", "value2")
