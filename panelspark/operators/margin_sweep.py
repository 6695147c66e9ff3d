"""Every linear margin model of a nested sweep in one solver.

A model is one (outer fold, inner split, parameter); split -1 is the refit on the whole outer
training set. All of them see the same rows, so one pass over the rows serves all: a task prepares a
block for each (fold, split), multiplies it by that split's models at once, and returns the losses,
gradients and curvatures of every model, which Spark sums. The driver holds those sums alone, whose
size depends on features and models and not on rows, and takes one Newton step a model; models
that have converged drop out. A sweep takes a few dozen passes instead of a job an iteration and fit.

The loss is the hinge with its corner rounded over +-``delta``: (u + delta)^2 / (4 delta) for u = 1 - y f in that
range. ``delta`` falls to 0.01, where the objective differs from the hinge's by under 1e-4. One-hot
tickers never become columns: their block of the curvature is diagonal and is eliminated first.
"""

from __future__ import annotations

import functools
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelspark.functions.ordered import exact_quantiles_stacked
from panelspark.operators import metrics as me
from panelspark.operators import models as mo
from panelspark.session import materialize

TK, LABEL = mo.TICKER_COL, mo.LABEL
DELTAS = (1.0, 0.3, 0.1, 0.03, 0.01)
TOLERANCE = 1e-5  # a model has converged when the next step promises less than this share of its objective
PASSES = 80
ROWS_A_TASK = 20_000
REFIT = -1


@dataclass
class Preparation:
    """Imputation and scaling of one (fold, split), class weights, and the tickers it knows."""
    median: np.ndarray
    mean: np.ndarray
    std: np.ndarray
    rows: int
    weight: np.ndarray  # of labels 0 and 1

    def matrix(self, x: np.ndarray) -> np.ndarray:
        """Prepared numeric columns and a column of ones."""
        out = (np.where(np.isnan(x), self.median, x) - self.mean) / self.std
        return np.column_stack([out, np.ones(len(x))])


@dataclass
class Model:
    fold: int
    split: int
    param: float
    reg: float
    num: np.ndarray  # numeric coefficients and the intercept
    tick: np.ndarray  # one a ticker; one that the training rows don't hold stays 0
    level: int = 0  # of ``DELTAS``
    damping: float = 0.0
    at: tuple = ()  # (num, tick, objective, slope, gradient and curvature) of the last accepted point
    objective: float = float("nan")  # with the plain hinge
    converged: bool = False
    done: bool = False


def row_table(pairs: DataFrame, num_cols: list[str], tickers: list[str]) -> DataFrame:
    """``fold, inner, y, tick, x``: the pooled pairs with raw feature arrays; inner is null on the
    validation rows. ``pairs`` has an ``inner_fold`` column."""
    named = pairs.sparkSession.createDataFrame([(t, i) for i, t in enumerate(tickers)], f"{TK} string, tick int")
    x = F.array(*[F.coalesce(F.col(c).cast("double"), F.lit(float("nan"))) for c in num_cols])
    return pairs.join(F.broadcast(named), TK).select(  # one row a ticker, which the model holds anyway
        F.col("fold").cast("int").alias("fold"), F.when(F.col("role") == "train", F.col("inner_fold")).alias("inner"),
        F.col(LABEL).cast("int").alias("y"), "tick", x.alias("x"))


def preparations(table: DataFrame, n_cols: int, splits: int, balanced: bool) -> dict[tuple[int, int], Preparation]:
    """Of every (fold, split) together: one aggregate for counts and moments, one for exact medians."""
    known = table.where("inner is not null").withColumn("split", F.explode(F.array(*map(F.lit, [*range(splits), REFIT]))))
    known = known.where("split != inner")
    value = [F.when(~F.isnan(F.col("x")[i]), F.col("x")[i]) for i in range(n_cols)]
    stats = known.groupBy("fold", "split").agg(
        F.count(F.lit(1)).alias("n"), F.sum("y").cast("bigint").alias("pos"),
        *[f(v).alias(f"{name}{i}") for i, v in enumerate(value) for name, f in (("c", F.count), ("m", F.avg), ("s", F.stddev_pop))]).collect()
    key = F.concat_ws(",", F.col("fold"), F.col("split"), F.col("at"))
    stacked = known.select("fold", "split", F.posexplode("x").alias("at", "_v")).where(~F.isnan("_v")).select(key.alias("_c"), "_v")
    medians = exact_quantiles_stacked(stacked, [0.5])
    out = {}
    for r in stats:
        med, mean, std = np.zeros(n_cols), np.zeros(n_cols), np.ones(n_cols)
        for i in range(n_cols):
            c, nulls = r[f"c{i}"], r["n"] - r[f"c{i}"]
            med[i] = m = medians.get(f"{r['fold']},{r['split']},{i}", [0.0])[0]
            mean[i] = ((r[f"m{i}"] or 0.0) * c + m * nulls) / r["n"]
            var = (c * ((r[f"s{i}"] or 0.0) ** 2 + ((r[f"m{i}"] or 0.0) - mean[i]) ** 2) + nulls * (m - mean[i]) ** 2) / r["n"]
            std[i] = np.sqrt(var) if var > 0 else 1.0
        neg = r["n"] - r["pos"]
        weight = np.array([r["n"] / (2 * max(neg, 1)), r["n"] / (2 * max(r["pos"], 1))]) if balanced else np.ones(2)
        out[r["fold"], r["split"]] = Preparation(med, mean, std, r["n"], weight)
    return out


def _arrays(batch: pa.RecordBatch, n_cols: int):
    col = {n: batch.column(i) for i, n in enumerate(batch.schema.names)}
    x = col["x"].flatten().to_numpy(zero_copy_only=False).reshape(-1, n_cols)
    return (col["fold"].to_numpy(zero_copy_only=False), col["inner"].fill_null(-9).to_numpy(zero_copy_only=False),
            col["y"].to_numpy(zero_copy_only=False), col["tick"].to_numpy(zero_copy_only=False), x)


def _by_ticker(values: np.ndarray, tick: np.ndarray, n: int) -> np.ndarray:
    """Sums of rows of ``values`` by ticker; ``tick`` is sorted."""
    out = np.zeros((n, *values.shape[1:]))
    if len(tick):
        first = np.flatnonzero(np.r_[True, tick[1:] != tick[:-1]])
        out[tick[first]] = np.add.reduceat(values, first)
    return out


def block_sums(x, tick, y, prep: Preparation, models: list[Model], n_tickers: int) -> list[np.ndarray]:
    """One vector a model over a block of its training rows (sorted by ticker): the rounded and the plain
    loss, the gradient, and the curvature's parts (numeric square, tickers' diagonal, numeric x ticker)."""
    xp = prep.matrix(x)
    sign, w = 2.0 * y - 1.0, prep.weight[y]
    delta = np.array([DELTAS[m.level] for m in models])
    u = 1.0 - sign[:, None] * (xp @ np.column_stack([m.num for m in models]) + np.column_stack([m.tick for m in models])[tick])
    in_band, above = np.abs(u) <= delta, u > delta
    loss = w @ np.where(above, u, np.where(in_band, (u + delta) ** 2 / (4 * delta), 0.0))
    hinge = w @ np.maximum(u, 0.0)
    slope = -(w * sign)[:, None] * np.where(above, 1.0, np.where(in_band, (u + delta) / (2 * delta), 0.0))
    g_num, g_tick = xp.T @ slope, _by_ticker(slope, tick, n_tickers)
    out = []
    for j in range(len(models)):
        at = np.flatnonzero(in_band[:, j])
        xb, h = xp[at], w[at] / (2 * delta[j])
        xh = xb * h[:, None]
        out.append(np.concatenate([[loss[j], hinge[j]], g_num[:, j], g_tick[:, j], (xh.T @ xb).ravel(),
                                   _by_ticker(h, tick[at], n_tickers), _by_ticker(xh, tick[at], n_tickers).ravel()]))
    return out


def _sum_pass(table: DataFrame, preps: dict, open_: list[tuple[int, Model]], n_cols: int, n_tickers: int) -> dict[int, np.ndarray]:
    """The sums of every open model over all rows: one job."""
    groups: dict = {}
    for i, m in open_:
        groups.setdefault((m.fold, m.split), []).append((i, Model(m.fold, m.split, m.param, m.reg, m.num, m.tick, m.level)))
    used = {g: preps[g] for g in groups}

    def run(batches):
        total: dict[int, np.ndarray] = {}
        for b in batches:
            fold, inner, y, tick, x = _arrays(b, n_cols)
            for (k, split), some in groups.items():
                rows = np.flatnonzero((fold == k) & (inner >= 0) & (inner != split))
                rows = rows[np.argsort(tick[rows], kind="stable")]
                for (i, _), v in zip(some, block_sums(x[rows], tick[rows], y[rows], used[k, split], [m for _, m in some], n_tickers) if len(rows) else ()):
                    total[i] = total[i] + v if i in total else v
        yield _pack(total)

    def add(batches):
        total: dict[int, np.ndarray] = {}
        for b in batches:
            for i, v in zip(b.column(0).to_pylist(), b.column(1)):
                v = np.frombuffer(v.as_buffer())
                total[i] = total[i] + v if i in total else v.copy()
        yield _pack(total)

    schema = "model int, sums binary"
    parts = max(1, min(8, len(open_)))
    summed = table.mapInArrow(run, schema).repartition(parts, "model").mapInArrow(add, schema)
    return {r["model"]: np.frombuffer(bytes(r["sums"])) for r in summed.collect()}


def _pack(total: dict[int, np.ndarray]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(list(total), pa.int32()), pa.array([v.tobytes() for v in total.values()], pa.binary())],
                                      names=["model", "sums"])


def _direction(state: tuple, damping: float, q: int):
    """The damped Newton step and its slope; tickers first, for their block is diagonal."""
    g_num, g_tick, a, c, d = state
    d = d + damping
    schur = a + damping * np.eye(q) - c.T @ (c / d[:, None])
    p_num = -np.linalg.lstsq(schur, g_num - c.T @ (g_tick / d), rcond=1e-12)[0]
    p_tick = -(g_tick + c @ p_num) / d
    return p_num, p_tick, float(g_num @ p_num + g_tick @ p_tick)


def newton_step(m: Model, sums: np.ndarray, n: int, q: int, n_tickers: int) -> None:
    """Accept the last step, or go back and damp it; and set the next point to look at."""
    cuts = np.cumsum([2, q, n_tickers, q * q, n_tickers])
    (loss, hinge), g_num, g_tick, a, t, c = np.split(sums / n, cuts)
    keep = np.r_[np.ones(q - 1), 0.0]  # the intercept isn't penalised
    penalty = m.reg / 2 * ((keep * m.num) @ m.num + m.tick @ m.tick)
    value = loss + penalty
    if m.at and value > m.at[2] + 1e-4 * m.at[3]:
        m.damping = max(8 * m.damping, 1e-4)
        num, tick, value, _, state = m.at
    else:
        m.objective, m.damping = hinge + penalty, m.damping / 8 if m.damping > 1e-6 else 0.0
        a, c = a.reshape(q, q) + np.diag(m.reg * keep + 1e-9), c.reshape(n_tickers, q)
        num, tick = m.num, m.tick
        state = (g_num + m.reg * keep * num, g_tick + m.reg * tick, a, c, t + max(m.reg, 1e-9))
    p_num, p_tick, slope = _direction(state, m.damping, q)
    small = -slope <= 2 * TOLERANCE * abs(value)
    if small and m.level == len(DELTAS) - 1:
        m.num, m.tick, m.done, m.converged = num, tick, True, True
        return
    # a new loss: its first point is taken as it is
    m.level, m.at = (m.level + 1, ()) if small else (m.level, (num, tick, value, slope, state))
    m.num, m.tick = num + p_num, tick + p_tick


def solve(table: DataFrame, preps: dict, models: list[Model], n_cols: int, n_tickers: int, passes: int = PASSES) -> int:
    """Fit all models; returns the number of passes over the rows."""
    for k in range(passes):
        open_ = [(i, m) for i, m in enumerate(models) if not m.done]
        if not open_:
            return k
        for i, v in _sum_pass(table, preps, open_, n_cols, n_tickers).items():
            m = models[i]
            newton_step(m, v, preps[m.fold, m.split].rows, n_cols + 1, n_tickers)
    return passes


def margins(table: DataFrame, preps: dict, models: list[Model], n_cols: int, held_out: bool) -> DataFrame:
    """``fold, split, param, y, score``: margins on each split's left-out training rows, or with
    ``held_out`` on the fold's validation rows."""
    groups: dict = {}
    for m in models:
        groups.setdefault((m.fold, m.split), []).append(m)
    params = {g: np.array([m.param for m in some]) for g, some in groups.items()}
    num = {g: np.column_stack([m.num for m in some]) for g, some in groups.items()}
    tick_ = {g: np.column_stack([m.tick for m in some]) for g, some in groups.items()}
    used = {g: preps[g] for g in groups}

    def run(batches):
        for b in batches:
            fold, inner, y, tick, x = _arrays(b, n_cols)
            for (k, split), p in params.items():
                rows = np.flatnonzero((fold == k) & ((inner == -9) if held_out else (inner == split)))
                if len(rows):
                    f = used[k, split].matrix(x[rows]) @ num[k, split] + tick_[k, split][tick[rows]]
                    n = len(p)
                    yield pa.RecordBatch.from_arrays([
                        pa.array(np.full(f.size, k), pa.int32()), pa.array(np.full(f.size, split), pa.int32()), pa.array(np.tile(p, len(rows))),
                        pa.array(np.repeat(y[rows], n), pa.int32()), pa.array(f.ravel() + 0.0)], names=["fold", "split", "param", "y", "score"])

    return table.mapInArrow(run, "fold int, split int, param double, y int, score double")


def fit_all(split_pairs: DataFrame, num_cols: list[str], grid: list[float], reg, balanced: bool, splits: int):
    """Row table, preparations and fitted models of every (fold, split, parameter). ``reg`` maps a
    parameter and the summed training weights to the penalty of the mean loss."""
    tickers = [r[0] for r in split_pairs.select(TK).distinct().orderBy(TK).collect()]
    table = row_table(split_pairs, num_cols, tickers)
    table = materialize(table.repartition(max(1, split_pairs.count() // ROWS_A_TASK)))
    q, t = len(num_cols) + 1, len(tickers)
    preps = preparations(table, len(num_cols), splits, balanced)
    models = [Model(k, s, float(p), reg(float(p), float(pr.rows)), np.zeros(q), np.zeros(t)) for (k, s), pr in sorted(preps.items()) for p in grid]
    solve(table, preps, models, len(num_cols), t)
    return table, preps, models


def sweep(split_pairs: DataFrame, num_cols: list[str], grid: list[float], reg, balanced: bool, splits: int = 3) -> tuple[DataFrame, DataFrame, float]:
    """M11 over ``split_pairs`` (pooled pairs with ``inner_fold``): a strictly larger mean inner AUC wins, the
    first in grid order on ties; the winner's refit is scored on the outer validation rows; the final
    parameter is the median of the winners. Returns (inner, outer, final); outer has the share of the
    fold's models that converged."""
    spark = split_pairs.sparkSession
    table, preps, models = fit_all(split_pairs, num_cols, grid, reg, balanced, splits)
    inner = margins(table, preps, [m for m in models if m.split != REFIT], len(num_cols), False).transform(materialize)
    aucs = {(r["fold"], r["split"], r["param"]): r["roc_auc"] for r in me.roc_auc(inner, by=["fold", "split", "param"], scan="bucketed").collect()}
    chosen, inner_rows, outer_rows = {}, [], []
    for k in sorted({m.fold for m in models}):
        best = None
        for p in map(float, grid):
            scores = [aucs.get((k, s, p)) for s in range(splits)]
            inner_rows += [(k, s, p, x) for s, x in enumerate(scores)]
            if None not in scores and (best is None or sum(scores) / splits > best[0]):
                best = (sum(scores) / splits, p)
        if best:
            chosen[k] = best
    winners = [m for m in models if m.split == REFIT and m.fold in chosen and m.param == chosen[m.fold][1]]
    val = margins(table, preps, winners, len(num_cols), True).transform(materialize)
    val_auc = {r["fold"]: r["roc_auc"] for r in me.roc_auc(val, by=["fold"], scan="bucketed").collect()}
    right = F.avg(((F.col("score") >= 0).cast("int") == F.col("y")).cast("double"))
    for r in val.groupBy("fold").agg(right.alias("acc"), F.count(F.lit(1)).alias("n")).orderBy("fold").collect():
        k = r["fold"]
        own = [m.converged for m in models if m.fold == k]
        outer_rows.append((k, chosen[k][1], float(chosen[k][0]), val_auc.get(k), r["acc"], r["n"], sum(own) / len(own)))
    ordered = sorted(p for _, p in chosen.values())
    final = (ordered[(len(ordered) - 1) // 2] + ordered[len(ordered) // 2]) / 2 if ordered else float("nan")
    return (spark.createDataFrame(inner_rows, "outer_fold int, inner_split int, param double, metric double"),
            spark.createDataFrame(outer_rows, "fold int, param double, inner_mean_metric double, val_auc double, val_accuracy double, "
                                              "n_val bigint, converged double"), final)


def svc_penalty(c: float, weight: float) -> float:
    """C weighs the summed loss."""
    return 1.0 / (c * weight)


def sgd_penalty(alpha: float, weight: float) -> float:
    return alpha


svc_sweep = functools.partial(sweep, reg=svc_penalty, balanced=True)
sgd_sweep = functools.partial(sweep, reg=sgd_penalty, balanced=False)
