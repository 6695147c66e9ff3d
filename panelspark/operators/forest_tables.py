"""A fitted forest as arrays, for scoring many variants of a row at once.

Setting one feature to each of g values doesn't need g walks through a tree: the values that a row is
tried with travel together as a range of the sorted values, and split only where the tree asks for
that feature. At a leaf the whole range gets the leaf's vote. A task holds a group of trees and a block
of rows (``stored_forest``); grids come back as sums.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelspark.operators import models as mo
from panelspark.operators.stored_forest import ARRAYS, ID, Tree, matrix, store, tree_of
from panelspark.session import materialize

ROWS = 4096  # rows that walk a tree together


def tables(model, spark) -> list[Tree]:
    """The trees of a small forest."""
    return [tree_of(r) for r in store(model).trees.orderBy("at").select(*ARRAYS).toLocalIterator()]


def ranged_votes(tree: Tree, x: np.ndarray, swaps: list[tuple[int, np.ndarray]]):
    """Walk ``x`` through a tree with some features replaced. ``swaps`` lists (feature, sorted values): one
    row of values for all rows, or a row of values each. Yields (rows, low and high of each
    swap's range, votes) of the leaves met."""
    n = len(x)
    rows, node = np.arange(n), np.zeros(n, dtype=np.int32)
    spans = [[np.zeros(n, np.int32), np.full(n, v.shape[-1], np.int32)] for _, v in swaps]
    while len(rows):
        f = tree.feature[node]
        end = f < 0
        if end.any():
            yield rows[end], [(lo[end], hi[end]) for lo, hi in spans], tree.vote[node[end]]
            rows, node, f = rows[~end], node[~end], f[~end]
            spans = [[lo[~end], hi[~end]] for lo, hi in spans]
            if not len(rows):
                return
        threshold = tree.threshold[node]
        nxt = np.where(x[rows, f] <= threshold, tree.left[node], tree.right[node])
        extra = []
        for k, (feature, values) in enumerate(swaps):
            at = np.flatnonzero(f == feature)
            if not len(at):
                continue
            lo, hi = spans[k][0][at], spans[k][1][at]
            if values.ndim == 1:
                cut = np.searchsorted(values, threshold[at], side="right")
            else:
                cut = (values[rows[at]] <= threshold[at][:, None]).sum(axis=1)
            cut = np.clip(cut, lo, hi).astype(np.int32)
            goes_left = cut > lo
            nxt[at] = np.where(goes_left, tree.left[node[at]], tree.right[node[at]])
            both = goes_left & (cut < hi)
            spans[k][1][at] = np.where(goes_left, cut, hi)
            if both.any():  # the upper part of the range goes right
                b = at[both]
                part = [[lo_[b].copy(), hi_[b].copy()] for lo_, hi_ in spans]
                part[k] = [cut[both], hi[both]]
                extra.append((rows[b], tree.right[node[b]], part))
        node = nxt
        if extra:
            rows = np.concatenate([rows, *[e[0] for e in extra]])
            node = np.concatenate([node, *[e[1] for e in extra]])
            spans = [[np.concatenate([spans[k][i], *[e[2][k][i] for e in extra]]) for i in (0, 1)] for k in range(len(swaps))]


def grid_sums(trees: list[Tree], x: np.ndarray, features: list[int], grids: list[np.ndarray]) -> np.ndarray:
    """Sum over rows of the forest's probability in each cell of the grids' product."""
    shape = [len(g) + 1 for g in grids]
    steps = np.zeros(int(np.prod(shape)))
    swaps = list(zip(features, grids))
    for tree in trees:
        for _, spans, vote in ranged_votes(tree, x, swaps):
            for corner in range(2 ** len(swaps)):  # differences at the corners of each range
                at = np.zeros(len(vote), dtype=np.int64)
                for k, (lo, hi) in enumerate(spans):
                    at = at * shape[k] + (hi if corner >> k & 1 else lo)
                steps += np.bincount(at, weights=vote * (-1) ** corner.bit_count(), minlength=len(steps))
    out = steps.reshape(shape)
    for axis in range(len(swaps)):
        out = out.cumsum(axis=axis)
    return out[tuple(slice(0, len(g)) for g in grids)] / len(trees)


def single_swaps(tree: Tree, x: np.ndarray, place: np.ndarray, size: np.ndarray, cuts):
    """Walk ``x`` through a tree once for all features that are replaced one at a time. ``place`` numbers
    the replaced features (-1: not replaced), ``size`` gives how many sorted values each is tried with, and
    ``cuts(nodes, rows, ks)`` how many of feature k's values go left at a node.

    Each row walks once as it is, and a second walker leaves it where its path first asks for a replaced
    feature. Returns the rows' own votes, which (row, k) were met, and the (row, k, low, high, vote) of the
    other walkers' leaves; a feature that a path never asks for keeps the row's own vote."""
    n = len(x)
    own, met = np.empty(n), np.zeros((n, len(size)), dtype=bool)
    row, node, k = np.arange(n), np.zeros(n, np.int32), np.full(n, -1, np.int32)
    lo, hi = np.zeros(n, np.int32), np.zeros(n, np.int32)
    leaves = []
    while len(row):
        f = tree.feature[node]
        end = f < 0
        if end.any():
            base, moved = end & (k < 0), end & (k >= 0)
            own[row[base]] = tree.vote[node[base]]
            leaves.append((row[moved], k[moved], lo[moved], hi[moved], tree.vote[node[moved]]))
            row, node, k, lo, hi, f = (a[~end] for a in (row, node, k, lo, hi, f))
        asks = place[f]
        new = np.flatnonzero((k < 0) & (asks >= 0))
        new = new[~met[row[new], asks[new]]]
        if len(new):
            met[row[new], asks[new]] = True
            first = np.zeros(len(new), np.int32)
            row, node, f, k = (np.concatenate([a, a_[new]]) for a, a_ in ((row, row), (node, node), (f, f), (k, asks)))
            lo, hi, asks = np.concatenate([lo, first]), np.concatenate([hi, size[asks[new]]]), np.concatenate([asks, asks[new]])
        nxt = np.where(x[row, f] <= tree.threshold[node], tree.left[node], tree.right[node])
        at = np.flatnonzero((k >= 0) & (asks == k))
        if len(at):
            low, high = lo[at], hi[at]
            cut = np.clip(cuts(node[at], row[at], k[at]), low, high).astype(np.int32)
            goes_left = cut > low
            nxt[at] = np.where(goes_left, tree.left[node[at]], tree.right[node[at]])
            hi[at] = np.where(goes_left, cut, high)
            both = goes_left & (cut < high)  # the upper part of the range goes right
            b = at[both]
            row, k = np.concatenate([row, row[b]]), np.concatenate([k, k[b]])
            nxt = np.concatenate([nxt, tree.right[node[b]]])
            lo, hi = np.concatenate([lo, cut[both]]), np.concatenate([hi, high[both]])
        node = nxt
    return own, met, [np.concatenate(c) for c in zip(*leaves)]


def _places(features: list[int], n_features: int) -> np.ndarray:
    place = np.full(n_features, -1, np.int32)
    place[features] = np.arange(len(features))
    return place


def single_grid_sums(trees: list[Tree], x: np.ndarray, features: list[int], grids: list[np.ndarray]) -> list[np.ndarray]:
    """``grid_sums`` of several single features, all in one walk a tree."""
    place, size = _places(features, x.shape[1]), np.array([len(g) for g in grids], np.int32)
    width = int(size.max(initial=0)) + 1
    steps = np.zeros(len(features) * width)
    for tree in trees:
        cut = np.zeros(len(tree.feature), np.int32)
        for f, g in zip(features, grids):
            of = np.flatnonzero(tree.feature == f)
            cut[of] = np.searchsorted(g, tree.threshold[of], side="right")
        own, met, (_, k, lo, hi, vote) = single_swaps(tree, x, place, size, lambda nodes, rows, ks, cut=cut: cut[nodes])
        steps += np.bincount(k * width + lo, vote, len(steps)) - np.bincount(k * width + hi, vote, len(steps))
        steps[::width] += (~met).T @ own
    sums = steps.reshape(-1, width).cumsum(axis=1) / len(trees)
    return [s[:n] for s, n in zip(sums, size)]


def swapped_scores(trees: list[Tree], x: np.ndarray, features: list[int], donors: np.ndarray) -> np.ndarray:
    """Probabilities of each row with each of ``features`` replaced by each of its donors (rows x features
    x donors), one feature at a time."""
    order = np.argsort(donors, axis=2, kind="stable")
    values = np.take_along_axis(donors, order, axis=2)
    n, m, g = donors.shape
    place, size = _places(features, x.shape[1]), np.full(m, g, np.int32)
    steps = np.zeros((n, m, g + 1))
    flat = steps.reshape(-1)
    for tree in trees:
        own, met, (row, k, lo, hi, vote) = single_swaps(
            tree, x, place, size, lambda nodes, rows, ks, tree=tree: (values[rows, ks] <= tree.threshold[nodes][:, None]).sum(axis=1))
        at = (row * m + k) * (g + 1)
        np.add.at(flat, at + lo, vote)
        np.subtract.at(flat, at + hi, vote)
        steps[:, :, 0] += np.where(met, 0.0, own[:, None])
    ranked = steps.cumsum(axis=2)[:, :, :g] / len(trees)
    out = np.empty_like(ranked)
    np.put_along_axis(out, order, ranked, axis=2)
    return out


def feature_rows(model: mo.FittedPanelModel, data: DataFrame, *extra) -> DataFrame:
    """``x`` (the features the trees see) and ``extra`` columns, spread over as many tasks as a shuffle."""
    prepared = data.sparkSession.conf.get("spark.sql.shuffle.partitions")
    out = model.prepare(data)
    for stage in model.spark_model.stages[:-1]:
        out = stage.transform(out)
    return out.select(vector_to_array("features").alias("x"), *extra).repartition(int(prepared))


def dependence(model: mo.FittedPanelModel, data: DataFrame, jobs: list[tuple[tuple[str, ...], list[list[float]]]]) -> DataFrame:
    """``job, cell, average``: for each (features, grids) the mean probability in each cell of the grids'
    product, cells numbered row by row. A block of rows and a group of trees send one sum a cell."""
    plans = [([model.num_cols.index(c) for c in names], [np.array(g) for g in grids]) for names, grids in jobs]

    first = {features[0]: j for j, (features, _) in reversed(list(enumerate(plans))) if len(features) == 1}
    singles = sorted(first.values())  # a feature's first job; its others walk on their own

    def work(trees, rows, block, group):
        total = [np.zeros(int(np.prod([len(g) for g in grids]))) for _, grids in plans]
        x = matrix(rows.column("x"), rows.num_rows) if rows.num_rows else np.zeros((0, 0))
        for lo in range(0, len(x), ROWS):
            part = x[lo : lo + ROWS]
            sums = dict(zip(singles, single_grid_sums(trees, part, [plans[j][0][0] for j in singles], [plans[j][1][0] for j in singles])))
            for j, (features, grids) in enumerate(plans):
                total[j] += (sums[j] if j in sums else grid_sums(trees, part, features, grids).ravel()) * len(trees)
        size = [len(t) for t in total] if len(x) else []
        return pa.table({"job": pa.array(np.repeat(np.arange(len(size)), size), pa.int32()), "cell": pa.array(np.concatenate([np.arange(n) for n in size] or [[]]), pa.int32()),
                         "s": pa.array(np.concatenate(total if size else [[]]), pa.float64()), "n": pa.array(np.full(sum(size), len(x) * len(trees)), pa.int64())})

    rows = materialize(feature_rows(model, data, F.monotonically_increasing_id().alias(ID)))
    sums = store(model.spark_model.stages[-1]).meet(rows, work, "job int, cell int, s double, n bigint")
    return sums.groupBy("job", "cell").agg((F.sum("s") / F.sum("n")).alias("average"))


def permuted_scores(model: mo.FittedPanelModel, rows: DataFrame, cols: list[str], label: str) -> DataFrame:
    """``_col, _rep, y, score`` of rows that carry ``_d_`` columns: an array a column of the values each repeat
    puts in, and an ``_id``. Imputation happens to donors as to the columns."""
    place = [model.num_cols.index(c) for c in cols]
    medians = [model.medians[c] if model.medians[c] is not None else 0.0 for c in cols]

    def imputed(c: str, m: float):
        return F.transform(f"_d_{c}", lambda v: F.coalesce(v.cast("double"), F.lit(m)))  # a second argument would be the index

    donors = F.flatten(F.array(*[imputed(c, m) for c, m in zip(cols, medians)]))

    def values(trees, some):
        x, d = matrix(some.column("x"), some.num_rows), matrix(some.column("d"), some.num_rows).reshape(some.num_rows, len(cols), -1)
        parts = [swapped_scores(trees, x[lo : lo + ROWS], place, d[lo : lo + ROWS]) for lo in range(0, len(x), ROWS)]
        return np.concatenate(parts).reshape(len(x), -1) * len(trees)

    def out(ids, sums):
        n, reps = len(ids), sums.shape[1] // len(cols)
        col = pa.DictionaryArray.from_arrays(pa.array(np.tile(np.repeat(np.arange(len(cols)), reps), n), pa.int32()), pa.array(cols)).cast(pa.string())
        return pa.table({"_row": pa.array(np.repeat(ids, sums.shape[1])), "_col": col, "_rep": pa.array(np.tile(np.arange(reps), n * len(cols)), pa.int32()),
                         "score": pa.array(sums.ravel() / n_trees)})

    forest = store(model.spark_model.stages[-1])
    n_trees = forest.getNumTrees
    known = materialize(feature_rows(model, rows, donors.alias("d"), F.col(label).cast("int").alias("y"), F.col("_id").cast("bigint").alias(ID)))
    scores = forest.summed(known.select(ID, "x", "d"), values, out, "_row bigint, _col string, _rep int, score double")
    return scores.join(known.select(F.col(ID).alias("_row"), "y"), "_row").select("_col", "_rep", "y", "score")
