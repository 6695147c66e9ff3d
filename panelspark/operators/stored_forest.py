"""A fitted forest as a table in the shared folder, a row a tree.

The driver never holds the forest: it grows with trees and training rows. A job over it brings blocks of
rows and groups of trees together, each pair of them in one task group, so a task holds at most about
``NODES`` nodes (or one tree) and ``BLOCK`` rows, and what it sends is summed by Spark.
"""

from __future__ import annotations

import gc
import threading
import uuid
from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml import Transformer
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.linalg import DenseVector
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from panelspark.session import materialize, scratch_path

NODES = 1_000_000  # nodes of a group of trees, 28 bytes each
BLOCK = 1024  # rows of a block, on average
TASKS = 10_000
ID = "_forest_row"
ARRAYS = {"feature": np.int32, "threshold": np.float64, "left": np.int32, "right": np.int32, "vote": np.float64}
TREE_ROW = "at int, nodes int, " + ", ".join(f"{c} binary" for c in ARRAYS)


@dataclass
class Tree:
    feature: np.ndarray  # -1: leaf
    threshold: np.ndarray  # a value up to it goes left
    left: np.ndarray
    right: np.ndarray
    vote: np.ndarray  # share of class 1


def _tree_row(t: pa.Table) -> pa.Table:
    """The arrays of one tree from its saved nodes."""
    t = t.sort_by("id")
    c = {n: t.column(n).to_numpy() for n in t.column_names}
    if (c["categories"] > 2).any():
        raise ValueError("features of more than two categories aren't supported")
    left, right, leaf = c["left"].astype(np.int32), c["right"].astype(np.int32), c["left"] < 0
    # of two categories the split names those that go left
    binary = c["categories"] == 2
    swap = binary & (c["first"] == 1.0) & (c["n_left"] == 1)
    out = {"feature": np.where(leaf, -1, c["feature"]), "threshold": np.where(binary, np.where(c["n_left"] == 2, np.inf, 0.5), c["first"].astype(np.float64)),
           "left": np.where(swap, right, left), "right": np.where(swap, left, right), "vote": c["vote"]}
    return pa.table({"at": pa.array([c["at"][0]], pa.int32()), "nodes": pa.array([len(leaf)], pa.int32()),
                     **{n: pa.array([out[n].astype(d).tobytes()], pa.binary()) for n, d in ARRAYS.items()}})


def tree_of(row) -> Tree:
    return Tree(*(np.frombuffer(row[n], dtype=d) for n, d in ARRAYS.items()))


class Saved:
    """Parts of a forest saved by Spark one by one, then read as one table of trees. Of the parts
    the driver keeps the summed importances alone."""

    def __init__(self, spark: SparkSession, trees_a_part: int):
        self.spark, self.trees_a_part = spark, trees_a_part
        self.one = threading.Lock()  # a part is serialised whole, so one at a time
        self.root = scratch_path(spark, f"forest-{uuid.uuid4().hex[:12]}")

    def add(self, part: int, model) -> tuple[int, np.ndarray]:
        """Number of trees and the part's importances. The JVM keeps what Python's handles name, and a handle
        is in a cycle with its methods: they are collected here, so that no writer holds a saved part."""
        with self.one:
            model.write().save(f"{self.root}/part={part}")
            found = model.getNumTrees, model.featureImportances.toArray()
            gc.collect()
        return found

    def stored(self, parts: list[tuple[int, np.ndarray]]) -> StoredForest:
        n, s = "nodeData", "nodeData.split"
        saved = self.spark.read.option("basePath", self.root).parquet(*[f"{self.root}/part={i}/data" for i in range(len(parts))])
        nodes = saved.select(
            (F.col("part") * self.trees_a_part + F.col("treeID")).cast("int").alias("at"), F.col(f"{n}.id").alias("id"),
            F.col(f"{n}.leftChild").alias("left"), F.col(f"{n}.rightChild").alias("right"),
            F.coalesce(f"{s}.featureIndex", F.lit(-1)).alias("feature"), F.coalesce(f"{s}.numCategories", F.lit(-1)).alias("categories"),
            F.coalesce(F.get(F.col(f"{s}.leftCategoriesOrThreshold"), 0), F.lit(0.0)).alias("first"),
            F.coalesce(F.size(f"{s}.leftCategoriesOrThreshold"), F.lit(0)).alias("n_left"),
            (F.get(f"{n}.impurityStats", 1) / F.aggregate(f"{n}.impurityStats", F.lit(0.0), lambda a, b: a + b)).alias("vote"))
        trees = materialize(nodes.groupBy("at").applyInArrow(_tree_row, TREE_ROW))
        of = (F.col("at") / self.trees_a_part).cast("int")
        split = {r[0]: r[1] for r in trees.groupBy(of).agg(F.count_if(F.col("nodes") > 1)).collect()}  # a row a part
        summed = sum(p[1] * split[i] for i, p in enumerate(parts))  # a part's are the mean of its trees with a split
        total = summed.sum()
        return StoredForest(trees, sum(p[0] for p in parts), trees.agg(F.sum("nodes")).first()[0], summed / total if total > 0 else summed)


def store(model) -> StoredForest:
    """A forest that Spark fitted, as a table."""
    if isinstance(model, StoredForest):
        return model
    saved = Saved(SparkSession.getActiveSession(), model.getNumTrees)
    return saved.stored([saved.add(0, model)])


def matrix(column, n: int) -> np.ndarray:
    """A column of equally long arrays as rows of a matrix."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return column.flatten().to_numpy(zero_copy_only=False).reshape(n, -1)


def votes(tree: Tree, x: np.ndarray) -> np.ndarray:
    """The share of class 1 in the leaf of each row."""
    node = np.zeros(len(x), np.int32)
    at = np.flatnonzero(tree.feature[node] >= 0)
    while len(at):
        k = node[at]
        node[at] = np.where(x[at, tree.feature[k]] <= tree.threshold[k], tree.left[k], tree.right[k])
        at = at[tree.feature[node[at]] >= 0]
    return tree.vote[node]


class StoredForest(Transformer):
    """Scores as Spark's forest does: the mean of the trees' class shares."""

    def __init__(self, trees: DataFrame, n_trees: int, nodes: int, importances: np.ndarray):
        super().__init__()
        self.trees, self.getNumTrees, self.nodes, self.featureImportances = trees, n_trees, nodes, DenseVector(importances)

    def meet(self, rows: DataFrame, work: Callable[[list[Tree], pa.Table, int, int], pa.Table], schema: str) -> DataFrame:
        """``work(trees, rows, block, group)`` of each group of trees and block of ``rows``, which have an ``ID``."""
        blocks, groups = max(1, -(-rows.count() // BLOCK)), min(self.getNumTrees, -(-self.nodes // NODES))
        upto = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
        left = rows.withColumn("_block", F.pmod(F.xxhash64(ID), F.lit(blocks)).cast("int")).withColumn("_group", upto(groups))
        right = self.trees.withColumn("_group", (F.col("at") % groups).cast("int")).withColumn("_block", upto(blocks))

        def run(key, some: pa.Table, grown: pa.Table) -> pa.Table:
            trees = [tree_of(r) for r in grown.sort_by("at").select(list(ARRAYS)).to_pylist()]
            return work(trees, some.sort_by(ID), key[0].as_py(), key[1].as_py())

        met = [d.repartition(min(blocks * groups, TASKS), "_block", "_group").groupBy("_block", "_group") for d in (left, right)]
        return met[0].cogroup(met[1]).applyInArrow(run, schema)

    def summed(self, rows: DataFrame, values: Callable[[list[Tree], pa.Table], np.ndarray], out: Callable[[np.ndarray, np.ndarray], pa.Table],
               schema: str) -> DataFrame:
        """``out(ids, sums)`` of each block of rows: ``values`` (a row of numbers a row), summed over the groups of trees."""

        def work(trees, some, block, group):
            if not some.num_rows:
                return pa.table({"block": pa.array([], pa.int32()), "grp": pa.array([], pa.int32()), "ids": pa.array([], pa.binary()), "sums": pa.array([], pa.binary())})
            return pa.table({"block": pa.array([block], pa.int32()), "grp": pa.array([group], pa.int32()), "ids": pa.array([some.column(ID).to_numpy().tobytes()], pa.binary()),
                             "sums": pa.array([np.ascontiguousarray(values(trees, some)).tobytes()], pa.binary())})

        def add(t: pa.Table) -> pa.Table:
            t = t.sort_by("grp")  # one order of adding, so that rows alike stay alike
            ids = np.frombuffer(t.column("ids")[0].as_py(), np.int64)
            return out(ids, sum(np.frombuffer(s.as_py(), np.float64) for s in t.column("sums")).reshape(len(ids), -1))

        return self.meet(rows, work, "block int, grp int, ids binary, sums binary").groupBy("block").applyInArrow(add, schema)

    def _transform(self, dataset: DataFrame) -> DataFrame:
        rows = materialize(dataset.withColumn(ID, F.monotonically_increasing_id()))
        found = self.summed(
            rows.select(ID, vector_to_array("features").alias("x")),
            lambda trees, some: sum(votes(t, x) for x in [matrix(some.column("x"), some.num_rows)] for t in trees),
            lambda ids, sums: pa.table({"_of": ids, "_sum": sums[:, 0]}), "_of bigint, _sum double")
        n, p = float(self.getNumTrees), F.col("_sum") / F.lit(float(self.getNumTrees))
        both = rows.join(found, F.col(ID) == F.col("_of")).withColumns({
            "rawPrediction": array_to_vector(F.array(F.lit(n) - F.col("_sum"), F.col("_sum"))), "probability": array_to_vector(F.array(1.0 - p, p)),
            "prediction": (p > 0.5).cast("double")})
        return both.drop(ID, "_of", "_sum")
