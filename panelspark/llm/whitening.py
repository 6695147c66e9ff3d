"""Whitening of embeddings (operator 12) by the polarisation identity, in exact integers.

Entries become integers x = floor(64 c) + 1,000,000. With n distinct vectors and their sums S, the
centred entry n x - S is an integer too. Two numbers' product follows from squares alone:
2 a b = (a + b)^2 - a^2 - b^2. So the tasks aggregate nothing but squares of centred values, one sum for
each dimension and one for each sum of two dimensions; the differences give every cross-covariance
without rounding, and only their quotients by 2 n^3 become doubles, for ``numpy.linalg.eigh``.

Squares are summed exactly: a value is cut into limbs of 24 bits, the limbs' products are summed in
64 bits a few thousand rows at a time, and joined to whole numbers that Spark adds up as decimals.
The driver holds dimensions x dimensions numbers, whatever the number of rows.
"""

from __future__ import annotations

from decimal import Decimal
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelspark.llm.common import ids, lean, materialize

SCALE = 64
SHIFT = 1_000_000
COMPONENTS = 16
LIMB = 24
BLOCK = 1 << 13  # rows whose limb products are summed in 64 bits: 2**13 * 2**48 < 2**63
WHOLE = pa.decimal128(38, 0)


def as_integers(vectors: DataFrame, id_column: str, vector: str) -> DataFrame:
    """``id, x``: rows whose vector is there, of the commonest length (ties: the longer) and free of null
    and non-finite entries, with its integers."""
    v = vectors.select(F.col(id_column).alias("id"), F.col(vector).cast("array<double>").alias("v")).where(
        F.col("v").isNotNull() & F.forall("v", lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < F.lit(float("inf")))))
    length = v.groupBy(F.size("v").alias("d")).count().orderBy(F.desc("count"), F.desc("d")).first()
    d = length["d"] if length else 0
    return v.where(F.size("v") == d).select("id", F.transform("v", lambda c: F.floor(c * SCALE) + F.lit(SHIFT)).alias("x")), d


def _matrix(column: pa.Array, d: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(-1, d)


def _blocks(batches, d: int, column: str = "x"):
    for b in batches:
        x = _matrix(ids(b, column), d)
        for lo in range(0, len(x), BLOCK):
            yield x[lo : lo + BLOCK]


def _cells(keys: list[np.ndarray], sums: list[int]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([*(pa.array(k, pa.int32()) for k in keys), pa.array([Decimal(s) for s in sums], WHOLE)],
                                      names=["i", "j", "s"])


def exact_sums(z: np.ndarray) -> list[int]:
    """Column sums of the squares of int64 values (at most ``BLOCK`` rows), exactly."""
    a = np.abs(z).astype(np.uint64)
    limbs = []
    while a.any():
        limbs.append((a & np.uint64((1 << LIMB) - 1)).astype(np.int64))
        a >>= np.uint64(LIMB)
    total = [0] * z.shape[1]
    for p, u in enumerate(limbs):
        for q in range(p, len(limbs)):
            part = np.einsum("ij,ij->j", u, limbs[q]).tolist()
            shift = LIMB * (p + q) + (p != q)
            total = [t + (v << shift) for t, v in zip(total, part)]
    return total


def sums(fit: DataFrame, d: int) -> tuple[int, list[int]]:
    """Number of vectors and each dimension's sum."""

    def run(batches):
        total, n = [0] * d, 0
        for x in _blocks(batches, d):
            n += len(x)  # 2**13 values below 2**50 add up below 2**63; larger ones as Python integers
            part = x.sum(axis=0).tolist() if np.abs(x).max(initial=0) < 1 << 50 else x.astype(object).sum(axis=0).tolist()
            total = [t + s for t, s in zip(total, part)]
        yield _cells([np.arange(d + 1), np.full(d + 1, -1)], [*total, n])

    got = {r["i"]: int(r["s"]) for r in fit.mapInArrow(lean(run), "i int, j int, s decimal(38,0)")
           .groupBy("i").agg(F.sum("s").alias("s")).collect()}  # d + 1 rows
    return got.get(d, 0), [got.get(i, 0) for i in range(d)]


def centred(x: np.ndarray, n: int, s: list[int]) -> np.ndarray:
    """n x - S in int64; an error where that doesn't fit (it would need 2**62 / |x| vectors)."""
    if x.size and n * max(abs(int(x.max())), abs(int(x.min()))) + max(map(abs, s)) >= 1 << 62:
        raise OverflowError("n * x - S is beyond 62 bits")
    return n * x - np.array(s, dtype=np.int64)


def squares(fit: DataFrame, n: int, s: list[int]) -> tuple[list[int], dict[tuple[int, int], int]]:
    """Sums over all vectors of squared centred values: of each dimension i, and of each i + j."""
    d = len(s)
    a, b = np.triu_indices(d, 1)

    def run(batches):
        own, pairs = [0] * d, [0] * len(a)
        for x in _blocks(batches, d):
            y = centred(x, n, s)
            own = [t + v for t, v in zip(own, exact_sums(y))]
            for i in range(d - 1):  # the pairs (i, i + 1), (i, i + 2), .. stand in one run
                lo = i * d - i * (i + 1) // 2
                for k, v in enumerate(exact_sums(y[:, i + 1 :] + y[:, i : i + 1]), lo):
                    pairs[k] += v
        yield _cells([np.concatenate([np.arange(d), a]), np.concatenate([np.arange(d), b])], own + pairs)

    rows = (fit.mapInArrow(lean(run), "i int, j int, s decimal(38,0)").groupBy("i", "j").agg(F.sum("s").alias("s")).collect())
    got = {(r["i"], r["j"]): int(r["s"]) for r in rows}  # d (d + 1) / 2 rows
    return [got[i, i] for i in range(d)], {k: v for k, v in got.items() if k[0] != k[1]}


def covariance(n: int, own: list[int], pairs: dict[tuple[int, int], int]) -> np.ndarray:
    """V: each entry one exact integer over 2 n**3, rounded once."""
    v = np.empty((len(own), len(own)))
    for i, q in enumerate(own):
        v[i, i] = float(Fraction(q, n**3))
    for (i, j), q in pairs.items():
        v[i, j] = v[j, i] = float(Fraction(q - own[i] - own[j], 2 * n**3))
    return v


def components(v: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The k largest eigenvalues that aren't zero to double precision, falling, and their unit
    eigenvectors as rows; each one's largest entry is positive."""
    e, u = np.linalg.eigh(v)
    e, u = e[::-1], u[:, ::-1].T
    keep = int((e > max(e[0], 0) * len(e) * np.finfo(float).eps).sum())
    e, u = e[: min(k, keep)], u[: min(k, keep)]
    sign = np.sign(u[np.arange(len(u)), np.abs(u).argmax(axis=1)])
    return e, u * sign[:, None]


def _project(x: np.ndarray, n: int, s: list[int], e: np.ndarray, u: np.ndarray) -> np.ndarray:
    return (centred(x, n, s).astype(np.float64) / n) @ (u / np.sqrt(e)[:, None]).T


def _deviation(y: np.ndarray) -> list[int]:
    """Sum over dimensions of squared centred values, exactly."""
    if int(np.abs(y).max(initial=0)) ** 2 * y.shape[1] < 1 << 63:
        return np.einsum("ij,ij->i", y, y).tolist()
    return [sum(v * v for v in row) for row in y.tolist()]


def whiten(vectors: DataFrame, id_column: str = "vec_id", vector: str = "embedding", k: int = COMPONENTS) -> DataFrame:
    """``<id_column>, component, n, deviation, whitened, explained, identity_error``: one row for each
    remaining vector and each of its up to ``k`` components (1: largest eigenvalue).

    A vector that is null, holds null, NaN or an infinity, or is of another length than most, is left
    out. Repeated vectors count once in n, sums and covariances, and have rows each; repeated ids have
    rows each. Components of eigenvalue zero (all vectors equal, or fewer vectors than dimensions)
    can't be whitened and are left out; an empty table gives an empty result. ``identity_error`` is
    measured over the distinct vectors with the same arithmetic as the rows. Other columns are ignored.
    A deviation beyond 63 bits is an error, not a wrong number."""
    spark = vectors.sparkSession
    kind = vectors.schema[id_column].dataType.simpleString()
    x, d = as_integers(vectors, id_column, vector)
    x = materialize(x, "integers")
    fit = materialize(x.select("x").distinct(), "distinct")
    n, s = sums(fit, d) if d else (0, [])
    schema = f"`{id_column}` {kind}, component int, n bigint, deviation bigint, whitened double, explained double, identity_error double"
    if not n:
        return spark.createDataFrame([], schema)
    v = covariance(n, *squares(fit, n, s))
    e, u = components(v, k)
    m, trace = len(e), float(np.trace(v))
    if not m:
        return spark.createDataFrame([], schema)

    def products(batches):
        total = np.zeros((m, m))
        for block in _blocks(batches, d):
            w = _project(block, n, s, e, u)  # centred: x - S / n
            total += w.T @ w
        i, j = np.indices((m, m)).reshape(2, -1)
        yield pa.RecordBatch.from_arrays([pa.array(i, pa.int32()), pa.array(j, pa.int32()), pa.array(total.ravel())], names=["i", "j", "s"])

    error = (fit.mapInArrow(lean(products), "i int, j int, s double").groupBy("i", "j").agg(F.sum("s").alias("s"))
             .agg(F.max(F.abs(F.col("s") / F.lit(n) - (F.col("i") == F.col("j")).cast("double")))).first()[0])

    def run(batches):
        for b in batches:
            at = 0
            for block in _blocks([b], d):
                w, dev = _project(block, n, s, e, u), _deviation(centred(block, n, s))
                rows = len(block)
                yield pa.RecordBatch.from_arrays([
                    ids(b, "id").slice(at, rows).take(pa.array(np.repeat(np.arange(rows), m))), pa.array(np.tile(np.arange(1, m + 1), rows), pa.int32()),
                    pa.array(np.full(rows * m, n), pa.int64()), pa.array(dev, pa.int64()).take(pa.array(np.repeat(np.arange(rows), m))),
                    pa.array(w.ravel()), pa.array(np.tile(e / trace, rows)), pa.array(np.full(rows * m, float(error)))],
                    names=[id_column, "component", "n", "deviation", "whitened", "explained", "identity_error"])
                at += rows

    return x.mapInArrow(lean(run), schema)
