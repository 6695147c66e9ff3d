"""Spark helpers shared by the operators of this subpackage."""

from __future__ import annotations

import ctypes
import gc
import uuid

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelspark.session import delete_path, scratch_path


CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def materialize(df: DataFrame, name: str = "t") -> DataFrame:
    """Write ``df`` as a Parquet table in the shared checkpoint folder and read it back: lineage
    is cut, and a lost executor costs no recomputation of what stands before. The write's shuffle
    files go as it ends; else they stay until the driver happens to collect its garbage."""
    path = scratch_path(df.sparkSession, f"{name}-{uuid.uuid4().hex[:12]}")
    conf = df.sparkSession.conf
    before = conf.get(CLEANUP, None)
    conf.set(CLEANUP, "true")
    try:
        df.write.parquet(path)
    finally:
        if before is None:
            conf.unset(CLEANUP)
        else:
            conf.set(CLEANUP, before)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out._scratch = path
    return out


def release(df: DataFrame) -> None:
    """Delete a table made by ``materialize`` that no lazy result reads any more."""
    delete_path(df.sparkSession, df._scratch)


# A bitmap over hash slots of keys, as a table of 64 slots a row: 2**(MARK_BITS - 6) rows at most (some 20 MB
# broadcast), whatever the input's size.
MARK_BITS = 24


def _mark(*key) -> Column:
    return F.pmod(F.xxhash64(*key), F.lit(1 << MARK_BITS))


def marks(keys: DataFrame) -> DataFrame:
    """The bitmap of the rows of ``keys``."""
    return (keys.select(_mark(*keys.columns).alias("s")).groupBy(F.shiftright("s", 6).alias("_llm_word"))
            .agg(F.bit_or(F.expr("shiftleft(1L, cast(s & 63 as int))")).alias("_llm_bits")))


def with_mark(df: DataFrame, bitmap: DataFrame, *key: str) -> DataFrame:
    """``df`` with ``_llm_marked``: true for rows whose key (columns of the types marked) is in the bitmap, and
    for those of other keys in its slots. Nothing is shuffled."""
    slot = df.withColumn("_llm_slot", _mark(*key))
    found = slot.join(F.broadcast(bitmap), F.shiftright("_llm_slot", 6) == F.col("_llm_word"), "left")
    return found.withColumn("_llm_marked", F.coalesce(F.getbit("_llm_bits", F.col("_llm_slot").bitwiseAND(63)), F.lit(0)) == 1).drop("_llm_slot", "_llm_word", "_llm_bits")


def fraction_hash(c: Column, m: int) -> Column:
    """crc32 of an id written as text, modulo m (null id: null)."""
    return F.crc32(c.cast("string").cast("binary")) % F.lit(m)


def ids(batch: pa.RecordBatch, column: str) -> pa.Array:
    return batch.column(batch.schema.get_field_index(column))


def lean(f):
    """``f`` for mapInArrow; at a task's end freed memory goes back to the system, so that what
    idle workers of earlier stages hold doesn't add up."""

    def run(batches):
        try:
            yield from f(batches)
        finally:
            gc.collect()
            pa.default_memory_pool().release_unused()
            trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
            if trim:
                trim(0)

    return run


def rows(batch: pa.RecordBatch, *columns: str, size: int = 256):
    """Tuples of Python values, a few rows at a time: a batch may hold 64 MB of text."""
    for lo in range(0, batch.num_rows, size):
        part = batch.slice(lo, size)
        yield from zip(*(ids(part, c).to_pylist() for c in columns))


# Counts over the whole corpus into a fixed number of slots. Each task sums its own rows into one
# array and emits it in compressed pieces; pieces of one number meet and are summed; the driver
# receives slots x 8 bytes, whatever the input's size.
PIECE = 1 << 14


def count_slots(df: DataFrame, rows: int, slots: int, count_batch) -> np.ndarray:
    """Sum over all batches of ``count_batch(batch, acc)``, which adds to an int64 array (rows,
    slots). Returned as such an array. Its size is a parameter and doesn't grow with the data."""
    spark = df.sparkSession
    total = rows * slots
    pieces = -(-total // PIECE)

    def count(batches):
        acc = np.zeros((rows, slots), dtype=np.int64)
        for b in batches:
            count_batch(b, acc)
        yield from emit(acc.ravel())

    def emit(flat):
        z = zstandard.ZstdCompressor(level=1)
        used = [(i, p) for i in range(pieces) if (p := flat[i * PIECE : (i + 1) * PIECE]).any()]
        if used:
            yield pa.RecordBatch.from_pydict({
                "piece": pa.array([i for i, _ in used], pa.int32()),
                "data": pa.array([z.compress(p.astype(np.int64).tobytes()) for _, p in used], pa.binary())})

    def add(batches):
        z, acc = zstandard.ZstdDecompressor(), {}
        for b in batches:
            for i, d in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                p = np.frombuffer(z.decompress(d), dtype=np.int64)
                acc[i] = acc[i] + p if i in acc else p
        z = zstandard.ZstdCompressor(level=1)
        if acc:
            yield pa.RecordBatch.from_pydict({"piece": pa.array(list(acc), pa.int32()),
                                              "data": pa.array([z.compress(p.tobytes()) for p in acc.values()], pa.binary())})

    schema = "piece int, data binary"
    parts = max(1, min(pieces, int(spark.conf.get("spark.sql.shuffle.partitions"))))
    summed = df.mapInArrow(lean(count), schema).repartition(parts, "piece").mapInArrow(lean(add), schema)
    out = np.zeros(pieces * PIECE, dtype=np.int64)
    z = zstandard.ZstdDecompressor()
    for r in summed.toLocalIterator():
        p = np.frombuffer(z.decompress(bytes(r["data"])), dtype=np.int64)
        out[r["piece"] * PIECE : r["piece"] * PIECE + len(p)] += p
    return out[:total].reshape(rows, slots)


def kth_largest(df: DataFrame, column: str, k: int) -> int | None:
    """The k-th largest value of a bigint column (None if there are fewer), found 16 bits at a
    time: each pass counts at most 65,536 slots, so nothing is sorted or gathered."""
    shifted = F.col(column)
    low = None
    for shift in (48, 32, 16, 0):
        part = df if low is None else df.where(F.shiftright(shifted, shift + 16) == low)
        counts = part.groupBy(F.shiftright(shifted, shift).alias("s")).count().orderBy(F.desc("s")).collect()
        for r in counts:
            if r["count"] >= k:
                low = r["s"]
                break
            k -= r["count"]
        else:
            return None
    return low


def logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1e-2) -> np.ndarray:
    """Newton's method on the ridge-penalised log loss (the bias isn't penalised)."""
    scale = np.maximum(np.abs(x).max(axis=0), 1e-9)
    a, w = x / scale, np.zeros(x.shape[1])
    pen = ridge * np.diag([0.0, *[1.0] * (x.shape[1] - 1)])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(a @ w, -30, 30)))
        step = np.linalg.solve(a.T @ (a * (p * (1 - p))[:, None]) + pen + 1e-9 * np.eye(len(w)), a.T @ (y - p) - pen @ w)
        w += np.clip(step, -5, 5)
        if np.abs(step).max() < 1e-8:
            break
    return w / scale


def min_links(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """Connected components of links (two bigint columns): rows (node, root), root the smallest
    node reachable, for every node that has a link.

    Alternating large-star and small-star steps: each step is one aggregate and one join on the
    links, and the links of a component shrink to a star around its smallest node in a logarithmic
    number of steps. Each step is written, so lineage stays short and nothing reaches the driver
    but one count and one sum."""
    cur = materialize(
        edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).where("u != v").distinct(), "links")
    state = None
    while True:
        both = cur.select("u", "v").union(cur.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.where("v > u").join(low, "u").where("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        low2 = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (large.join(low2, "u").select(F.explode(F.array(
            F.struct(F.col("u").alias("u"), F.col("m").alias("v")),
            F.struct(F.col("v").alias("u"), F.col("m").alias("v")))).alias("x")).select("x.*").where("u != v").distinct())
        new = materialize(small, "links")
        got = tuple(new.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())
        release(cur)
        cur = new
        if got == state:
            break
        state = got
    star = cur.select(F.col("u").alias("node"), F.col("v").alias("root"))
    return star.union(cur.select("v", "v").distinct())
