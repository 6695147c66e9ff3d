"""Approximate nearest neighbours by an inverted multi-index (operator 6).

The first and the second half of the vectors are quantised apart (k centroids each), so that every
vector lies in one of k * k cells. A query visits centroid pairs in the order of the summed inner
products of its halves, best first, with a heap over the two sorted lists, until the cells seen
hold ``candidates`` vectors; these are reranked by the inner product of the original vectors.
"""

from __future__ import annotations

import heapq

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from panelspark.llm.common import ids, lean, materialize

TOP = 20
EVERY = 20  # queries: rows whose vec_id it divides
FIT_ROWS = 20_000  # vectors the centroids are fitted on, by least id hash; all are indexed
MAX_K = 512  # k * k cell counts go to the driver and to all tasks
RECALL, FIT_QUERIES = 0.95, 256  # recall to reach, and the queries it is measured on
BLOCK = 4_096  # vectors of the index that a group holds; larger cells are split
ASKED = 1_024  # queries that a group holds; a bucket that more queries visit meets them in blocks
WALKS = 128  # queries whose cells one task looks up


def _kind(vectors: DataFrame) -> str:
    kind = vectors.schema["embedding"].dataType.simpleString()
    return kind if kind == "array<float>" else "array<double>"


def valid(vectors: DataFrame) -> DataFrame:
    """One row a vec_id (the least vector, if repeated): ``vec_id, embedding``. Left out are null
    ids, null, empty and zero vectors, those with null or non-finite components, and those not of
    the commonest length. Floats stay floats, components of any other type become doubles."""
    x = vectors.select("vec_id", F.col("embedding").cast(_kind(vectors)).alias("embedding")).where(
        "vec_id is not null and embedding is not null and size(embedding) > 0"
        " and forall(embedding, x -> x is not null and not isnan(x) and abs(x) < double('Infinity'))"
        " and exists(embedding, x -> x != 0)")
    x = x.groupBy("vec_id").agg(F.min("embedding").alias("embedding"))
    size = x.groupBy(F.size("embedding").alias("n")).count().orderBy(F.desc("count"), "n").first()
    return x.where(F.size("embedding") == (size["n"] if size else 0))


def _stack(col: pa.Array) -> np.ndarray:
    flat = col.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(col), -1) if len(col) else np.zeros((0, 0), dtype=np.float32)


def kmeans(x: np.ndarray, k: int, rounds: int = 12) -> np.ndarray:
    """Lloyd's method from evenly spread rows; empty centroids stay where they are."""
    c = x[np.linspace(0, len(x) - 1, k).astype(int)].astype(np.float64)
    for _ in range(rounds):
        own = assign(x, c)
        n = np.bincount(own, minlength=len(c))
        sums = np.stack([np.bincount(own, weights=x[:, d], minlength=len(c)) for d in range(x.shape[1])], axis=1)
        c = np.where(n[:, None] > 0, sums / np.maximum(n, 1)[:, None], c)
    return c


def assign(x: np.ndarray, c: np.ndarray) -> np.ndarray:
    """Nearest centroid of each row."""
    return (0.5 * (c**2).sum(axis=1) - x.astype(np.float64) @ c.T).argmin(axis=1)


def visit(a: np.ndarray, b: np.ndarray, counts: np.ndarray, want: int) -> list[int]:
    """Non-empty cells (i * k + j) in descending order of a[i] + b[j], until they hold ``want``."""
    ia, ib, k = np.argsort(-a), np.argsort(-b), len(b)
    heap, seen, got, out = [(-(a[ia[0]] + b[ib[0]]), 0, 0)], {(0, 0)}, 0, []
    while heap and got < want:
        _, i, j = heapq.heappop(heap)
        n = counts[ia[i], ib[j]]
        if n:
            out.append(int(ia[i]) * k + int(ib[j]))
            got += n
        for p in ((i + 1, j), (i, j + 1)):
            if p[0] < len(a) and p[1] < k and p not in seen:
                seen.add(p)
                heapq.heappush(heap, (-(a[ia[p[0]]] + b[ib[p[1]]]), *p))
    return out


def cell_runs(cells: np.ndarray, counts: np.ndarray, salts: np.ndarray, first: np.ndarray):
    """The buckets that hold some of the cells and, for each, the runs of its cells as ``low, high, low,
    high, ..``. Cells without vectors don't end a run."""
    c = np.repeat(cells, salts[cells])
    bucket = first[c] + np.arange(len(c)) - np.repeat(np.cumsum(salts[cells]) - salts[cells], salts[cells])
    order = np.lexsort((c, bucket))
    c, bucket = c[order], bucket[order]
    place = np.cumsum(counts > 0)[c]
    new = np.flatnonzero(np.concatenate([[True], bucket[1:] != bucket[:-1]]))
    start = np.concatenate([[True], (bucket[1:] != bucket[:-1]) | (place[1:] != place[:-1] + 1)])
    low, high = c[start], c[np.append(start[1:], True)]
    begin = np.append(np.cumsum(start)[new] - 1, len(low))  # a bucket's first run
    return bucket[new].tolist(), [np.column_stack([low[a:z], high[a:z]]).ravel() for a, z in zip(begin, begin[1:])]


def fit(vectors: DataFrame, n: int, fit_rows: int = FIT_ROWS, k: int | None = None):
    """Centroids of both halves, from a bounded sample."""
    chosen = vectors.select("vec_id").orderBy(F.xxhash64("vec_id"), "vec_id").limit(fit_rows)
    rows = vectors.join(F.broadcast(chosen), "vec_id", "left_semi").orderBy("vec_id").toArrow()  # fit_rows vectors
    x = _stack(rows.column("embedding").combine_chunks())
    k = k or 2 ** int(np.clip(np.round(np.log2(max(n, 1) ** 0.5 / 4)), 1, np.log2(MAX_K)))
    k, half = min(k, len(x)), max(1, x.shape[1] // 2)
    parts = x[:, :half], x[:, half:]
    return half, [kmeans(p, k) if p.shape[1] else np.zeros((1, 0)) for p in parts]


def measure(index: DataFrame, asked: DataFrame, half: int, centroids, counts: np.ndarray, top: int, recall: float,
            fit_queries: int) -> int:
    """Candidates a query must see to find the share ``recall`` of the true ``top`` of a bounded set
    of queries. The truth comes from one pass over all vectors; each task keeps ``top`` a query."""
    rows = asked.orderBy(F.xxhash64("vec_id"), "vec_id").limit(fit_queries).select("vec_id", "embedding").toArrow()
    qid, q = rows.column("vec_id").to_numpy(), _stack(rows.column("embedding").combine_chunks()).astype(np.float64)
    if not len(qid):
        return 1
    shared = index.sparkSession.sparkContext.broadcast((qid, q))

    def exact(batches):
        ids_, x = shared.value
        best = [np.zeros((0, 2)) for _ in ids_]
        for b in batches:
            v, c = ids(b, "vec_id").to_numpy(), ids(b, "cell").to_numpy()
            scores = _stack(ids(b, "embedding")).astype(np.float64) @ x.T
            for i, own in enumerate(ids_):
                s = np.where(v == own, -np.inf, scores[:, i])
                keep = np.argsort(-s)[:top]
                both = np.concatenate([best[i], np.column_stack([s[keep], c[keep]])])
                best[i] = both[np.argsort(-both[:, 0])[:top]]
        for i, x_ in enumerate(best):
            x_ = x_[np.isfinite(x_[:, 0])]
            if len(x_):
                yield pa.RecordBatch.from_arrays([pa.array([i] * len(x_), pa.int64()), pa.array(x_[:, 0]), pa.array(x_[:, 1].astype(np.int64))],
                                                 names=["q", "score", "cell"])

    w = Window.partitionBy("q").orderBy(F.desc("score"), "cell")
    truth = (index.mapInArrow(lean(exact), "q bigint, score double, cell bigint")
             .withColumn("rn", F.row_number().over(w)).where(F.col("rn") <= top).select("q", "cell").toArrow())
    of, cells = truth.column("q").to_numpy(), truth.column("cell").to_numpy()
    need = []
    for i in range(len(qid)):
        near = ((centroids[0] @ q[i, :half])[:, None] + centroids[1] @ q[i, half:]).ravel()
        order = np.argsort(-near)
        sums = np.empty(len(order), dtype=np.int64)
        sums[order] = np.cumsum(counts[order])
        need.append(sums[cells[of == i]])
    need = np.sort(np.concatenate(need))
    return int(need[min(len(need) - 1, int(np.ceil(recall * len(need))))]) if len(need) else 1


def search(vectors: DataFrame, every: int = EVERY, top: int = TOP, candidates: int | None = None, recall: float = RECALL,
           fit_rows: int = FIT_ROWS, fit_queries: int = FIT_QUERIES, k: int | None = None, block: int = BLOCK,
           asked_block: int = ASKED) -> DataFrame:
    """``query_id, rank, vec_id, score``: the ``top`` nearest found of every query, nearest first,
    equal scores by smaller vec_id (all candidates, if fewer). Which rows take part: see ``valid``;
    other columns are ignored; an empty table gives an empty result.

    Of equal vectors only the ``top`` + 1 least ids can be in any answer, and equal queries have
    one answer but for their own id: both are reduced to that before the index is made, so a vector
    that a third of all rows share costs no more than others. Cells of more than ``block`` vectors
    are split, and their queries go to every part. A bucket of cells that more than ``asked_block``
    queries visit is copied once for each such block of them, so no task holds more than one block of
    either side, however many queries a bucket has.
    """
    spark, kind = vectors.sparkSession, _kind(vectors)
    empty = spark.createDataFrame([], "query_id bigint, rank int, vec_id bigint, score double")
    whole = materialize(valid(vectors), "vectors")
    least = Window.partitionBy("embedding").orderBy("vec_id")
    base = materialize(whole.withColumn("rn", F.row_number().over(least)).where(F.col("rn") <= top + 1).drop("rn"), "index")
    n = base.count()
    if not n:
        return empty
    half, centroids = fit(base, n, fit_rows, k)
    shape = len(centroids[0]), len(centroids[1])
    shared = spark.sparkContext.broadcast((half, centroids))

    def cell(batches):
        h, (c1, c2) = shared.value
        for b in batches:
            x = _stack(ids(b, "embedding"))
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(assign(x[:, :h], c1) * len(c2) + assign(x[:, h:], c2), pa.int64())],
                                             names=[*b.schema.names, "cell"])

    index = materialize(base.mapInArrow(lean(cell), f"vec_id bigint, embedding {kind}, cell bigint"), "cells")
    counts = np.zeros(shape[0] * shape[1], dtype=np.int64)
    for r in index.groupBy("cell").count().collect():  # at most MAX_K * MAX_K rows
        counts[r["cell"]] = r["count"]
    asked = whole.where(F.col("vec_id") % every == 0)
    if candidates is None:
        candidates = measure(index, asked, half, centroids, counts, top, recall, fit_queries)
    candidates = max(candidates, top + 1)
    salts = np.maximum(1, -(-counts // block))
    share = -(-counts // salts)
    bucket = (np.cumsum(share * salts) - share * salts) // block  # neighbouring cells, about block vectors together
    first = np.where(salts > 1, 0, bucket)
    first[salts > 1] = bucket.max(initial=0) + 1 + np.cumsum(salts[salts > 1]) - salts[salts > 1]
    layout = spark.sparkContext.broadcast((counts.reshape(shape), salts, first))

    def place(batches):
        _, s, f = layout.value
        for b in batches:
            c = ids(b, "cell").to_numpy()
            v = ids(b, "vec_id").to_numpy()
            yield pa.RecordBatch.from_arrays([pa.array(f[c] + (v // max(every, 1)) % s[c]), *b.columns], names=["bucket", *b.schema.names])

    def probe(batches):
        h, (c1, c2) = shared.value
        cnt, s, f = layout.value
        for b in batches:
            x = _stack(ids(b, "embedding")).astype(np.float64)
            buckets, row, runs = [], [], []
            for r, q in enumerate(x):
                found, own = cell_runs(np.array(visit(c1 @ q[:h], c2 @ q[h:], cnt, candidates)), cnt.ravel(), s, f)
                buckets += found
                runs += own
                row += [r] * len(found)
            at = pa.array(row, pa.int64())
            yield pa.RecordBatch.from_arrays([pa.array(buckets, pa.int64()), ids(b, "rep").take(at), ids(b, "embedding").take(at),
                                              pa.array(runs, pa.list_(pa.int64()))], names=["bucket", "rep", "embedding", "runs"])

    def rerank(left: pa.Table, right: pa.Table) -> pa.Table:
        found = [], [], []
        if left.num_rows and right.num_rows:
            left = left.sort_by("cell")
            cells = left.column("cell").to_numpy()
            vec, vid = _stack(left.column("embedding").combine_chunks()).astype(np.float64), left.column("vec_id").to_numpy()
            queries = _stack(right.column("embedding").combine_chunks()).astype(np.float64)
            longest = np.sqrt((vec**2).sum(axis=1).max())
            for rep, q, runs in zip(right.column("rep").to_pylist(), queries, right.column("runs").to_pylist()):
                lo, hi = np.searchsorted(cells, runs[::2], "left"), np.searchsorted(cells, runs[1::2], "right")
                rows = np.concatenate([np.arange(a, b) for a, b in zip(lo, hi)])
                rough = vec[rows] @ q
                slack = 1e-9 * longest * np.sqrt((q**2).sum())
                if len(rows) > top + 1 and np.isfinite(slack):  # leave out what rounding can't lift into the best
                    edge = np.partition(rough, len(rough) - top - 1)[len(rough) - top - 1]
                    rows = rows[rough >= edge - slack]
                score = (vec[rows] * q).sum(axis=1)  # the same order of summation for every row
                best = np.lexsort((vid[rows], -score))[: top + 1]
                found[0].extend([rep] * len(best))
                found[1].extend(vid[rows][best].tolist())
                found[2].extend(score[best].tolist())
        return pa.table({"rep": pa.array(found[0], pa.int64()), "vec_id": pa.array(found[1], pa.int64()), "score": pa.array(found[2], pa.float64())})

    reps = materialize(asked.groupBy("embedding").agg(F.min("vec_id").alias("rep")), "asked")
    walks = reps.repartition(max(1, -(-reps.count() // WALKS)))  # a walk costs more than its row's size tells
    probes = materialize(walks.mapInArrow(lean(probe), f"bucket bigint, rep bigint, embedding {kind}, runs array<bigint>"), "probes")
    placed = index.mapInArrow(lean(place), f"bucket bigint, vec_id bigint, embedding {kind}, cell bigint")
    blocks = probes.groupBy("bucket").agg(F.ceil(F.count("*") / asked_block).alias("blocks"))  # a row a bucket
    placed = placed.join(blocks, "bucket").withColumn("part", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("blocks") - 1))).drop("blocks")
    probes = probes.join(blocks, "bucket").withColumn("part", F.pmod(F.xxhash64("rep"), "blocks")).drop("blocks")
    hits = (placed.groupBy("bucket", "part").cogroup(probes.groupBy("bucket", "part"))
            .applyInArrow(rerank, "rep bigint, vec_id bigint, score double"))
    best = Window.partitionBy("rep").orderBy(F.desc("score"), "vec_id")
    hits = hits.withColumn("rn", F.row_number().over(best)).where(F.col("rn") <= top + 1).drop("rn")
    own = asked.join(reps, "embedding").select(F.col("vec_id").alias("query_id"), "rep")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (own.join(hits, "rep").where("vec_id != query_id").withColumn("rank", F.row_number().over(order))
            .where(F.col("rank") <= top).select("query_id", "rank", "vec_id", "score"))
