"""Substring dedup by super-k-mer partitioning (operator 9).

A window is k consecutive words. Its minimiser is the least hash among its runs of m words, and
consecutive windows that share a minimiser form a super-k-mer: one packed string of their words. A
window has the same minimiser wherever it stands, so all its occurrences travel, inside their
super-k-mers, to the bucket of that minimiser, where the windows are sorted and counted exactly
(each occurrence of a window is compared by two independent 64-bit hashes of its words).

Skew: minimisers are counted first, by slot, over all documents. Slots share buckets of about equal
load. The super-k-mers of an overfull slot (a passage or a copy that very many documents hold) go
by the hash of their whole content instead, identical ones meet and become one weighted string, and
only those distinct strings are taken apart into windows, which Spark counts by window. Strings
are joined within a task before they travel in any case.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelspark.llm.common import count_slots, ids, lean, materialize, release, rows
from panelspark.llm.text import ranges, slices, sliding_min, span_hashes, squeeze, windows, words

K = 35
M = 4
SLOT_BITS = 20  # 2 ** SLOT_BITS minimiser slots are counted (8 bytes each on the driver); more for > 1 TB
BUCKET = 25_000  # super-k-mers in a bucket, about 8 MB of text
RUN = 1_024  # windows in one super-k-mer at most
CHUNK = 4 << 20  # bytes of text whose equal super-k-mers are joined before they travel


def super_kmers(buf: np.ndarray, offsets: np.ndarray, k: int, m: int):
    """Of a chunk of documents: the squeezed bytes, and by super-k-mer its document, first word in
    the document, number of windows, first and last byte, and minimiser."""
    buf, s, e, first = squeeze(buf, offsets)
    mins = sliding_min(windows(span_hashes(buf, s, e), m), k - m + 1)
    if len(s) < k:
        none = np.zeros(0, dtype=np.int64)
        return buf, none, none, none, none, none, np.zeros(0, dtype=np.uint64)
    doc = np.repeat(np.arange(len(first) - 1), np.diff(first))
    at = np.flatnonzero(doc[: len(mins)] == doc[k - 1 :])
    if not len(at):
        none = np.zeros(0, dtype=np.int64)
        return buf, none, none, none, none, none, np.zeros(0, dtype=np.uint64)
    new = np.concatenate([[True], (at[1:] != at[:-1] + 1) | (mins[at[1:]] != mins[at[:-1]])])
    begin = np.flatnonzero(new)
    length = np.diff(np.append(begin, len(at)))
    parts = -(-length // RUN)  # looping texts make endless runs
    begin = np.repeat(begin, parts) + RUN * ranges(np.zeros(len(parts), np.int64), parts)
    length = np.diff(np.append(begin, len(at)))
    a = at[begin]
    return buf, doc[a], a - first[doc[a]], length, s[a], e[a + length + k - 2], mins[a]


def _count(k, m, bits):
    def count(batch, acc):
        for _, _, buf, off in slices(batch):
            *_, mins = super_kmers(buf, off, k, m)
            acc[0] += np.bincount((mins >> np.uint64(64 - bits)).astype(np.int64), minlength=1 << bits)

    return count


def layout(counts: np.ndarray, bucket: int = BUCKET) -> tuple[np.ndarray, int]:
    """Bucket of every slot, -1 for overfull ones (over ``bucket`` and 16 times the mean), and the
    number of buckets."""
    hot = counts > max(bucket, 16 * counts.mean())
    load = np.where(hot, 0, counts)
    return np.where(hot, -1, (np.cumsum(load) - load) // bucket), int(counts.sum() // bucket) + 1


def _strings(batches, shared, k, m):
    """Distinct super-k-mers of each chunk of a task: {bytes: times}, with bucket and hot flag."""
    table, n, bits = shared.value
    for b in batches:
        for _, _, buf, off in slices(b, max_bytes=CHUNK):
            buf, _, _, _, lo, hi, mins = super_kmers(buf, off, k, m)
            text = buf.tobytes()
            place = table[(mins >> np.uint64(64 - bits)).astype(np.int64)]
            found: dict[bytes, list] = {}
            for a, z, p in zip(lo.tolist(), hi.tolist(), place.tolist()):
                x = text[a:z]
                if x in found:
                    found[x][0] += 1
                else:
                    found[x] = [1, p]
            yield found, n


def _pack(strings: list[tuple[bytes, int, bool]], z: zstandard.ZstdCompressor) -> bytes:
    sizes = np.array([len(x) for x, _, _ in strings], dtype="<u4").tobytes()
    times = np.array([n for _, n, _ in strings], dtype="<u4").tobytes()
    hot = np.array([h for *_, h in strings], dtype="u1").tobytes()
    return len(strings).to_bytes(4, "little") + z.compress(sizes + times + hot + b"".join(x for x, _, _ in strings))


def _unpack(blob: bytes):
    n = int.from_bytes(blob[:4], "little")
    raw = zstandard.ZstdDecompressor().decompress(blob[4:])
    sizes, times = np.frombuffer(raw, "<u4", n), np.frombuffer(raw, "<u4", n, 4 * n)
    hot, at = np.frombuffer(raw, "u1", n, 8 * n), 9 * n
    ends = at + np.cumsum(sizes.astype(np.int64))
    return [(raw[z - s : z], t, h) for z, s, t, h in zip(ends.tolist(), sizes.tolist(), times.tolist(), hot.tolist())]


def name(x: bytes) -> tuple[int, int]:
    """128-bit name of a string, as two bigints."""
    d = xxhash.xxh3_128_digest(x)
    return int.from_bytes(d[:8], "little", signed=True), int.from_bytes(d[8:], "little", signed=True)


def window_hashes(strings: list[bytes], k: int):
    """Both hashes of every window of the strings, and the string and offset of each."""
    buf = np.frombuffer(b"\n".join(strings), dtype=np.uint8)
    size = np.array([len(x) + 1 for x in strings], dtype=np.int64)
    s, e, first = words(buf, np.append(np.cumsum(size) - size, len(buf)))
    n = np.diff(first) - k + 1
    at = ranges(first[:-1], n)
    return ([windows(span_hashes(buf, s, e, seed), k)[at].view(np.int64) for seed in (0, 1)],
            np.repeat(np.arange(len(strings)), n), ranges(np.zeros(len(n), np.int64), n))


FLAGS = "s1 bigint, s2 bigint, flags array<int>"
_FLAGS = pa.schema([("s1", pa.int64()), ("s2", pa.int64()), ("flags", pa.list_(pa.int32()))])


def repeated(strings: list[bytes], times: np.ndarray, k: int) -> np.ndarray:
    """By window (in the order of ``window_hashes``): whether it occurs at least twice."""
    (h1, h2), of, _ = window_hashes(strings, k)
    if not len(h1):
        return np.zeros(0, dtype=bool)
    order = np.lexsort((h2, h1))
    a, b = h1[order], h2[order]
    start = np.flatnonzero(np.concatenate([[True], (a[1:] != a[:-1]) | (b[1:] != b[:-1])]))
    total = np.add.reduceat(times[of[order]].astype(np.int64), start)
    out = np.empty(len(order), dtype=bool)
    out[order] = np.repeat(total >= 2, np.diff(np.append(start, len(order))))
    return out


def repeated_windows(docs: DataFrame, k: int = K, m: int = M, bits: int = SLOT_BITS, bucket: int = BUCKET) -> DataFrame:
    """``s1, s2, flags``: names of super-k-mers and the windows in them that occur more than once in
    all documents. A written table."""
    spark = docs.sparkSession
    docs = docs.select("text")
    counts = count_slots(docs, 1, 1 << bits, _count(k, m, bits))[0]
    table, n = layout(counts, bucket)
    shared = spark.sparkContext.broadcast((table.astype(np.int32), n, bits))

    def spread(batches):
        z = zstandard.ZstdCompressor(level=1)
        for found, buckets in _strings(batches, shared, k, m):
            by: dict[int, list] = {}
            for x, (times, p) in found.items():
                by.setdefault(p if p >= 0 else xxhash.xxh64_intdigest(x) % buckets, []).append((x, times, p < 0))
            for p in sorted(by):  # small batches: a chunk's packed strings
                yield pa.RecordBatch.from_pydict({"bucket": pa.array([p], pa.int32()), "data": pa.array([_pack(by[p], z)], pa.binary())})

    def count(table: pa.Table) -> pa.Table:
        merged: dict[bytes, list] = {}
        for blob in table.column("data").to_pylist():
            for x, t, h in _unpack(blob):
                if x in merged:
                    merged[x][0] += t
                else:
                    merged[x] = [t, h]
        cold = [x for x, (_, h) in merged.items() if not h]
        flag = repeated(cold, np.array([merged[x][0] for x in cold], dtype=np.int64), k)
        _, of, offset = window_hashes(cold, k) if cold else (None, np.zeros(0, np.int64), np.zeros(0, np.int64))
        of, offset = of[flag], offset[flag]
        edge = np.searchsorted(of, np.arange(len(cold) + 1))
        found = [(*name(cold[i]), offset[edge[i] : edge[i + 1]].tolist(), None, None) for i in np.unique(of).tolist()]
        found += [(*name(x), None, x, t) for x, (t, h) in merged.items() if h]
        s1, s2, flags, text, times = zip(*found) if found else [[]] * 5
        return pa.table({"s1": pa.array(s1, pa.int64()), "s2": pa.array(s2, pa.int64()), "flags": pa.array(flags, pa.list_(pa.int32())),
                         "hot": pa.array(text, pa.binary()), "times": pa.array(times, pa.int64())})

    counted = materialize(
        docs.mapInArrow(lean(spread), "bucket int, data binary").groupBy("bucket").applyInArrow(
            count, FLAGS + ", hot binary, times bigint"), "superkmers")

    def take_apart(batches):
        for b in batches:
            strings, times = ids(b, "hot").to_pylist(), ids(b, "times").to_numpy()
            (h1, h2), of, offset = window_hashes(strings, k)
            yield pa.RecordBatch.from_arrays([
                pa.array(h1), pa.array(h2), ids(b, "s1").take(pa.array(of)), ids(b, "s2").take(pa.array(of)),
                pa.array(offset.astype(np.int32)), pa.array(times[of])], names=["h1", "h2", "s1", "s2", "at", "times"])

    hot = counted.where("hot is not null").select("s1", "s2", "hot", "times")
    single = hot.mapInArrow(lean(take_apart), "h1 bigint, h2 bigint, s1 bigint, s2 bigint, at int, times bigint")
    twice = single.groupBy("h1", "h2").agg(F.sum("times").alias("n")).where("n >= 2").select("h1", "h2")
    hot_flags = single.join(twice, ["h1", "h2"]).groupBy("s1", "s2").agg(F.array_sort(F.collect_list("at")).alias("flags"))
    out = materialize(counted.where("hot is null").select("s1", "s2", "flags").unionByName(hot_flags), "repeats")
    release(counted)
    return out


def covered(docs: DataFrame, k: int = K, m: int = M, bits: int = SLOT_BITS, bucket: int = BUCKET) -> DataFrame:
    """``doc_id, text_hash, runs``: first word and repeated windows of each super-k-mer that has
    some, by document."""
    flags = repeated_windows(docs, k, m, bits, bucket)

    def locate(batches):
        for b in batches:
            for lo, _, buf, off in slices(b):
                buf, doc, at, _, s, e, _ = super_kmers(buf, off, k, m)
                text = buf.tobytes()
                names = [name(text[x:y]) for x, y in zip(s.tolist(), e.tolist())]
                row = pa.array(doc + lo)
                yield pa.RecordBatch.from_arrays([
                    pa.array([x for x, _ in names], pa.int64()), pa.array([y for _, y in names], pa.int64()),
                    ids(b, "doc_id").take(row), ids(b, "text_hash").take(row), pa.array(at.astype(np.int32))],
                    names=["s1", "s2", "doc_id", "text_hash", "at"])

    places = docs.select("doc_id", "text", F.xxhash64("text").alias("text_hash")).mapInArrow(
        lean(locate), "s1 bigint, s2 bigint, doc_id bigint, text_hash bigint, at int")
    return places.join(flags, ["s1", "s2"]).groupBy("doc_id", "text_hash").agg(
        F.collect_set(F.struct("at", "flags")).alias("runs"))


def kept_words(text: str | None, runs: list | None, k: int) -> tuple[int, int, bytes]:
    """Number of words, of removed ones, and the kept words joined by a space."""
    buf, s, e, _ = squeeze(np.frombuffer(data := (text or "").encode(), dtype=np.uint8), np.array([0, len(data)]))
    if not runs:
        return len(s), 0, buf.tobytes()[: int(e[-1]) if len(e) else 0]
    mark = np.zeros(len(s) + 1, dtype=np.int32)
    starts = np.unique(np.concatenate([np.array(r["flags"], dtype=np.int64) + r["at"] for r in runs]))
    mark[starts] += 1
    np.add.at(mark, starts + k, -1)
    keep = np.cumsum(mark)[:-1] == 0
    out = buf.tobytes()
    return len(s), int((~keep).sum()), b" ".join([out[a:z] for a, z in zip(s[keep].tolist(), e[keep].tolist())])


def _with_runs(docs: DataFrame, k, m, bits, bucket, *keep) -> DataFrame:
    runs = covered(docs, k, m, bits, bucket).select(F.col("doc_id").alias("_d"), F.col("text_hash").alias("_t"), F.col("runs").alias("_runs"))
    whole = docs.select(*keep, F.col("doc_id").alias("_llm_id"), F.col("text").alias("_llm_text"), F.xxhash64("text").alias("_llm_hash"))
    return whole.join(runs, F.col("_llm_id").eqNullSafe(F.col("_d")) & (F.col("_llm_hash") == F.col("_t")), "left").drop("_d", "_t")


def dedup(docs: DataFrame, k: int = K, m: int = M, bits: int = SLOT_BITS, bucket: int = BUCKET) -> DataFrame:
    """``doc_id, n_words, n_removed, kept_sha256`` of every document: each word that lies in a window
    whose words also start anywhere else is removed.

    Null and empty texts have no words (and the digest of nothing); repeated rows are removed
    against each other and get a row each; other columns are ignored; an empty table gives an empty
    result."""

    def run(batches):
        for b in batches:
            out = []
            for t, r in rows(b, "_llm_text", "_runs", size=64):
                n, gone, kept = kept_words(t, r, k)
                out.append((n, gone, hashlib.sha256(kept).hexdigest()))
            yield pa.RecordBatch.from_arrays([
                ids(b, "_llm_id"), pa.array([n for n, _, _ in out], pa.int64()), pa.array([r for _, r, _ in out], pa.int64()),
                pa.array([x for *_, x in out], pa.string())],
                names=["doc_id", "n_words", "n_removed", "kept_sha256"])

    return _with_runs(docs, k, m, bits, bucket).select("_llm_id", "_llm_text", "_runs").mapInArrow(
        lean(run), "doc_id bigint, n_words bigint, n_removed bigint, kept_sha256 string")


def without_repeats(docs: DataFrame, k: int = K, m: int = M, bits: int = SLOT_BITS, bucket: int = BUCKET) -> DataFrame:
    """``docs`` with repeated passages cut out of ``text`` (words then joined by one space) and, if
    there is such a column, ``n_chars`` counted anew. Untouched texts stay as they are, documents of
    which nothing is left go."""
    joined = _with_runs(docs, k, m, bits, bucket, F.struct("*").alias("_llm_row"))
    schema = joined.select("_llm_row").schema.add("_llm_new", "string")

    def run(batches):
        for b in batches:
            new = []
            for t, r in rows(b, "_llm_text", "_runs", size=64):
                new.append(kept_words(t, r, k)[2].decode() if r else t)
            yield pa.RecordBatch.from_arrays([ids(b, "_llm_row"), pa.array(new, pa.string())], names=["_llm_row", "_llm_new"])

    out = joined.select("_llm_row", "_llm_text", "_runs").mapInArrow(lean(run), schema)
    changed = ~F.col("_llm_new").eqNullSafe(F.col("_llm_row.text"))
    new = {"text": F.col("_llm_new"), "n_chars": F.when(changed, F.char_length("_llm_new").cast("bigint")).otherwise(F.col("_llm_row.n_chars"))
           if "n_chars" in docs.columns else None}
    return out.where(~(changed & (F.col("_llm_new") == ""))).select(
        *(new[c].alias(c) if new.get(c) is not None else F.col(f"_llm_row.`{c}`").alias(c) for c in docs.columns))


ORACLE = r"""
with d as (select doc_id, row_number() over () as n, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') as w from documents),
win as (select n, i, md5(array_to_string(w[i : i + 34], ' ')) as g from (select n, w, unnest(range(1, len(w) - 33)) as i from d where len(w) >= 35)),
rep as (select n, i from win join (select g from win group by g having count(*) > 1) using (g)),
gone as (select distinct n, p from (select n, unnest(range(i, i + 35)) as p from rep)),
kept as (select n, string_agg(w[p], ' ' order by p) as t from (select n, w, unnest(range(1, len(w) + 1)) as p from d) x
      where not exists (select 1 from gone where gone.n = x.n and gone.p = x.p) group by n),
cnt as (select n, count(*) as n_removed from gone group by n)
select doc_id, len(w)::bigint as n_words, coalesce(n_removed, 0)::bigint as n_removed, sha256(coalesce(t, '')) as kept_sha256
from d left join kept using (n) left join cnt using (n)"""
