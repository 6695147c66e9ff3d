"""Benchmark decontamination by a positional inverted index (operator 2).

The index is a table of shards. A shard holds a run of documents (about ``SHARD_WORDS`` words): its
sorted 64-bit term hashes, and for each term the sorted list of its positions in the shard, where
documents lie one free position apart so that no phrase crosses them. Test phrases are looked up
in every shard: from the rarest of its terms there a phrase gets its candidate starts, which are
then intersected with the offset-adjusted lists of its other terms, rarer ones first. A phrase
with a term that the shard lacks costs nothing. Documents are never split between shards, so
matching needs no shuffle.

The test phrases are a table too, of packed blocks of bounded size that Spark makes from the
benchmark. A few blocks (see ``SHARED_BLOCKS``) are sent to all tasks and met in one pass over the
index; more of them are joined to the index by groups of shards, so neither the driver nor a task
ever holds the benchmark.

Words are equal if their 64-bit hashes are; a phrase of several words would need as many
collisions at the right places to match falsely.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelspark.llm.common import ids, lean, materialize
from panelspark.llm.text import LOWER, TERM, U64, ranges, slices, span_hashes, words

WINDOW = 10
SHARD_WORDS = 1 << 18
BLOCK_WINDOWS = 100_000  # test phrases in a block: at most 21 MB, mostly 6
SHARED_BLOCKS = 4  # blocks that may be sent to all tasks
GROUP_SHARDS = 64  # shards that one copy of the further blocks serves

INDEX = ("doc_ids array<bigint>, text_hashes array<bigint>, n_words array<bigint>, first array<bigint>, "
         "terms binary, begins binary, positions binary")
PHRASES = "terms binary, places binary, lengths binary, items array<bigint>"
MATCHES = "doc_id bigint, text_hash bigint, items array<bigint>, spans array<int>"
_ARROW = pa.schema([*((c, pa.list_(pa.int64())) for c in ("doc_ids", "text_hashes", "n_words", "first")),
                    *((c, pa.binary()) for c in ("terms", "begins", "positions"))])


def build_index(docs: DataFrame, shard_words: int = SHARD_WORDS) -> DataFrame:
    """Index of all words of ``doc_id, text``, as a lazy table of shards (write it to reuse it)."""

    def run(batches):
        held, docs_, hashes, sizes = [], [], [], []

        def shard():
            h = np.concatenate(held) if held else np.zeros(0, dtype=U64)
            n = np.array(sizes, dtype=np.int64)
            first = np.cumsum(n + 1) - n - 1  # one free position between documents
            position = ranges(first, n).astype(np.uint32)
            order = np.argsort(h, kind="stable")
            h = h[order]
            begins = np.flatnonzero(np.concatenate([[True], h[1:] != h[:-1]])) if len(h) else np.zeros(0, np.int64)
            return pa.RecordBatch.from_pydict({
                "doc_ids": [docs_], "text_hashes": [hashes], "n_words": [sizes], "first": [first.tolist()],
                "terms": [h[begins].tobytes()], "begins": [np.append(begins, len(h)).astype(np.uint32).tobytes()],
                "positions": [position[order].tobytes()]}, schema=_ARROW)

        for b in batches:
            d, t = ids(b, "doc_id").to_pylist(), ids(b, "text_hash").to_pylist()
            for lo, hi, buf, off in slices(b):
                s, e, first = words(buf := LOWER[buf], off, TERM)
                held.append(span_hashes(buf, s, e))
                docs_, hashes, sizes = docs_ + d[lo:hi], hashes + t[lo:hi], sizes + np.diff(first).tolist()
                if sum(map(len, held)) >= shard_words:
                    yield shard()
                    held, docs_, hashes, sizes = [], [], [], []
        if docs_:
            yield shard()

    return docs.select("doc_id", "text", F.xxhash64("text").alias("text_hash")).mapInArrow(lean(run), INDEX)


@dataclass
class Phrases:
    """A block of test phrases: their distinct terms and, by phrase, term numbers (-1 behind the end),
    length and item."""

    terms: np.ndarray
    rows: np.ndarray
    length: np.ndarray
    item: np.ndarray  # of ints and None

    @staticmethod
    def unpack(terms: bytes, places: bytes, lengths: bytes, items: list) -> Phrases:
        n = np.frombuffer(lengths, dtype=np.int32).astype(np.int64)
        rows = np.frombuffer(places, dtype=np.int32).astype(np.int64)
        return Phrases(np.frombuffer(terms, dtype=U64), rows.reshape(len(n), -1), n, np.array(items, dtype=object))


def phrase_blocks(benchmark: DataFrame, window: int = WINDOW, size: int = BLOCK_WINDOWS) -> DataFrame:
    """Packed blocks of at most ``size`` phrases of ``item_id, text``; a long item may lie in several.
    A lazy table."""

    def pack(hashes: list, lengths: list, items: list) -> pa.RecordBatch:
        h, n = np.concatenate(hashes), np.concatenate(lengths)
        own = np.arange(window) < n[:, None]
        places = np.full(own.shape, -1, dtype=np.int32)
        terms, places[own] = np.unique(h[own], return_inverse=True)
        return pa.RecordBatch.from_arrays(
            [pa.array([x], pa.binary()) for x in (terms.tobytes(), places.tobytes(), n.astype(np.int32).tobytes())]
            + [pa.array([items], pa.list_(pa.int64()))], names=["terms", "places", "lengths", "items"])

    def run(batches):
        hashes, lengths, items = [], [], []
        for b in batches:
            names = ids(b, "item_id")
            for lo, _, buf, off in slices(b):
                s, e, first = words(buf := LOWER[buf], off, TERM)
                h = np.append(span_hashes(buf, s, e), np.zeros(window, dtype=U64))
                n = np.diff(first)
                k = np.minimum(n, window)
                many = np.where(n > 0, n - k + 1, 0)
                item, start = np.repeat(np.arange(len(n)), many), ranges(first[:-1], many)
                at = 0
                while at < len(start):
                    part = slice(at, at + size - len(items))
                    hashes.append(h[start[part, None] + np.arange(window)])
                    lengths.append(k[item[part]])
                    items += names.take(pa.array(lo + item[part])).to_pylist()
                    at = part.stop
                    if len(items) >= size:
                        yield pack(hashes, lengths, items)
                        hashes, lengths, items = [], [], []
        if items:
            yield pack(hashes, lengths, items)

    texts = benchmark.where("text is not null").select(F.col("item_id").cast("bigint").alias("item_id"), "text")
    much = texts.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    return texts.coalesce(max(1, -(-much // (6 * size)))).mapInArrow(lean(run), PHRASES)  # a word and a space: 6 bytes


class Shard:
    """The postings of one index row that some phrases need, as one sorted array of
    (term, position) keys."""

    def __init__(self, terms: np.ndarray, begins: np.ndarray, positions: np.ndarray, wanted: np.ndarray):
        at = np.minimum(np.searchsorted(terms, wanted), max(len(terms) - 1, 0))
        has = terms[at] == wanted if len(terms) else np.zeros(len(wanted), dtype=bool)
        lo = np.where(has, begins[at].astype(np.int64), 0)
        self.count = np.where(has, begins[at + 1].astype(np.int64), 0) - lo if len(terms) else np.zeros(len(wanted), np.int64)
        self.begin = np.cumsum(self.count) - self.count
        self.keys = (np.repeat(np.arange(len(wanted)), self.count) << 32) | positions[ranges(lo, self.count)].astype(np.int64)

    def holds(self, term: np.ndarray, position: np.ndarray) -> np.ndarray:
        key = (term << 32) | position
        at = np.searchsorted(self.keys, key)
        return (position >= 0) & (at < len(self.keys)) & (self.keys[np.minimum(at, len(self.keys) - 1)] == key)

    def within(self, term: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
        """Whether a term stands at a position in low..high."""
        at = np.searchsorted(self.keys, (term << 32) | np.maximum(low, 0))
        return (at < len(self.keys)) & (self.keys[np.minimum(at, len(self.keys) - 1)] <= ((term << 32) | high))

    def seeds(self, p: Phrases):
        """Phrases whose terms all occur, their term order (rarest first), and the positions of the
        rarest: (phrase, place of the rarest term in it, position)."""
        if not len(self.keys) or not len(p.rows):
            none = np.zeros(0, dtype=np.int64)
            return none, np.zeros((0, p.rows.shape[1]), np.int64), none, none
        count = np.where(p.rows >= 0, self.count[p.rows], np.iinfo(np.int64).max)
        alive = np.flatnonzero(count.min(axis=1) > 0)
        order = np.argsort(count[alive], axis=1, kind="stable")
        rare = p.rows[alive, order[:, 0]]
        n = self.count[rare]
        return (alive, order, np.repeat(np.arange(len(alive)), n),
                self.keys[ranges(self.begin[rare], n)] & 0xFFFFFFFF)

    def phrases(self, p: Phrases):
        """(phrase, start) of every exact occurrence."""
        alive, order, who, at = self.seeds(p)
        at = at - order[who, 0]
        for r in range(1, order.shape[1]):
            place = order[who, r]
            term = p.rows[alive[who], place]
            ok = (term < 0) | self.holds(np.maximum(term, 0), at + place)
            who, at = who[ok], at[ok]
        ok = at >= 0
        return alive[who[ok]], at[ok]

    def proximity(self, p: Phrases, slop: int, doc_low: np.ndarray, doc_high: np.ndarray):
        """(phrase, position) of its rarest term wherever all its other terms stand within ``slop``
        positions of it, in any order, in the same document."""
        alive, order, who, at = self.seeds(p)
        for r in range(1, order.shape[1]):
            term = p.rows[alive[who], order[who, r]]
            doc = np.searchsorted(doc_low, at, side="right") - 1
            ok = (term < 0) | self.within(np.maximum(term, 0), np.maximum(at - slop, doc_low[doc]), np.minimum(at + slop, doc_high[doc]))
            who, at = who[ok], at[ok]
        return alive[who], at


def _shard_hits(col: dict, i: int, p: Phrases, slop: int | None, out: tuple[list, ...]) -> None:
    """Adds doc_id, text_hash, items and spans of the documents of index row ``i`` that hold a phrase."""
    view = lambda c, t: np.frombuffer(col[c][i].as_buffer(), dtype=t)
    shard = Shard(view("terms", U64), view("begins", np.uint32), view("positions", np.uint32), p.terms)
    first = np.array(col["first"][i].as_py(), dtype=np.int64)
    n = np.array(col["n_words"][i].as_py(), dtype=np.int64)
    some = np.flatnonzero(n > 0)
    if slop is None:
        who, at = shard.phrases(p)
        size = p.length[who]
    else:
        who, at = shard.proximity(p, slop, first[some], first[some] + n[some] - 1)
        size = np.ones(len(who), dtype=np.int64)
    if not len(who):
        return
    cover = np.zeros(int(first[-1] + n[-1]) + 2, dtype=np.int32)
    np.add.at(cover, at, 1)
    np.add.at(cover, at + size, -1)
    edge = np.diff(np.concatenate([[0], (np.cumsum(cover) > 0).astype(np.int8)]))
    opens, closes = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    doc, span_doc = some[np.searchsorted(first[some], at, "right") - 1], some[np.searchsorted(first[some], opens, "right") - 1]
    docs_, hashes = col["doc_ids"][i].as_py(), col["text_hashes"][i].as_py()
    for d in np.unique(doc).tolist():
        mine = span_doc == d
        out[0].append(docs_[d])
        out[1].append(hashes[d])
        out[2].append(sorted({x for x in p.item[who[doc == d]] if x is not None}))
        out[3].append((np.column_stack([opens[mine], closes[mine]]).ravel() - first[d]).tolist())


def _hit_batch(out: tuple[list, ...]) -> pa.RecordBatch:
    kinds = pa.int64(), pa.int64(), pa.list_(pa.int64()), pa.list_(pa.int32())
    return pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(out, kinds)], names=["doc_id", "text_hash", "items", "spans"])


def _match_shared(index: DataFrame, blocks: list[Phrases], slop: int | None) -> DataFrame:
    """Hits of a few blocks, which all tasks get, in one pass over the index."""
    shared = index.sparkSession.sparkContext.broadcast(blocks)  # at most SHARED_BLOCKS

    def run(batches):
        for b in batches:
            out, col = ([], [], [], []), {c: ids(b, c) for c in b.schema.names}
            for i in range(b.num_rows):
                for p in shared.value:
                    _shard_hits(col, i, p, slop, out)
            yield _hit_batch(out)

    return index.mapInArrow(lean(run), MATCHES)


def _match_joined(index: DataFrame, blocks: DataFrame, slop: int | None, group_shards: int) -> DataFrame:
    """Hits of any number of blocks: shards are dealt to groups, and each group gets every block once."""
    groups = max(1, -(-index.count() // group_shards))
    shards = index.withColumn("deal", F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(groups)))
    copies = blocks.select(*(F.col(c).alias(f"p_{c}") for c in blocks.columns),
                           F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(groups - 1).cast("bigint"))).alias("deal"))

    def run(batches):
        for b in batches:
            col = {c: ids(b, c) for c in b.schema.names}
            for i in range(b.num_rows):
                out = [], [], [], []
                p = Phrases.unpack(*(col[f"p_{c}"][i].as_buffer() for c in ("terms", "places", "lengths")), col["p_items"][i].as_py())
                _shard_hits(col, i, p, slop, out)
                yield _hit_batch(out)

    return shards.join(copies, "deal").mapInArrow(lean(run), MATCHES)


def matches(index: DataFrame, benchmark: DataFrame, window: int = WINDOW, slop: int | None = None,
            block_windows: int = BLOCK_WINDOWS, shared_blocks: int = SHARED_BLOCKS, group_shards: int = GROUP_SHARDS) -> DataFrame:
    """``doc_id, text_hash, items, spans``: documents that hold a test phrase (a window of an item's
    words, or all of a shorter item), the items, and the word ranges (start, end, start, end, ..)
    hit. With ``slop``: proximity matches, whose ranges are the rarest terms' places.

    The benchmark is cut into blocks of bounded size. Up to ``shared_blocks`` of them are sent to all
    tasks; more are joined to the index, ``group_shards`` shards a copy. Either way the rows of several
    blocks are merged by document. Items without words match nothing; of an item without item_id only
    the ranges count."""
    blocks = materialize(phrase_blocks(benchmark, window, block_windows), "phrases")
    if blocks.count() <= shared_blocks:
        packed = [Phrases.unpack(bytes(r["terms"]), bytes(r["places"]), bytes(r["lengths"]), r["items"]) for r in blocks.collect()]
        out = _match_shared(index, packed, slop)
    else:
        out = _match_joined(index, blocks, slop, group_shards)
    merged = out.groupBy("doc_id", "text_hash").agg(F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items"),
                                                    F.collect_list("spans").alias("spans"))

    def union(batches):
        for b in batches:
            spans = []
            for parts in ids(b, "spans").to_pylist():
                pairs = sorted((s[i], s[i + 1]) for s in parts for i in range(0, len(s), 2))
                joined: list[list[int]] = []
                for a, z in pairs:
                    if joined and a <= joined[-1][1]:
                        joined[-1][1] = max(joined[-1][1], z)
                    else:
                        joined.append([a, z])
                spans.append([x for pair in joined for x in pair])
            yield pa.RecordBatch.from_arrays([ids(b, "doc_id"), ids(b, "text_hash"), ids(b, "items"), pa.array(spans, pa.list_(pa.int32()))],
                                             names=["doc_id", "text_hash", "items", "spans"])

    return merged.mapInArrow(lean(union), MATCHES)


def decontaminate(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """``doc_id, n_words, n_hit, n_items, items_sha256, contaminated`` of every document.

    Null text has no words. Repeated rows get a row each; other columns are ignored; an empty table
    gives an empty result, an empty benchmark hits nothing. The index is written once."""
    index = materialize(build_index(docs), "postings")
    hits = matches(index, benchmark, window)
    all_docs = index.select(F.explode(F.arrays_zip("doc_ids", "text_hashes", "n_words")).alias("d")).select(
        F.col("d.doc_ids").alias("doc_id"), F.col("d.text_hashes").alias("text_hash"), F.col("d.n_words").alias("n_words"))
    n_hit = F.aggregate(F.transform("spans", lambda x, i: F.when(i % 2 == 1, x).otherwise(-x)), F.lit(0).cast("bigint"), lambda a, x: a + x)
    hits = hits.select(F.col("doc_id").alias("_d"), F.col("text_hash").alias("_t"), n_hit.alias("n_hit"), "items")
    joined = all_docs.join(hits, F.col("doc_id").eqNullSafe(F.col("_d")) & (F.col("text_hash") == F.col("_t")), "left")
    items = F.coalesce("items", F.array().cast("array<bigint>"))
    names = F.array_join(F.array_sort(F.transform(items, lambda x: x.cast("string"))), ",")
    return joined.select("doc_id", "n_words", F.coalesce("n_hit", F.lit(0)).cast("bigint").alias("n_hit"),
                         F.size(items).cast("bigint").alias("n_items"), F.sha2(names.cast("binary"), 256).alias("items_sha256"),
                         (F.coalesce("n_hit", F.lit(0)) > 0).alias("contaminated"))


def keep_clean(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """The rows of ``docs`` without any hit, all their columns."""
    index = materialize(build_index(docs), "postings")
    hits = materialize(matches(index, benchmark, window).select(F.col("doc_id").alias("_d"), F.col("text_hash").alias("_t")), "hits")
    whole = docs.select(F.struct("*").alias("_llm_row"), F.col("doc_id").alias("_llm_id"), F.xxhash64("text").alias("_llm_hash"))
    return whole.join(hits, F.col("_llm_id").eqNullSafe(F.col("_d")) & (F.col("_llm_hash") == F.col("_t")), "left_anti").select("_llm_row.*")


ORACLE = r"""
with dw as (select doc_id, n, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as w from (select *, row_number() over () as n from documents)),
bw as (select item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as w from benchmark),
win as (select distinct item_id, array_to_string(w[i : i + 9], ' ') as g, least(len(w), 10) as k
      from (select item_id, w, unnest(range(1, greatest(len(w) - 9, 1) + 1)) as i from bw where len(w) > 0)),
sizes as (select distinct k from win),
dg as (select n, i, k, array_to_string(w[i : i + k - 1], ' ') as g
      from (select n, w, unnest(range(1, len(w) + 1)) as i from dw) cross join sizes where i + k - 1 <= len(w)),
hit as (select n, i, dg.k, item_id from dg join win using (g, k)),
words as (select n, count(distinct p) as n_hit from (select n, unnest(range(i, i + k)) as p from (select distinct n, i, k from hit)) group by n),
items as (select n, count(*) as n_items, string_agg(x, ',' order by x) as names from (select distinct n, item_id::varchar as x from hit) group by n)
select doc_id, len(w)::bigint as n_words, coalesce(n_hit, 0)::bigint as n_hit, coalesce(n_items, 0)::bigint as n_items,
      sha256(coalesce(names, '')) as items_sha256, coalesce(n_hit, 0) > 0 as contaminated
from dw left join words using (n) left join items using (n)"""
