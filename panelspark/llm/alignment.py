"""Alignment of two tokenizers (operator 13) by galloping intersection of their token ends.

Both tokenizers cut the same bytes, so a token sequence is a rising list of byte ends. The shorter list
is looked up in the longer one: an exponential search from the place as far along, then a binary search
in the range it found (``gallop``, the look-ups of some documents in step). Common ends cut both sequences
into groups; differences of their ranks in the lists say which tokens each group holds.

How many documents hold an id pair linked is counted over the corpus. Every document needs the counts
of all its pairs again: the most frequent pairs, a fixed number of them, travel to every task; the rest,
none of which is frequent, are joined. So no key is hot and no broadcast grows.
"""

from __future__ import annotations

import hashlib
from array import array

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from panelspark.llm.common import ids, kth_largest, lean, materialize, release, rows
from panelspark.llm.text import ranges
from panelspark.llm.tokens import _LONE_SPACE, BYTE_LETTERS, Encoder

SPACE = "▁"  # a piece's space
MEMO = 250_000  # pieces a worker remembers of each tokenizer
HOT_PAIRS = 1 << 18  # pairs whose counts every task holds: 5 MB
WIDE = 1 << 16  # a group of more links than this is counted by distinct ids


class PlainEncoder(Encoder):
    """A byte-level tokenizer's ids of whole texts; its special tokens' strings are plain text."""

    _open: dict[str, Encoder] = {}

    def __init__(self, path: str):
        super().__init__(path)
        self.tokenizer.encode_special_tokens = True
        letters = {chr(v): k for k, v in BYTE_LETTERS.items()}
        vocabulary = self.tokenizer.get_vocab()
        self.content = [b""] * (max(vocabulary.values()) + 1)
        for t, i in vocabulary.items():
            self.content[i] = bytes(letters.get(c, ord(c) & 255) for c in t)


class PieceEncoder:
    """Ids of whole texts by a sentencepiece model, equal to encoding each text at once: no piece
    holds a space behind another character, nor a line feed beside one, so texts are cut there and
    the ids of the cuts are remembered."""

    _open: dict[str, PieceEncoder] = {}

    def __init__(self, path: str):
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        pieces = [self.model.id_to_piece(i) for i in range(self.model.get_piece_size())]
        self.content = [bytes([int(p[3:5], 16)]) if self.model.is_byte(i) else p.replace(SPACE, " ").encode() for i, p in enumerate(pieces)]
        self.space = self.model.piece_to_id(SPACE)
        ordinary = [p for i, p in enumerate(pieces) if not self.model.is_byte(i)]
        self.cuts = not any(SPACE in p.lstrip(SPACE) or ("\n" in p and p != "\n") for p in ordinary)
        self.limit = MEMO
        self.memo: dict[str, bytes] = {}  # words behind a space, or runs that begin with one
        self.lines: dict[str, bytes] = {}  # words behind a line feed

    @classmethod
    def open(cls, path: str, memo: int = MEMO) -> PieceEncoder:
        if path not in cls._open:
            cls._open[path] = cls(path)
        cls._open[path].limit = memo
        return cls._open[path]

    def _whole(self, text: str) -> bytes:
        return array("H", self.model.encode(text)).tobytes()

    def _word(self, w: str) -> bytes:
        got = self.memo.get(w)
        if got is None:
            head, feed, tail = w.partition("\n")
            # behind a space a line feed leaves the space a token of its own
            got = self._whole(w) if not feed else (self._whole(head) if head else array("H", [self.space]).tobytes()) + self._line(tail)
            if len(w) <= 64 and len(self.memo) + len(self.lines) < self.limit:
                self.memo[w] = got
        return got

    def _line(self, w: str) -> bytes:
        """Ids of a line feed and what follows it up to the next space."""
        got = self.lines.get(w)
        if got is None:
            head, feed, tail = w.partition("\n")
            got = self._whole("\n" + head)[2:] + (self._line(tail) if feed else b"")  # less the space before it
            if len(w) <= 64 and len(self.memo) + len(self.lines) < self.limit:
                self.lines[w] = got
        return got

    def encode(self, text: str) -> np.ndarray:
        if not text:
            return np.zeros(0, dtype="<u2")
        if not self.cuts or text.count("\n") > 500 + len(text) // 4:
            return np.frombuffer(self._whole(text), dtype="<u2")
        pieces = text.split(" ") if "  " not in text and text[0] != " " and text[-1] != " " else _LONE_SPACE.split(text)
        got = list(map(self.memo.get, pieces))
        if None in got:
            got = [self._word(p) if x is None else x for p, x in zip(pieces, got)]
        return np.frombuffer(b"".join(got), dtype="<u2")


def gallop(short: np.ndarray, long: np.ndarray, near: np.ndarray) -> np.ndarray:
    """For each value of the rising list ``short``: the first place in the rising list ``long`` whose
    value isn't less (``len(long)``, if none). From its place ``near`` each value steps up or down, twice
    as far each time, until it is passed; a binary search between the last two steps ends it. All
    values go in step, those that are through drop out."""
    n = len(long)
    low, high = np.zeros(len(short), dtype=np.int64), np.full(len(short), n)
    if not n or not len(short):
        return low
    near = np.clip(near, 0, n - 1)
    less = long[near] < short
    for up in (True, False):
        todo = np.flatnonzero(less == up)
        at, v, step = near[todo], short[todo], 1
        (low if up else high)[todo] = at + up
        while len(todo):
            at = at + step if up else at - step
            on = (at < n) & (long[np.minimum(at, n - 1)] < v) if up else (at >= 0) & (long[np.maximum(at, 0)] >= v)
            passed = todo[~on]
            (high if up else low)[passed] = np.minimum(at[~on], n) if up else np.maximum(at[~on] + 1, 0)
            todo, at, v, step = todo[on], at[on], v[on], 2 * step
            (low if up else high)[todo] = at + up
    todo = np.flatnonzero(low < high)
    while len(todo):
        mid = (low[todo] + high[todo]) >> 1
        less = long[mid] < short[todo]
        low[todo[less]] = mid[less] + 1
        high[todo[~less]] = mid[~less]
        todo = todo[low[todo] < high[todo]]
    return low


def common_ranks(a: np.ndarray, b: np.ndarray, count_a: np.ndarray, count_b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Ranks, in each of two rising lists, of the values that are in both. The lists are runs of
    documents, with so many tokens each; a look-up starts as far along in its document's run in the
    longer list as the value stands in the shorter one's."""
    swap = len(a) > len(b)
    short, long, m, n = (b, a, count_b, count_a) if swap else (a, b, count_a, count_b)
    first, into = np.cumsum(m) - m, np.cumsum(n) - n
    local = np.arange(len(short)) - np.repeat(first, m)
    near = np.repeat(into, m) + local * np.repeat(n, m) // np.maximum(np.repeat(m, m), 1)
    at = gallop(short, long, near)
    hit = np.flatnonzero(at < len(long))
    hit = hit[long[at[hit]] == short[hit]]
    return (at[hit], hit) if swap else (hit, at[hit])


def links(a: np.ndarray, b: np.ndarray, na: np.ndarray, nb: np.ndarray, doc: np.ndarray, width_a: int, width_b: int):
    """(document, ``a * width_b + b``, how often linked) of each document's distinct linked pairs, by
    document and pair. Groups hold ``na`` and ``nb`` tokens and lie in documents ``doc``. A wide group is
    counted by its distinct ids, so it takes as much room as it has distinct pairs, not links."""
    begin_a, begin_b = np.cumsum(na) - na, np.cumsum(nb) - nb
    product, space = na * nb, width_a * width_b
    base = doc * space
    one = product == 1
    keys, times = [base[one] + a[begin_a[one]] * width_b + b[begin_b[one]]], [np.ones(int(one.sum()), dtype=np.int64)]
    some = np.flatnonzero((product > 1) & (product <= WIDE))
    if len(some):
        each_a = ranges(begin_a[some], na[some])
        follow = np.repeat(nb[some], na[some])  # every A token meets all B tokens of its group
        each_b = ranges(np.repeat(begin_b[some], na[some]), follow)
        keys.append(np.repeat(np.repeat(base[some], na[some]) + a[each_a] * width_b, follow) + b[each_b])
        times.append(np.ones(len(each_b), dtype=np.int64))
    for g in np.flatnonzero(product > WIDE):
        ua, ca = np.unique(a[begin_a[g] : begin_a[g] + na[g]], return_counts=True)
        ub, cb = np.unique(b[begin_b[g] : begin_b[g] + nb[g]], return_counts=True)
        keys.append((base[g] + ua[:, None] * width_b + ub).ravel())
        times.append((ca[:, None] * cb).ravel())
    keys, times = np.concatenate(keys), np.concatenate(times)
    order = np.argsort(keys)
    keys, times = keys[order], times[order]
    first = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]]) if len(keys) else np.zeros(0, dtype=np.int64)
    keys = keys[first]
    return keys // space, keys % space, np.add.reduceat(times, first) if len(first) else times


class Aligner:
    """Aligns whole texts with two tokenizers' files."""

    def __init__(self, path_a: str, path_b: str, memo: int = MEMO):
        self.a, self.b = PlainEncoder.open(path_a, memo), PieceEncoder.open(path_b, memo)
        self.size_a, self.size_b = (np.array([len(c) for c in e.content], dtype=np.int64) for e in (self.a, self.b))
        # an id as text, in each of the four places it can stand in
        self.said = [b"%d%s" % (i, end) for e, ends in ((self.a, (b",", b"|")), (self.b, (b",", b";"))) for end in ends for i in range(len(e.content))]

    def tokens(self, text: str | None) -> tuple[np.ndarray, np.ndarray]:
        """Both id lists; empty ones where a list's bytes aren't those of space + text."""
        none = np.zeros(0, dtype=np.int64)
        if not text or SPACE in text:  # that character comes back as a space
            return none, none
        whole = (" " + text).encode()
        a = np.frombuffer(self.a.encode(" " + text), dtype=self.a.type)
        b = self.b.encode(text)
        for e, got in ((self.a, a), (self.b, b)):
            if b"".join(map(e.content.__getitem__, got.tolist())) != whole:
                return none, none
        return a, b

    def align(self, texts: list[str | None]) -> list[tuple]:
        """(n_a, n_b, n_groups, n_links, sha256 or '', pairs, times) of each text."""
        both = [self.tokens(t) for t in texts]
        ca, cb = (np.array([len(x[i]) for x in both], dtype=np.int64) for i in (0, 1))
        a, b = (np.concatenate([x[i] for x in both]).astype(np.int64) if both else np.zeros(0, np.int64) for i in (0, 1))
        ra, rb = common_ranks(np.cumsum(self.size_a[a]), np.cumsum(self.size_b[b]), ca, cb)
        na, nb = np.diff(ra, prepend=-1), np.diff(rb, prepend=-1)
        doc = np.repeat(np.arange(len(texts)), ca)[ra]
        where, pairs, times = links(a, b, na, nb, doc, len(self.a.content), len(self.b.content))
        # where each token stands when a group's A ids are followed by its B ids
        wa, wb = len(self.a.content), len(self.b.content)
        last_a, last_b = np.zeros(len(a), np.int64), np.zeros(len(b), np.int64)
        last_a[ra] = last_b[rb] = 1
        said = np.empty(len(a) + len(b), dtype=np.int64)
        said[np.arange(len(a)) + np.repeat(rb + 1 - nb, na)] = a + last_a * wa
        said[np.arange(len(b)) + np.repeat(ra + 1, nb)] = b + 2 * wa + last_b * wb
        texts_, end = list(map(self.said.__getitem__, said.tolist())), np.cumsum(ca + cb).tolist()
        cut = np.searchsorted(where, np.arange(len(texts) + 1)).tolist()
        groups = np.bincount(doc, minlength=len(texts)).tolist()
        linked_ = np.bincount(doc, weights=(na * nb).astype(np.float64), minlength=len(texts))  # exact below 2**53
        out = []
        for i in range(len(texts)):
            if not ca[i]:
                out.append((0, 0, 0, 0, "", pairs[:0], times[:0]))
                continue
            digest = hashlib.sha256(b"".join(texts_[end[i - 1] if i else 0 : end[i]])[:-1]).hexdigest()
            out.append((int(ca[i]), int(cb[i]), groups[i], int(linked_[i]), digest, pairs[cut[i] : cut[i + 1]], times[cut[i] : cut[i + 1]]))
        return out


ROWS = ("tag bigint, doc_id bigint, n_a bigint, n_b bigint, n_groups bigint, n_links bigint, groups_sha256 string, "
        "pairs array<bigint>, times array<bigint>")
_LIST = pa.list_(pa.int64())


def _lists(parts: list[np.ndarray]) -> pa.Array:
    offsets = np.cumsum([0, *map(len, parts)]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate(parts) if parts else np.zeros(0, np.int64), pa.int64()))


def _slices(pairs, docs: int = 64, chars: int = 1 << 18):
    """Lists of (doc_id, text) of so many rows and, but for one longer text, characters."""
    some, size = [], 0
    for d, t in pairs:
        if some and (len(some) >= docs or size + len(t or "") > chars):
            yield some
            some, size = [], 0
        some.append((d, t))
        size += len(t or "")
    if some:
        yield some


def linked(docs: DataFrame, path_a: str, path_b: str, memo: int = MEMO) -> DataFrame:
    """One row a document, ``ROWS``: its alignment and its distinct linked pairs; ``tag`` numbers the
    rows, so the result must be written before it is used."""

    def run(batches):
        aligner, at = Aligner(path_a, path_b, memo), TaskContext.get().partitionId() << 40
        out, size = [], 0

        def flush():
            cols = list(zip(*out))
            kinds = [pa.int64()] * 6 + [pa.string()]
            return pa.RecordBatch.from_arrays([*(pa.array(c, t) for c, t in zip(cols, kinds)), _lists(cols[7]), _lists(cols[8])],
                                              names=[f.split()[0] for f in ROWS.split(", ")])

        for b in batches:
            for some in _slices(rows(b, "doc_id", "text", size=64)):
                for (d, _), got in zip(some, aligner.align([t for _, t in some])):
                    out.append((at, d, *got))
                    at, size = at + 1, size + len(got[-1])
                if size > 1 << 19 or len(out) >= 4096:
                    yield flush()
                    out, size = [], 0
        if out:
            yield flush()

    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text").mapInArrow(lean(run), ROWS)


def pair_counts(table: DataFrame, width: int) -> DataFrame:
    """``pair, n, best``: in how many rows a pair is linked, and whether no pair of its A id is in more."""
    n = table.select(F.explode("pairs").alias("pair")).groupBy("pair").agg(F.count(F.lit(1)).alias("n"))
    of_a = Window.partitionBy(F.expr(f"pair div {width}"))  # at most ``width`` pairs
    return n.withColumn("best", F.col("n") == F.max("n").over(of_a))


def align(docs: DataFrame, path_a: str, path_b: str, hot_pairs: int = HOT_PAIRS, memo: int = MEMO) -> DataFrame:
    """``doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256``: one row a document.

    Null and empty texts, and those whose tokens' bytes aren't space + text (any text with U+2581), have
    no tokens: zeros and ''. Repeated rows, and rows without doc_id, are documents each and count as
    such; other columns are ignored; an empty table gives an empty result."""
    spark = docs.sparkSession
    width = len(PieceEncoder.open(path_b).content)
    table = materialize(linked(docs, path_a, path_b, memo), "linked")
    counts = materialize(pair_counts(table, width), "pairs")
    least = kth_largest(counts, "n", hot_pairs + 1)  # pairs above it are at most ``hot_pairs``
    frequent = F.lit(True) if least is None else F.col("n") > least
    top = sorted((r["pair"], r["n"], r["best"]) for r in counts.where(frequent).toLocalIterator())
    shared = spark.sparkContext.broadcast(tuple(np.array([r[i] for r in top], dtype=np.int64) for i in range(3)))

    def known(batches):
        pair, n, best = shared.value
        for b in batches:
            col, times = ids(b, "pairs"), ids(b, "times")
            size = np.diff(col.offsets.to_numpy())
            p, t = (x.flatten().to_numpy(zero_copy_only=False).astype(np.int64) for x in (col, times))
            at = np.minimum(np.searchsorted(pair, p), max(len(pair) - 1, 0))
            hit = pair[at] == p if len(pair) else np.zeros(len(p), bool)
            row = np.repeat(np.arange(len(size)), size)
            sums = []
            for value in (n, best):
                add = np.zeros(len(p), dtype=np.int64)
                add[hit] = t[hit] * value[at[hit]]
                cum = np.concatenate([[0], np.cumsum(add)])
                end = np.cumsum(size)
                sums.append(cum[end] - cum[end - size])
            rest = np.concatenate([[0], np.cumsum(np.bincount(row[~hit], minlength=len(size)))]).astype(np.int32)
            rare = [pa.ListArray.from_arrays(pa.array(rest), pa.array(x[~hit], pa.int64())) for x in (p, t)]
            keep = ["tag", "doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256"]
            yield pa.RecordBatch.from_arrays([*(ids(b, c) for c in keep), pa.array(sums[0], pa.int64()), pa.array(sums[1], pa.int64()), *rare],
                                             names=[*keep, "sum_hot", "best_hot", "pairs", "times"])

    scored = materialize(table.mapInArrow(lean(known), ROWS.replace("pairs array", "sum_hot bigint, best_hot bigint, pairs array")), "scored")
    release(table)
    if least is None:
        extra = scored.select("tag", F.lit(0).cast("bigint").alias("s"), F.lit(0).cast("bigint").alias("k")).limit(0)
    else:
        rare = scored.select("tag", F.explode(F.arrays_zip("pairs", "times")).alias("x")).select("tag", F.col("x.pairs").alias("pair"), "x.times")
        extra = (rare.join(counts.where(~frequent), "pair").groupBy("tag")
                 .agg(F.sum(F.col("times") * F.col("n")).alias("s"), F.sum(F.when(F.col("best"), F.col("times")).otherwise(0)).alias("k")))
    joined = scored.drop("pairs", "times").join(extra, "tag", "left")
    return joined.select("doc_id", "n_a", "n_b", "n_groups", "n_links", (F.col("best_hot") + F.coalesce("k", F.lit(0))).alias("n_best"),
                         (F.col("sum_hot") + F.coalesce("s", F.lit(0))).alias("count_sum"), "groups_sha256")
