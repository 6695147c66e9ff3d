"""Order-preserving packing (operator 7).

Documents in ascending doc_id order form one stream of ids, which is cut into windows of at most
``size`` ids. Cutting at the end of a document is free, at the end of a sentence or in a long
sentence it costs a truncation penalty; a window costs its padding up to ``size``, or none if its
length is a power of two. Dynamic programming finds the cuts of least total cost: with f(j) the
cost up to cut j at position p_j, f(i) = min over p_j >= p_i - size of f(j) + p_j + size - p_i, a
sliding minimum that a monotone queue holds, or f(j) itself where p_i - p_j is a power of two.
"""

from __future__ import annotations

import zlib
from collections import deque
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame

from panelspark.llm.common import lean, rows
from panelspark.llm.tokens import MEMO, Encoder, in_order

SIZE = 1024
END_ID = 0
SENTENCE, MIDDLE, OPEN = 1.0, 4.0, 4.0  # penalty of a cut after a sentence, inside one; cost of a window
APART = 8  # sentence ends nearer than this to the last cut place are left out
STEP = 32  # cut places inside a longer sentence
BLOCK = 1 << 18  # ids planned at once
SHARD_BITS = 36  # sequence_id = task << SHARD_BITS | number


@lru_cache
def sentence_ends(path: str) -> np.ndarray:
    """By id: whether the token ends a sentence or a line."""
    t = Encoder.open(path).tokenizer
    out = np.zeros(t.get_vocab_size(), dtype=bool)
    for token, i in t.get_vocab().items():
        out[i] = token.endswith((".", "!", "?")) or "Ċ" in token  # the byte-level letter of a line feed
    return out


def cut_places(ends_sentence: np.ndarray, doc_ends: np.ndarray):
    """Positions where the stream may be cut, ascending, and the penalty of each. ``ends_sentence``:
    by id of the stream; ``doc_ends``: positions after documents (the last is the stream's end)."""
    soft = np.flatnonzero(ends_sentence) + 1
    known = np.union1d(soft, doc_ends)
    hard = np.isin(known, doc_ends)
    keep, last = hard.copy(), 0
    for k, (at, free) in enumerate(zip(known.tolist(), hard.tolist())):
        if free or at - last >= APART:
            keep[k], last = True, at
    known, hard = known[keep], hard[keep]
    gaps = np.diff(np.concatenate([[0], known]))
    wide = np.flatnonzero(gaps > STEP)
    inner = [np.arange(known[i] - gaps[i] + STEP, known[i], STEP) for i in wide]
    middle = np.concatenate(inner) if inner else np.zeros(0, dtype=np.int64)
    at = np.concatenate([known, middle])
    cost = np.concatenate([np.where(hard, 0.0, SENTENCE), np.full(len(middle), MIDDLE)])
    order = np.argsort(at, kind="stable")
    return at[order], cost[order]


def plan(places: np.ndarray, cost: np.ndarray, size: int = SIZE) -> list[int]:
    """Cut positions of least total cost, the last place included (it is free)."""
    p = np.concatenate([[0], places])
    exact: list[list[int]] = [[] for _ in p]
    k = 1
    while k <= size:
        j = np.searchsorted(p, p - k)
        for i in np.flatnonzero((p >= k) & (p[np.minimum(j, len(p) - 1)] == p - k)).tolist():
            exact[i].append(int(j[i]))
        k *= 2
    pos, pen = p.tolist(), [0.0, *cost.tolist()]
    pen[-1] = 0.0
    f, back = [0.0] * len(pos), [0] * len(pos)
    queue: deque[int] = deque([0])
    key = [0.0] * len(pos)  # f + position, ascending along the queue
    for i in range(1, len(pos)):
        at = pos[i]
        low = at - size
        while pos[queue[0]] < low:
            queue.popleft()
        j = queue[0]
        best = key[j] + size - at
        for e in exact[i]:
            if f[e] < best:
                best, j = f[e], e
        best += pen[i] + OPEN
        f[i], back[i] = best, j
        best += at
        key[i] = best
        while queue and key[queue[-1]] >= best:
            queue.pop()
        queue.append(i)
    cuts, i = [], len(pos) - 1
    while i:
        cuts.append(pos[i])
        i = back[i]
    return cuts[::-1]


PIECES = pa.schema([(c, pa.int64()) for c in ("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id",
                                              "offset", "sequence_tokens", "padding")])


class Packer:
    """Feeds one task's documents through the plan, a block at a time. What the last window of a
    block holds goes on into the next block, so block ends leave no padding."""

    def __init__(self, ends: np.ndarray, size: int = SIZE, block: int = BLOCK, first: int = 0):
        self.ends, self.size, self.block, self.sequence = ends, size, block, first
        self.parts: list[np.ndarray] = []
        self.docs: list[tuple] = []  # doc_id, ids of the document before this part, ids of it all, length here
        self.held = 0

    def add(self, doc_id, ids_: np.ndarray):
        """Take a document in; yields batches of pieces."""
        for lo in range(0, len(ids_), self.block):  # a document longer than a block comes in parts
            part = ids_[lo : lo + self.block]
            self.parts.append(part)
            self.docs.append((doc_id, lo, len(ids_), len(part)))
            self.held += len(part)
            if self.held >= self.block:
                yield self.flush(last=False)

    def flush(self, last: bool = True) -> pa.RecordBatch:
        stream = np.concatenate(self.parts) if self.parts else np.zeros(0, dtype=np.uint16)
        if not len(stream):
            return pa.RecordBatch.from_pylist([], PIECES)
        doc_ends = np.cumsum([d[3] for d in self.docs])
        cuts = np.array(plan(*cut_places(self.ends[stream], doc_ends), self.size))
        if not last and len(cuts) > 1:
            cuts = cuts[:-1]
        done = int(cuts[-1])
        edges = np.union1d(cuts, doc_ends[doc_ends < done])
        starts = np.concatenate([[0], edges[:-1]])
        doc = np.searchsorted(doc_ends, starts, side="right")
        window = np.searchsorted(cuts, starts, side="right")
        opens = np.concatenate([[0], cuts[:-1]])
        doc_starts = doc_ends - np.array([d[3] for d in self.docs])
        wide = stream.astype("<u4")
        total = cuts - opens
        padding = np.where((total & (total - 1)) == 0, 0, self.size - total)
        out = pa.RecordBatch.from_arrays([
            pa.array([self.docs[k][0] for k in doc], pa.int64()),
            pa.array(starts - doc_starts[doc] + np.array([self.docs[k][1] for k in doc])),
            pa.array(edges - starts),
            pa.array([zlib.crc32(wide[a:b].tobytes()) for a, b in zip(starts.tolist(), edges.tolist())], pa.int64()),
            pa.array([self.docs[k][2] for k in doc], pa.int64()),
            pa.array(self.sequence + window), pa.array(starts - opens[window]),
            pa.array(total[window]), pa.array(padding[window])], schema=PIECES)
        self.sequence += len(cuts)
        k = int(np.searchsorted(doc_ends, done, side="right"))
        self.parts = [stream[done:]] if done < len(stream) else []
        rest = [(d, b, n, m) for d, b, n, m in self.docs[k:]]
        if rest and done > doc_starts[k]:
            used = done - int(doc_starts[k])
            rest[0] = (rest[0][0], rest[0][1] + used, rest[0][2], rest[0][3] - used)
        self.docs, self.held = rest, len(stream) - done
        return out


def pack(docs: DataFrame, path: str, end_id: int = END_ID, size: int = SIZE, memo: int = MEMO,
         remember: bool = True) -> DataFrame:
    """One row a piece: ``doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset`` and the
    sequence's ``sequence_tokens`` and ``padding``.

    Null and empty texts are documents of the end id alone; rows without doc_id come first;
    repeated rows are packed each; other columns are ignored; an empty table gives an empty result.
    One range shuffle of the texts; a task plans ``BLOCK`` ids at a time. ``memo``: token pieces a
    worker remembers, time for memory. ``remember``: also from one task to the next; else a task's end
    frees them for the stages that follow.
    """
    if size < 1 or size & (size - 1):
        raise ValueError("size must be a power of two")

    def run(batches):
        enc = Encoder.open(path, memo)
        packer = Packer(sentence_ends(path), size, first=TaskContext.get().partitionId() << SHARD_BITS)
        for b in batches:
            for d, t in rows(b, "doc_id", "text"):
                yield from packer.add(d, np.append(np.frombuffer(enc.encode(t), dtype=enc.type), enc.type.type(end_id)))
        yield packer.flush()
        if not remember:
            enc.forget()

    schema = ", ".join(f"{c} bigint" for c in PIECES.names)
    return in_order(docs).mapInArrow(lean(run), schema)
