"""Quality classifier by importance resampling (operator 3).

Two generative models over hashed n-grams, one of the target text (documents labelled good), one
of all raw text, give each document a log ratio per n-gram. That n-grams are not independent is
corrected on labelled documents that the target model has not seen: a logistic curve turns the
ratio into the share of good documents at it, P. Because raw text is a mixture that holds the
target with share p, the importance weight target / raw of a document is then P / p. k = the sum
of P is how many documents come from the target, and the k documents with the largest log weight +
Gumbel noise are sampled.

N-grams: character trigrams, and pairs of repetition marks (how many words back the same word
stood, 0 if not among the last 8), which tell looping text from prose.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelspark.llm.common import count_slots, ids, kth_largest, lean, logistic, materialize, release
from panelspark.llm.langid import document_sums
from panelspark.llm.text import mix, ranges, slices, span_hashes, words

CHAR_SLOTS = 1 << 16
BACK = 8
MARK_SLOTS = (BACK + 1) ** 2
SLOTS = CHAR_SLOTS + MARK_SLOTS
ALPHA = 3.0
CLIP = 0.6  # log ratios per n-gram beyond this say no more
FEW = 20  # n-grams added to a document's number, for short texts say little
FIT_ROWS = 20_000  # labelled documents the target model learns from, and as many the curve is fitted on
SEED = 20240229


def document_slots(buf: np.ndarray, offsets: np.ndarray):
    """Slots of all n-grams with start and number by document: of trigrams, and of mark pairs."""
    b = np.append(buf, [0x20, 0x20]).astype(np.uint32)
    h = b[:-2] * np.uint32(0x9E3779B1) + b[1:-1] * np.uint32(0x85EBCA77) + b[2:] * np.uint32(0xC2B2AE3D)
    h ^= h >> np.uint32(15)
    h *= np.uint32(0x2C1B3C6D)
    yield h >> np.uint32(16), offsets[:-1], np.maximum(np.diff(offsets) - 2, 0)
    s, e, first = words(buf, offsets)
    wh = span_hashes(buf, s, e)
    mark = np.zeros(len(wh), dtype=np.int64)
    place = np.arange(len(wh)) - np.repeat(first[:-1], np.diff(first))
    for d in range(BACK, 0, -1):
        same = np.flatnonzero(wh[d:] == wh[:-d]) + d if len(wh) > d else np.zeros(0, np.int64)
        mark[same[place[same] >= d]] = d
    yield CHAR_SLOTS + mark[:-1] * (BACK + 1) + mark[1:], first[:-1], np.maximum(np.diff(first) - 1, 0)


def _count(batch, acc):
    for _, _, buf, off in slices(batch):
        for slots, start, n in document_slots(buf, off):
            if n.sum():
                acc[0] += np.bincount(slots[ranges(start, n)], minlength=SLOTS)


@dataclass
class Model:
    log_ratio: np.ndarray
    share: float  # of the target in raw text
    curve: tuple[float, float] = (0.0, 40.0)  # P = logistic(slope * ratio + shift)

    def log_weight(self, total: np.ndarray, n: np.ndarray) -> np.ndarray:
        """log(P / p) by a document's summed log ratio and number of n-grams; 0 without n-grams."""
        z = self.curve[0] * per_gram(total, n) + self.curve[1]
        return np.where(n > 0, -np.logaddexp(0.0, -z) - np.log(self.share), 0.0)


def per_gram(total: np.ndarray, n: np.ndarray) -> np.ndarray:
    """Log ratio per n-gram, as far as it still tells more."""
    return np.clip(total / (n + FEW), -CLIP, CLIP)


def _log_ratio(target: np.ndarray, raw: np.ndarray) -> np.ndarray:
    """Log of target over raw probability, for each of the two n-gram kinds. The target model backs
    off to the raw one by ``ALPHA`` counts an n-gram: (seen + ALPHA) / (expected + ALPHA) times the
    raw probability, where expected is what raw text of the target's size would hold. So n-grams too
    rare to be missed speak neither way, however small the sample."""
    out = []
    for part in (slice(0, CHAR_SLOTS), slice(CHAR_SLOTS, SLOTS)):
        r, t = raw[part].astype(np.float64), target[part].astype(np.float64)
        expected = t.sum() * r / max(r.sum(), 1.0)
        out.append(np.log((t + ALPHA) / (expected + ALPHA)))
    return np.concatenate(out)


def fit(docs: DataFrame, labels: DataFrame, fit_rows: int = FIT_ROWS) -> Model:
    """The raw model counts every document. The target model counts good documents of even id hash,
    the curve is fitted on labelled ones of odd hash: of each the ``fit_rows`` of least hash, a
    bounded sample, since it parametrises the classifier. Without labels of both kinds everything
    is target."""
    lab = (labels.where("quality is not null and doc_id is not null").groupBy("doc_id")
           .agg(F.min(F.col("quality").cast("int")).alias("q")))
    share = lab.agg(F.avg("q")).first()[0]
    if not share or share == 1.0:
        return Model(np.zeros(SLOTS, dtype=np.float32), 1.0)
    h = F.xxhash64("doc_id")
    least = lambda rows: rows.orderBy(h, "doc_id").limit(fit_rows)
    texts = docs.select("doc_id", "text").where("text is not null")
    # both at most fit_rows ids
    seen = texts.join(F.broadcast(least(lab.where("q = 1").where(h % 2 == 0)).select("doc_id")), "doc_id", "left_semi")
    target = count_slots(seen.select("text"), 1, SLOTS, _count)[0]
    raw = count_slots(docs.select("text"), 1, SLOTS, _count)[0]
    m = Model(_log_ratio(target, raw).astype(np.float32), float(share))
    held = texts.join(F.broadcast(least(lab.where(h % 2 != 0))), "doc_id")
    known = score(held, m, ["q"]).select("q", "_llm_total", "_llm_n").where("_llm_n > 0").toArrow()  # about fit_rows rows
    y = known.column("q").to_numpy().astype(np.float64)
    x = per_gram(known.column("_llm_total").to_numpy(), known.column("_llm_n").to_numpy())
    if len(set(y.tolist())) == 2:
        w = logistic(np.column_stack([np.ones(len(x)), x]), y, ridge=1e-3)
        m.curve = (max(float(w[1]), 0.0), float(w[0]))
    return m


def sortable(x: np.ndarray) -> np.ndarray:
    """int64 that order as the doubles do."""
    i = (x + 0.0).view(np.int64)
    return np.where(i < 0, np.int64(-(2**63)) - i, i)


def score(docs: DataFrame, model: Model, keep: list[str], seed: int = SEED) -> DataFrame:
    """``keep`` columns, then number of n-grams, summed log ratio, log weight, Gumbel key and its
    sortable form. The noise depends on doc_id and text alone, so a task that runs again draws the
    same."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    inner = docs.select(*keep, F.col("text").alias("_llm_text"),
                        F.xxhash64("doc_id", "text", F.lit(seed)).alias("_llm_noise"))
    schema = inner.select(*keep).schema
    for c, t in (("_llm_n", "long"), ("_llm_total", "double"), ("_llm_weight", "double"), ("_llm_key", "double"), ("_llm_rank", "long")):
        schema = schema.add(c, t)

    def run(batches):
        m = shared.value
        for b in batches:
            n, total = np.zeros(b.num_rows, dtype=np.int64), np.zeros(b.num_rows)
            for lo, hi, buf, off in slices(b, "_llm_text"):
                for slot, start, size in document_slots(buf, off):
                    total[lo:hi] += document_sums(m.log_ratio[slot].astype(np.float64), start, size)
                    n[lo:hi] += size
            w = m.log_weight(total, n)
            bits = mix(np.array(ids(b, "_llm_noise").to_numpy(zero_copy_only=False)).view(np.uint64))
            u = ((bits >> np.uint64(12)).astype(np.float64) + 0.5) / 2.0**52
            key = w - np.log(-np.log(u))
            yield pa.RecordBatch.from_arrays([*(ids(b, c) for c in keep), pa.array(n), pa.array(total), pa.array(w), pa.array(key),
                                              pa.array(sortable(key))],
                                             names=[*keep, "_llm_n", "_llm_total", "_llm_weight", "_llm_key", "_llm_rank"])

    return inner.mapInArrow(lean(run), schema)


def cut(scores: DataFrame, model: Model) -> tuple[int, int | None]:
    """How many documents to sample, and the sortable key of the last of them (None: all; above
    every key where there are none)."""
    n, mass = scores.agg(F.count("*"), F.sum(F.least(F.lit(1.0), F.exp(F.col("_llm_weight")) * model.share))).first()
    k = int(round(mass or 0.0))
    if k >= n:
        return k, None
    return k, kth_largest(scores, "_llm_rank", k) if k else 2**63 - 1


def resample(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``doc_id, n_grams, log_weight, gumbel_key, kept`` of every document. Equal keys at the cut
    (repeated rows) are all kept. Null text counts as empty: no n-grams, log weight 0. Columns but
    doc_id, text (documents) and doc_id, quality (labels) are ignored; an empty table gives an
    empty result."""
    model = fit(docs, labels)
    scores = materialize(score(docs, model, ["doc_id"]), "quality")
    _, last = cut(scores, model)
    kept = F.lit(True) if last is None else F.col("_llm_rank") >= last
    return scores.select("doc_id", F.col("_llm_n").alias("n_grams"), F.col("_llm_weight").alias("log_weight"),
                         F.col("_llm_key").alias("gumbel_key"), kept.alias("kept"))


def keep_sampled(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The sampled rows of ``docs`` with all their columns. Scores are drawn once for the cut, then
    again beside the rows (one more pass over the text, no join or shuffle of it)."""
    model = fit(docs, labels)
    scores = materialize(score(docs, model, ["doc_id"]).select("_llm_weight", "_llm_rank"), "quality")
    _, last = cut(scores, model)
    release(scores)
    if last is None:
        return docs
    whole = docs.select(F.struct("*").alias("_llm_row"), "doc_id", "text")
    return score(whole, model, ["_llm_row"]).where(F.col("_llm_rank") >= last).select("_llm_row.*")
