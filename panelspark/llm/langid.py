"""Language identification (operator 5): multinomial naive Bayes over hashed character n-grams.

The n-gram counts of every training document are summed into one (languages, slots) table, whose
log-probabilities go to all tasks; a batch is scored by gathering them for its n-grams and summing
by document in numpy.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelspark.llm.common import count_slots, fraction_hash, ids, lean
from panelspark.llm.text import ranges

ORDERS = (2, 3)
SLOTS = 1 << 15
ALPHA = 0.5
MAX_TABLE_MB = 256  # of the broadcast table: 2,048 languages at 32,768 slots
_MULT = np.array([0x9E3779B1, 0x85EBCA77, 0xC2B2AE3D, 0x27D4EB2F, 0x165667B1], dtype=np.uint32)


def code_points(texts: list, fold: bool = True):
    """All texts as one array of code points, each followed by as many spaces as n-grams need,
    with starts and lengths. ``fold``: lower case, and ASCII but letters as spaces."""
    pad = " " * (max(ORDERS) - 1)
    texts = [(t.lower() if fold else t) if t else "" for t in texts]
    lengths = np.fromiter(map(len, texts), dtype=np.int64, count=len(texts))
    a = np.frombuffer((pad.join(texts) + pad).encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    if fold:
        a = np.where((a < 0x61) | ((a > 0x7A) & (a < 0x80)), np.uint32(0x20), a)
    return a, np.cumsum(lengths + len(pad)) - lengths - len(pad), lengths


def ngram_slots(a: np.ndarray, order: int, slots: int) -> np.ndarray:
    """Slot of the n-gram that starts at each code point (those past the end: shorter)."""
    n = len(a) - order + 1
    h = np.zeros(max(n, 0), dtype=np.uint32)
    for k in range(order):
        h += a[k : k + len(h)] * _MULT[k] * np.uint32(2 * order + 1)
    h ^= h >> np.uint32(15)
    h *= np.uint32(0x2C1B3C6D)
    return h >> np.uint32(32 - slots.bit_length() + 1)


def text_slices(texts: list, chars: int = 1 << 19):
    """Runs lo..hi of the texts with about so many characters."""
    lo = size = 0
    for i, t in enumerate(texts):
        if size and size + len(t or "") > chars:
            yield lo, i
            lo, size = i, 0
        size += len(t or "")
    if lo < len(texts):
        yield lo, len(texts)


def document_sums(values: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Sum of the values at start .. start + length of every document (0 for empty ones)."""
    out = np.zeros(len(starts))
    some = np.flatnonzero(lengths > 0)
    if len(some):
        edges = np.column_stack([starts[some], starts[some] + lengths[some]]).ravel()
        out[some] = np.add.reduceat(np.append(values, 0.0), edges)[::2]
    return out


@dataclass
class Model:
    languages: list[str]
    log_prob: np.ndarray  # (languages, slots)
    prior: np.ndarray


def fit(docs: DataFrame, slots: int = SLOTS, alpha: float = ALPHA) -> Model:
    """Model of ``text, lang`` (nulls are left out). All rows given count."""
    docs = docs.where("text is not null and lang is not null").select("text", "lang")
    sizes = {r["lang"]: r["count"] for r in docs.groupBy("lang").count().limit(1 + MAX_TABLE_MB * 2**20 // (4 * slots)).collect()}
    languages = sorted(sizes)
    if len(languages) * slots * 4 > MAX_TABLE_MB * 2**20:
        raise ValueError(f"more languages than {MAX_TABLE_MB} MB hold at {slots} slots; lower slots")
    if not languages:
        return Model([], np.zeros((0, slots), np.float32), np.zeros(0))
    index = {x: i for i, x in enumerate(languages)}

    def add(batch, acc):
        langs, texts = np.array([index[x] for x in ids(batch, "lang").to_pylist()]), ids(batch, "text").to_pylist()
        for lo, hi in text_slices(texts):
            a, starts, lengths = code_points(texts[lo:hi])
            for order in ORDERS:
                h = ngram_slots(a, order, slots)
                keys = np.repeat(langs[lo:hi], lengths) * slots + np.append(h, 0)[ranges(starts, lengths)]
                acc.ravel()[:] += np.bincount(keys, minlength=acc.size)

    counts = count_slots(docs, len(languages), slots, add).astype(np.float64) + alpha
    log_prob = np.log(counts / counts.sum(axis=1, keepdims=True)).astype(np.float32)
    n = np.array([sizes[x] for x in languages], dtype=np.float64)
    return Model(languages, log_prob, np.log(n / n.sum()))


def score_texts(model: Model, texts: list) -> tuple[np.ndarray, np.ndarray]:
    """Index of the likeliest language (the first among equals) and its posterior."""
    total = np.tile(model.prior, (len(texts), 1))
    slots = model.log_prob.shape[1]
    for lo, hi in text_slices(texts):
        a, starts, lengths = code_points(texts[lo:hi])
        for order in ORDERS:
            h = ngram_slots(a, order, slots)
            for k, row in enumerate(model.log_prob):
                total[lo:hi, k] += document_sums(row[h].astype(np.float64), starts, lengths)
    best = total.argmax(axis=1)
    return best, 1.0 / np.exp(total - total.max(axis=1, keepdims=True)).sum(axis=1)


def predict(docs: DataFrame, model: Model, keep: list[str]) -> DataFrame:
    """``keep`` columns, then ``lang_pred`` and ``score`` (``und`` and 0.0 where the text is null or
    has no letter, or nothing was learned)."""
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(model)
    inner = docs.select(*keep, "text", F.coalesce(F.col("text").rlike(r"\p{L}"), F.lit(False)).alias("has_letter"))
    schema = inner.select(*keep).schema.add("lang_pred", "string").add("score", "double")

    def run(batches):
        m = shared.value
        for b in batches:
            letter = np.array(ids(b, "has_letter").to_pylist(), dtype=bool)
            lang, score = np.full(len(letter), "und", dtype=object), np.zeros(len(letter))
            at = np.flatnonzero(letter) if m.languages else np.zeros(0, np.int64)
            if len(at):
                best, p = score_texts(m, ids(b, "text").take(pa.array(at)).to_pylist())
                lang[at], score[at] = [m.languages[i] for i in best], p
            yield pa.RecordBatch.from_arrays([*(ids(b, c) for c in keep), pa.array(lang, pa.string()), pa.array(score)],
                                             names=[*keep, "lang_pred", "score"])

    return inner.mapInArrow(lean(run), schema)


def identify(docs: DataFrame, modulus: int = 4, held: int = 2) -> DataFrame:
    """``doc_id, held_out, lang_pred, score`` of every document; the model learns from rows whose
    crc32(doc_id as text) mod ``modulus`` is not ``held``. A row without doc_id is neither learned
    from nor held out. Repeated rows are scored one by one; columns but doc_id, text and lang are
    ignored; an empty table gives an empty result."""
    rest = fraction_hash(F.col("doc_id"), modulus)
    model = fit(docs.where(rest != held))
    return predict(docs.select("doc_id", F.coalesce(rest == held, F.lit(False)).alias("held_out"), "text"),
                   model, ["doc_id", "held_out"])
