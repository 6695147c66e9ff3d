"""Toxicity by compression distance (operator 4).

Two zstandard dictionaries, one for ordinary and one for toxic text. What a window of a document
costs under each is compared: the toxic dictionary saves bytes where a window holds toxic wording.
Both hold the content trained on ordinary text, so that common wording costs the same in both. The
toxic one ends in the word stems that toxic documents use more often than others, those that tell
most at the very end; they are taken out of the common content, wherever they stand. No share or ratio
keeps a stem out: how many bytes of them the dictionary takes is what tells unseen labelled texts apart best.
(A dictionary trained on whole toxic text holds mostly its ordinary prose: README.)
How much a saving means is calibrated on documents kept out of dictionary training (two folds): the
log odds of each saving, summed over a document's windows, the largest saving, and the number and share of windows that save
much go through a logistic threshold.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from panelspark.llm.common import fraction_hash, ids, lean, logistic, rows

WINDOW = 96  # bytes
LONGEST = 24  # bytes of a stem
MIN_MATCH = 4  # bytes; shorter stems can't match
SEARCH_LOG = 6  # at level 3's own depth (2) most stems of a dictionary are never found
DICT_BYTES = 100 << 10  # trained per class
COMMON_BYTES = 100 << 10  # of the ordinary one, at the end of both
STEM_BYTES = [16 << k for k in range(12)]  # of toxic stems; calibration decides how many
WORSE = 3  # sizes in a row that tell less end the search
FIT_TOXIC, FIT_ORDINARY = 4_000, 6_000  # labelled documents learned from, by least id hash
FIT_BYTES = 20 << 20  # their texts on the driver
FIT_PART = 80  # of a text, at most this part of FIT_BYTES is learned from
SAVING = 12  # savings are counted from -SAVING to SAVING
HIT = 3  # a window that the toxic dictionary saves so many bytes of is a hit
THRESHOLD = 0.7
NOT_WORD = re.compile(rb"[\x00-\x2f\x3a-\x60\x7b-\x7f]+")


def fold(text: str | None) -> bytes:
    return (text or "").lower().encode("utf-8", "surrogatepass")


def cut_windows(b: bytes, size: int = WINDOW) -> list[bytes]:
    """The whole text in windows of about ``size`` bytes, cut before a space where there is one."""
    out, i = [], 0
    while len(b) - i > size:
        k = b.rfind(b" ", i + 1, i + size)
        k = k if k > 0 else i + size
        out.append(b[i:k])
        i = k
    if i < len(b):
        out.append(b[i:])
    return out


def compressor(content: bytes) -> zstandard.ZstdCompressor:
    params = zstandard.ZstdCompressionParameters.from_level(
        3, source_size=WINDOW, dict_size=len(content), min_match=MIN_MATCH, strategy=zstandard.STRATEGY_BTULTRA,
        search_log=SEARCH_LOG, chain_log=18, hash_log=17, write_content_size=False, write_checksum=False, write_dict_id=False)
    return zstandard.ZstdCompressor(
        compression_params=params, dict_data=zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT))


def savings(text: bytes, ordinary, toxic) -> np.ndarray:
    """By window: bytes that the toxic dictionary saves against the ordinary one."""
    d = [len(ordinary.compress(w)) - len(toxic.compress(w)) for w in cut_windows(text)]
    return np.clip(np.array(d, dtype=np.int64), -SAVING, SAVING)


def train(docs: list[bytes]) -> bytes:
    """Dictionary content for a class; its raw text where there is too little to train on."""
    try:
        return zstandard.train_dictionary(DICT_BYTES, docs).as_bytes()
    except zstandard.ZstdError:
        return b" ".join(docs)[-DICT_BYTES:]


def _stems(docs: list[bytes]) -> Counter:
    """Documents that hold a word with a stem, of all stems that two documents hold."""
    counts: Counter = Counter()
    left = [{w for w in set(NOT_WORD.split(d)) if len(w) >= MIN_MATCH} for d in docs]
    for k in range(MIN_MATCH, LONGEST + 1):
        of = Counter()
        for ws in left:
            of.update({w[:k] for w in ws})
        of = Counter({w: n for w, n in of.items() if n > 1})
        counts.update(of)
        left = [kept for ws in left if (kept := {w for w in ws if len(w) > k and w[:k] in of})]
    return counts


def _stem_counts(docs: list[bytes], stems) -> Counter:
    """Documents that hold a word with each of the stems."""
    counts: Counter = Counter()
    longest = max(map(len, stems), default=0)
    for d in docs:
        counts.update({w[:k] for w in set(NOT_WORD.split(d)) for k in range(MIN_MATCH, min(len(w), longest) + 1) if w[:k] in stems})
    return counts


def own_words(own: list[bytes], other: list[bytes]) -> list[bytes]:
    """Word stems that a class uses more often than the other, those that tell most first (by the
    log likelihood ratio of their shares). A stem that most of its documents hold within a longer
    one before it is left to that."""
    mine = _stems(own)
    theirs = _stem_counts(other, mine)
    n, m = len(own), len(other)

    def tells(a: int, b: int) -> float:
        p = (a + b) / (n + m)
        return sum(x * np.log(x / e) for x, e in ((a, n * p), (n - a, n * (1 - p)), (b, m * p), (m - b, m * (1 - p))) if x > 0)

    value: dict[tuple[int, int], float] = {}
    found = []
    for w, a in mine.items():
        k = (a, theirs[w])
        if a * m > k[1] * n:
            if k not in value:
                value[k] = float(tells(*k))
            found.append((-value[k], -len(w), w))
    out, held = [], set()
    for _, _, w in sorted(found):
        if w not in held:
            out.append(w)
            held.update(w[:k] for k in range(MIN_MATCH, len(w) + 1) if 2 * mine[w] >= mine[w[:k]])
    return out


def without(content: bytes, stems: list[bytes]) -> bytes:
    """``content`` with the stems taken out, of several at one place the longest."""
    by_start: dict[bytes, list[bytes]] = {}
    for w in sorted(stems, key=len, reverse=True):
        by_start.setdefault(w[:MIN_MATCH], []).append(w)
    out, i, last = [], 0, 0
    while i < len(content):
        w = next((w for w in by_start.get(content[i : i + MIN_MATCH], ()) if content.startswith(w, i)), None)
        if w:
            out.append(content[last:i])
            last = i + len(w)
        i += len(w) if w else 1
    return b"".join([*out, content[last:]])


@dataclass
class Model:
    ordinary: bytes
    toxic: bytes
    odds: np.ndarray  # log odds by saving, from -SAVING
    weights: np.ndarray  # logistic: bias, summed odds, largest saving, hits (log and share of windows)

    def compressors(self):
        return compressor(self.ordinary), compressor(self.toxic)

    def features(self, d: np.ndarray) -> np.ndarray:
        hits = float((d >= HIT).sum())
        return np.array([1.0, self.odds[d + SAVING].sum() if len(d) else 0.0, max(d.max(initial=0), 0),
                         np.log1p(hits), hits / max(len(d), 1)])

    def score(self, d: np.ndarray) -> float:
        z = float(self.features(d) @ self.weights)
        return 1.0 / (1.0 + np.exp(-min(max(z, -500.0), 500.0)))


def dictionaries(base: bytes, words: list[bytes], size: int) -> tuple[bytes, bytes]:
    """Content of the ordinary and of the toxic dictionary, with ``size`` bytes of toxic stems."""
    end = np.cumsum([len(w) + 1 for w in words])
    taken = words[: int(np.searchsorted(end, size, side="right"))]
    base = without(base[-COMMON_BYTES:], taken)
    return base, base + b" " + b" ".join(reversed(taken)) + b" "


def calibrate(m: Model, seen: list[list[np.ndarray]]) -> float:
    """Sets what savings mean in ``m`` by savings of unseen texts; the log loss."""
    hist = [np.bincount(np.concatenate([*ds, [SAVING]]) + SAVING, minlength=2 * SAVING + 1) + 0.5 for ds in seen]
    m.odds = np.log(hist[1] / hist[1].sum()) - np.log(hist[0] / hist[0].sum())
    x = np.array([m.features(d) for ds in seen for d in ds])
    y = np.repeat([0.0, 1.0], [len(seen[0]), len(seen[1])])
    m.weights = logistic(x, y)
    return float(np.logaddexp(0.0, np.where(y > 0, -1.0, 1.0) * (x @ m.weights)).sum())


def fit_texts(toxic: list[bytes], ordinary: list[bytes]) -> Model | None:
    """Model of labelled texts (None unless both classes have some). The dictionaries are made of
    all texts; how many stems they take and what savings mean is calibrated in two folds, each with
    dictionaries of the other."""
    classes = [list(dict.fromkeys(ordinary)), list(dict.fromkeys(toxic))]
    if not all(classes):
        return None
    part = lambda docs, k: [d for d in docs if zlib.crc32(d) % 2 == k]
    learned = [[part(docs, k) or docs for docs in classes] for k in (0, 1)]
    made = [(train(o), own_words(t, o)) for o, t in learned]
    whole = train(classes[0]), own_words(classes[1], classes[0])
    best, worse = None, 0
    for size in STEM_BYTES:
        seen: list[list[np.ndarray]] = [[], []]
        for k in (0, 1):
            cs = [compressor(c) for c in dictionaries(*made[k], size)]
            for label, docs in enumerate(classes):
                seen[label] += [savings(d, *cs) for d in part(docs, 1 - k)]
        m = Model(*dictionaries(*whole, size), np.zeros(2 * SAVING + 1), np.zeros(5))
        loss = calibrate(m, seen)
        if best is None or loss < best[0]:
            best, worse = (loss, m), 0
        else:
            worse += 1
        if worse == WORSE or size >= max(sum(len(w) + 1 for w in words) for _, words in (*made, whole)):
            break
    return best[1]


def fit(docs: DataFrame, labels: DataFrame, fit_toxic: int = FIT_TOXIC, fit_ordinary: int = FIT_ORDINARY,
        fit_bytes: int = FIT_BYTES) -> Model | None:
    """Model of a bounded sample of the labelled documents: of each class those with the least id
    hash, as far as their texts fit ``fit_bytes`` (each class half). Of a very long text the first
    ``fit_bytes // FIT_PART`` bytes are learned from, so that it leaves room for the others."""
    longest = fit_bytes // FIT_PART
    lab = labels.where("toxic is not null and doc_id is not null").groupBy("doc_id").agg(F.max(F.col("toxic").cast("int")).alias("toxic"))
    chosen = None
    for label, rows in ((1, fit_toxic), (0, fit_ordinary)):
        part = lab.where(F.col("toxic") == label).orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows)
        chosen = part if chosen is None else chosen.unionByName(part)
    named = docs.where("text is not null").select("doc_id", "text").join(F.broadcast(chosen), "doc_id")  # at most 12,000 ids
    sizes = named.select("doc_id", "toxic", F.least(F.octet_length("text"), F.lit(longest)).alias("n"))
    order = Window.partitionBy("toxic").orderBy(F.xxhash64("doc_id"), "doc_id", "n").rowsBetween(Window.unboundedPreceding, 0)
    fits = sizes.withColumn("sum", F.sum("n").over(order)).where(F.col("sum") <= fit_bytes // 2).select("doc_id").distinct()
    texts: dict[int, list[bytes]] = {0: [], 1: []}
    start = F.substring(F.col("text").cast("binary"), 1, longest).alias("text")
    for r in named.join(F.broadcast(fits), "doc_id", "left_semi").select("toxic", start).toLocalIterator():
        texts[r["toxic"]].append(fold(bytes(r["text"]).decode("utf-8", "ignore")))
    return fit_texts(sorted(texts[1]), sorted(texts[0]))


def predict(docs: DataFrame, model: Model | None, keep: list[str], threshold: float = THRESHOLD) -> DataFrame:
    """``keep`` columns, then ``score`` and ``predicted``; whole texts, in one map."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    inner = docs.select(*keep, "text")
    schema = inner.select(*keep).schema.add("score", "double").add("predicted", "integer")

    def run(batches):
        m = shared.value
        cs = m.compressors() if m else None
        for b in batches:
            score = np.array([m.score(savings(fold(t), *cs)) if m else 0.0 for t, in rows(b, "text")])
            yield pa.RecordBatch.from_arrays([*(ids(b, c) for c in keep), pa.array(score, pa.float64()),
                                              pa.array((score >= threshold).astype(np.int32))], names=[*keep, "score", "predicted"])

    return inner.mapInArrow(lean(run), schema)


def classify(docs: DataFrame, labels: DataFrame, modulus: int = 3, held: int = 1) -> DataFrame:
    """``doc_id, held_out, score, predicted`` of every document; the model learns from labelled
    rows whose crc32(doc_id as text) mod ``modulus`` is not ``held``.

    Null and empty texts have no window and get the model's score for none. Without labels of both
    classes every score is 0. A row without doc_id is neither learned from nor held out; repeated
    rows are scored one by one; of two labels for one id the larger counts; other columns are
    ignored; an empty table gives an empty result."""
    rest = fraction_hash(F.col("doc_id"), modulus)
    model = fit(docs.where(rest != held), labels)
    return predict(docs.select("doc_id", F.coalesce(rest == held, F.lit(False)).alias("held_out"), "text"),
                   model, ["doc_id", "held_out"])
