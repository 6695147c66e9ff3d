"""The quality and language operators against plain-Python twins: counts, probabilities, keys and choice."""

import math
import struct
import unicodedata
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
import xxhash

from panelspark.llm import langid, quality
from panelspark.llm.common import logistic

M32, M64 = 2**32 - 1, 2**64 - 1


def hashed(codes, scale=1):
    """The operators' 32-bit hash of an n-gram of code points or bytes."""
    mult = (0x9E3779B1, 0x85EBCA77, 0xC2B2AE3D)
    h = sum(c * m * scale for c, m in zip(codes, mult)) & M32
    return (h ^ (h >> 15)) * 0x2C1B3C6D & M32


def spark_hash(*values):
    """Spark's xxhash64 of longs, ints (as ``(i,)``) and strings; nulls leave it unchanged."""
    h = 42
    for v in values:
        if v is not None:
            raw = v.encode() if isinstance(v, str) else struct.pack("<i", v[0]) if isinstance(v, tuple) else struct.pack("<q", v)
            h = xxhash.xxh64_intdigest(raw, seed=h)
    return h


def quality_slots(text):
    b = (text or "").encode()
    out = [hashed(b[i : i + 3]) >> 16 for i in range(len(b) - 2)]
    w = b.split()
    mark = [next((d for d in range(1, quality.BACK + 1) if d <= i and w[i - d] == w[i]), 0) for i in range(len(w))]
    return out + [quality.CHAR_SLOTS + a * (quality.BACK + 1) + z for a, z in zip(mark, mark[1:])]


def finish(h):
    h = (h ^ (h >> 30)) * 0xBF58476D1CE4E5B9 & M64
    h = (h ^ (h >> 27)) * 0x94D049BB133111EB & M64
    return h ^ (h >> 31)


def test_quality_equals_brute_force(spark):
    def text(i):
        r = np.random.RandomState(i)
        if i % 4:
            return " ".join(r.choice(["river", "stone", "été", "mill", "under", "bridge", "runs", "and"], 30))
        return " ".join(r.choice(["BUY", "now!!", "cheap", "stone"], r.randint(1, 40)))

    rows = [(i, text(i)) for i in range(240)] + [(500, None), (501, ""), (502, "a"), (503, "loop " * 20_000), (None, text(5)), (9, text(9)), (9, text(9))]
    labelled = [(i, int(i % 4 > 0 or i % 24 == 0)) for i in range(160)] + [(None, 1), (7, None), (4, 1), (999, 0)]
    docs = spark.createDataFrame([(d, t, "x", 1.0, 2) for d, t in rows], "doc_id bigint, text string, kept string, log_weight double, _llm_n int")
    labels = spark.createDataFrame(labelled, "doc_id bigint, quality int")

    lab = {}
    for d, q in labelled:
        if d is not None and q is not None:
            lab[d] = min(q, lab.get(d, 1))
    share = sum(lab.values()) / len(lab)
    slots = [quality_slots(t) for _, t in rows]
    raw, target = Counter(), Counter()
    for (d, t), s in zip(rows, slots):
        raw.update(s)
        if t is not None and lab.get(d) == 1 and spark_hash(d) % 2 == 0:
            target.update(s)
    kind = lambda s: s >= quality.CHAR_SLOTS
    sums = {(k, name): sum(n for s, n in c.items() if kind(s) == k) for name, c in (("t", target), ("r", raw)) for k in (False, True)}
    ratio = {s: float(np.float32(math.log((target[s] + quality.ALPHA) / (sums[kind(s), "t"] * n / sums[kind(s), "r"] + quality.ALPHA))))
             for s, n in raw.items()}
    total = [math.fsum(ratio[x] for x in s) for s in slots]
    per = [min(max(v / (len(s) + quality.FEW), -quality.CLIP), quality.CLIP) for v, s in zip(total, slots)]
    known = [(p, lab[d]) for (d, t), s, p in zip(rows, slots, per) if t is not None and d in lab and spark_hash(d) % 2 and s]
    x, y = np.array(known).T
    assert set(y) == {0.0, 1.0}
    bias, slope = logistic(np.column_stack([np.ones(len(x)), x]), y, ridge=1e-3)
    weight = [-math.log1p(math.exp(-(max(slope, 0.0) * p + bias))) - math.log(share) if s else 0.0 for p, s in zip(per, slots)]
    key = []
    for (d, t), w in zip(rows, weight):
        u = ((finish(spark_hash(d, t, (quality.SEED,))) >> 12) + 0.5) / 2**52
        key.append(w - math.log(-math.log(u)))
    k = round(sum(min(1.0, math.exp(w) * share) for w in weight))
    assert 0 < k < len(rows)
    last = sorted(key, reverse=True)[k - 1]

    by = lambda r: (r[0] is None, r[0] or 0, r[3])
    got = sorted(map(tuple, quality.resample(docs, labels).collect()), key=by)
    want = sorted(((d, len(s), w, g, g >= last) for (d, _), s, w, g in zip(rows, slots, weight, key)), key=by)
    assert [(r[0], r[1], r[4]) for r in got] == [(r[0], r[1], r[4]) for r in want]
    assert np.allclose([r[2:4] for r in got], [r[2:4] for r in want], rtol=0, atol=1e-6)
    kept = quality.keep_sampled(docs, labels)
    assert kept.columns == docs.columns
    assert Counter(r.doc_id for r in kept.collect()) == Counter(r[0] for r in want if r[4])
    assert quality.keep_sampled(docs.limit(0), labels).collect() == []


def language_slots(text):
    codes = [c if 0x61 <= c <= 0x7A or c >= 0x80 else 0x20 for c in map(ord, text.lower())]
    padded = codes + [0x20] * 2
    return [hashed(padded[i : i + n], 2 * n + 1) >> 17 for n in langid.ORDERS for i in range(len(codes))]


@pytest.mark.parametrize("twins", [False, True])
def test_language_equals_brute_force(spark, twins):
    """``twins``: two languages with the same documents, between which the first in order wins."""
    forms = {"bb": ["der", "und", "mit", "Haus", "the"], "cc": ["ça", "été", "où", "maison", "mit"], "dd": ["中文", "东西", "the"]}
    data = [(i, " ".join(np.random.RandomState(i).choice(forms[k], 3 + i % 5)), k) for i, k in enumerate([*forms] * 40)]
    odd = [(900, None, "bb"), (901, "", "cc"), (902, "12 !! 3", "bb"), (903, "der " * 50_000 + "été", None), (None, "maison", "dd"), (904, "Ǆ İx", "zz"),
           (905, "the", None), data[3], data[3]]
    rows = data + odd
    if twins:
        learned = lambda d: d is not None and zlib.crc32(str(d).encode()) % 4 != 2
        free = iter(d for d in range(2_000, 4_000) if learned(d))
        rows += [(next(free), t, "aa") for d, t, k in rows if k == "bb" and t is not None and learned(d)]
    docs = spark.createDataFrame([(*r, 0.5, "q", "z") for r in rows],
                                 "doc_id bigint, text string, lang string, score double, lang_pred string, held_out string")
    held = lambda d: d is not None and zlib.crc32(str(d).encode()) % 4 == 2
    counts, sizes = defaultdict(Counter), Counter()
    for d, t, k in rows:
        if d is not None and not held(d) and t is not None and k is not None:
            counts[k].update(language_slots(t))
            sizes[k] += 1
    logs = {}
    for k in sorted(sizes):
        whole = sum(counts[k].values()) + langid.ALPHA * langid.SLOTS
        logs[k] = lambda s, c=counts[k], n=whole: float(np.float32(math.log((c[s] + langid.ALPHA) / n)))
    want = []
    for d, t, _ in rows:
        if t is None or not any(unicodedata.category(c)[0] == "L" for c in t):
            want.append((d, held(d), "und", 0.0))
            continue
        seen = Counter(language_slots(t))
        sums = {k: math.log(sizes[k] / sum(sizes.values())) + math.fsum(n * f(s) for s, n in seen.items()) for k, f in logs.items()}
        best = max(sums.values())
        lang = min(k for k, v in sums.items() if v >= best - 1e-6)
        want.append((d, held(d), lang, 1 / math.fsum(math.exp(v - best) for v in sums.values())))
    by = lambda r: (r[0] is None, r[0] or 0)
    got, want = sorted(map(tuple, langid.identify(docs).collect()), key=by), sorted(want, key=by)
    assert [r[:3] for r in got] == [r[:3] for r in want]
    assert np.allclose([r[3] for r in got], [r[3] for r in want], rtol=0, atol=1e-6)
    if twins:
        assert sizes["aa"] == sizes["bb"] and "aa" in {r[2] for r in got} and "bb" not in {r[2] for r in got}
