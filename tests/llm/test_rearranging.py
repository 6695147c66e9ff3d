"""Sharding, whitening and alignment against brute force: nulls in every column, empty and very long
texts, ties, repeated rows, empty tables, columns whose names clash with the operators' own."""

import hashlib
import math
import random
import zlib
from collections import Counter, defaultdict
from fractions import Fraction

import numpy as np
import pytest

from panelspark.llm import alignment, sharding, tokens, whitening

A, B = tokens.tokenizer_path("byte_bpe_50k.json"), tokens.tokenizer_path("piece_bpe_32k.model")
DOCS = "doc_id bigint, text string, size int, shard string, slot int, pairs string, tag int, n string, total string"


def doc_frame(spark, rows, parts=4):
    return spark.createDataFrame([(d, t, 1, None, 2, "p", 3, "n", "t") for d, t in rows], DOCS).repartition(parts)


def texts():
    rnd = random.Random(5)
    odd = ["Wort", "ääß", "中文字", "🙂🙂", " ", "<|endoftext|>", "<s>", "</s>", "<0x0A>", "don't", "x" * 40, "\t", "\n", "\n\n", "  ", "   a", "\r\n", "　", "é", "12345"]
    out = [" ".join(rnd.choice(odd) for _ in range(rnd.randint(1, 60))) for _ in range(60)]
    out += ["".join(rnd.choice(odd + [" "]) for _ in range(rnd.randint(1, 60))) for _ in range(60)]
    return out + [None, "", " ", "\n", "a", "a ▁ b", "▁", "hello world " * 20_000, "z" * 5000, " " * 3000, "\n" * 3000, "é" * 2000]


# ------------------------------------------------------------------ 11


def brute_shards(rows, k):
    line = sorted(((d is not None, d or 0, zlib.crc32((t or "").encode()), len((t or "").encode()) + 16), d) for d, t in rows)
    total, before, out, slots = sum(x[0][3] for x in line), 0, [], Counter()
    for (_, _, crc, size), d in line:
        shard = min(k - 1, (2 * before + size) * k // (2 * total))
        out.append((d, size, crc, "bytes", shard, slots[shard], None))
        slots[shard] += 1
        before += size
    return sorted(out, key=repr)


@pytest.mark.parametrize("k", [1, 7, 40])
def test_shards_equal_brute_force(spark, k):
    body = texts()
    rows = [(i if i % 9 else None, t) for i, t in enumerate(body)] + [(3, body[3])] * 50 + [(None, None)] * 200 + [(10**12, "tail")]
    got = sharding.shards(doc_frame(spark, rows), k)
    assert got.columns == ["doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard"]
    assert sorted(map(tuple, got.collect()), key=repr) == brute_shards(rows, k)


def test_shards_are_balanced_and_gapless(spark):
    rows = [(i, "x" * (i * 37 % 211)) for i in range(3000)]
    got = sharding.shards(doc_frame(spark, rows)).collect()
    by = defaultdict(list)
    for r in got:
        by[r.shard].append(r)
    total, largest = sum(r.size for r in got), max(r.size for r in got)
    assert sorted(by) == list(range(40))
    for some in by.values():
        assert sorted(r.slot for r in some) == list(range(len(some)))
        assert abs(sum(r.size for r in some) - total / 40) <= largest
    ends = sorted((min(r.doc_id for r in s), max(r.doc_id for r in s)) for s in by.values())
    assert all(a[1] < b[0] for a, b in zip(ends, ends[1:]))


def test_hot_copies_spread_over_ranges(spark):
    slim = spark.createDataFrame([(None if i % 3 else i, 16, 0, i) for i in range(9000)], "doc_id bigint, size bigint, text_crc32 bigint, _tag bigint")
    ranged = sharding.in_ranges(slim, ["doc_id", "text_crc32", "size", "_tag"])
    assert max(r["count"] for r in ranged.groupBy("_range").count().collect()) < 4500  # 6,000 rows are alike


def test_shards_of_nothing(spark):
    assert sharding.shards(doc_frame(spark, [])).collect() == []
    assert sharding.shards(doc_frame(spark, [(None, None)])).collect()[0][:6] == (None, 16, 0, "bytes", 20, 0)


# ------------------------------------------------------------------ 12


def brute_whitening(vectors, k=16):
    xs = [[math.floor(64 * c) + 1_000_000 for c in v] for _, v in vectors]
    fit = sorted(set(map(tuple, xs)))
    n, d = len(fit), len(fit[0])
    s = [sum(x[i] for x in fit) for i in range(d)]
    y = [[n * x[i] - s[i] for i in range(d)] for x in fit]
    v = np.array([[float(Fraction(sum(r[i] * r[j] for r in y), n**3)) for j in range(d)] for i in range(d)])
    e, u = np.linalg.eigh(v)
    return n, [sum((n * a - b) ** 2 for a, b in zip(x, s)) for x in xs], v, e[::-1], u[:, ::-1].T


@pytest.fixture(scope="module")
def vectors():
    rnd = np.random.RandomState(3)
    base = rnd.randn(400, 20) * np.linspace(0.2, 3, 20)
    base[:, 1] = base[:, 0] * 0.8 + base[:, 1] * 0.1
    out = [(i, [float(np.float32(c)) for c in v]) for i, v in enumerate(base)]
    return out + [(500 + i, out[5][1]) for i in range(120)] + [(None, out[7][1]), (3, out[3][1])]


def vector_frame(spark, rows, kind="float"):
    return spark.createDataFrame([(i, v, "c", "x", 1.0) for i, v in rows], f"vec_id bigint, embedding array<{kind}>, component string, x string, n double").repartition(3)


def test_whitening_equals_brute_force(spark, vectors):
    bad = [(900, None), (901, [None] * 20), (902, [float("nan")] + [0.0] * 19), (903, [float("inf")] + [0.0] * 19), (904, [1.0]), (905, [])]
    rows = whitening.whiten(vector_frame(spark, vectors + bad)).collect()
    n, deviation, v, e, u = brute_whitening(vectors)
    assert len(rows) == 16 * len(vectors) and {r.n for r in rows} == {n}
    assert Counter((r.vec_id, r.deviation) for r in rows) == Counter({k: 16 * c for k, c in Counter((i, d) for (i, _), d in zip(vectors, deviation)).items()})
    assert max(r.identity_error for r in rows) < 1e-9
    explained = {r.component: r.explained for r in rows}
    assert sorted(explained) == list(range(1, 17))
    assert all(explained[c] == pytest.approx(e[c - 1] / np.trace(v), rel=1e-9) for c in explained)
    x = {i: np.array([math.floor(64 * c) + 1_000_000 for c in vec], dtype=float) for i, vec in vectors}
    mean = np.mean(sorted(set(map(tuple, x.values()))), axis=0)
    for r in rows[::7]:
        want = (x[r.vec_id] - mean) @ u[r.component - 1] / math.sqrt(e[r.component - 1])
        assert abs(r.whitened) == pytest.approx(abs(want), abs=1e-7)
    signs = defaultdict(set)
    for r in rows:
        want = (x[r.vec_id] - mean) @ u[r.component - 1]
        if abs(want) > 1e-6:
            signs[r.component].add(np.sign(want) == np.sign(r.whitened))
    assert all(len(x) == 1 for x in signs.values())


def test_polarisation_is_exact_beyond_64_bits():
    rnd = random.Random(1)
    z = np.array([[rnd.randint(-(2**61), 2**61) for _ in range(3)] for _ in range(500)], dtype=np.int64)
    assert whitening.exact_sums(z) == [sum(int(v) ** 2 for v in z[:, i]) for i in range(3)]
    assert whitening.exact_sums(z[:0]) == [0, 0, 0]
    with pytest.raises(OverflowError):
        whitening.centred(z, 100, [0, 0, 0])
    assert whitening._deviation(np.full((1, 3), 2**31)) == [3 * 2**62]


def test_whitening_edges(spark, vectors):
    assert whitening.whiten(vector_frame(spark, [])).collect() == []
    assert whitening.whiten(vector_frame(spark, [(1, None), (2, [])])).collect() == []
    assert whitening.whiten(vector_frame(spark, [(1, [1.0, 2.0]), (2, [1.0, 2.0])])).collect() == []  # no variance
    line = whitening.whiten(vector_frame(spark, [(1, [0.0, 0.0]), (2, [1.0, 1.0]), (3, [2.0, 2.0])], "double")).collect()
    assert {r.component for r in line} == {1} and {r.n for r in line} == {3} and line[0].explained == pytest.approx(1)
    assert sorted(abs(r.whitened) for r in line) == pytest.approx([0, math.sqrt(1.5), math.sqrt(1.5)])


# ------------------------------------------------------------------ 13


class Brute:
    def __init__(self):
        import sentencepiece
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_file(A)
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_file=B)
        letters = {chr(v): k for k, v in tokens.BYTE_LETTERS.items()}
        self.a_bytes = {i: bytes(letters.get(c, ord(c) & 255) for c in t) for t, i in self.a.get_vocab().items()}

    def groups(self, text):
        if not text:
            return []
        a = self.a.encode(" " + text, add_special_tokens=False).ids
        b = self.b.encode(text)
        ab = [self.a_bytes[i] for i in a]
        bb = [bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace("▁", " ").encode() for i in b for p in [self.b.id_to_piece(i)]]
        whole = (" " + text).encode()
        if b"".join(ab) != whole or b"".join(bb) != whole:
            return []
        out, i, j = [], 0, 0
        ends_a, ends_b = np.cumsum([len(x) for x in ab]).tolist(), np.cumsum([len(x) for x in bb]).tolist()
        at_a, at_b = {e: k for k, e in enumerate(ends_a)}, {e: k for k, e in enumerate(ends_b)}
        for e in ends_a:
            if e in at_b:
                out.append((a[i : at_a[e] + 1], b[j : at_b[e] + 1]))
                i, j = at_a[e] + 1, at_b[e] + 1
        return out

    def table(self, rows):
        grouped = [(d, self.groups(t)) for d, t in rows]
        held = [Counter((x, y) for ga, gb in g for x in ga for y in gb) for _, g in grouped]
        count = Counter(p for h in held for p in h)
        best = {}
        for (x, _), n in count.items():
            best[x] = max(best.get(x, 0), n)
        out = []
        for (d, g), h in zip(grouped, held):
            text = ";".join(",".join(map(str, x)) + "|" + ",".join(map(str, y)) for x, y in g)
            out.append((d, sum(len(x) for x, _ in g), sum(len(y) for _, y in g), len(g), sum(h.values()),
                        sum(c for p, c in h.items() if count[p] == best[p[0]]), sum(c * count[p] for p, c in h.items()),
                        hashlib.sha256(text.encode()).hexdigest() if g else ""))
        return sorted(out, key=repr)


@pytest.mark.parametrize("hot", [0, 40, 1 << 18])
def test_alignment_equals_brute_force(spark, hot):
    body = texts()
    rows = [(i if i % 11 else None, t) for i, t in enumerate(body)] + [(4, body[4])] * 5
    got = alignment.align(doc_frame(spark, rows), A, B, hot_pairs=hot)
    assert got.columns == ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    assert sorted(map(tuple, got.collect()), key=repr) == Brute().table(rows)


def test_wide_groups_count_distinct_ids(monkeypatch):
    whole = alignment.Aligner(A, B).align(texts())
    monkeypatch.setattr(alignment, "WIDE", 2)
    for x, y in zip(whole, alignment.Aligner(A, B).align(texts())):
        assert x[:5] == y[:5] and x[5].tolist() == y[5].tolist() and x[6].tolist() == y[6].tolist()


def test_gallop_finds_lower_bounds():
    rnd = np.random.RandomState(2)
    for _ in range(200):
        a, b = (np.unique(rnd.randint(0, 900, rnd.randint(0, 400))) for _ in range(2))
        assert alignment.gallop(a, b, rnd.randint(-5, 900, len(a))).tolist() == np.searchsorted(b, a).tolist()


def test_piece_encoder_equals_the_library():
    import sentencepiece

    lib, enc = sentencepiece.SentencePieceProcessor(model_file=B), alignment.PieceEncoder(B)
    for t in texts():
        if t and "▁" not in t:
            assert enc.encode(t).tolist() == lib.encode(t)


def test_alignment_of_nothing(spark):
    assert alignment.align(doc_frame(spark, []), A, B).collect() == []
    assert [tuple(r) for r in alignment.align(doc_frame(spark, [(1, None), (2, "a▁")]), A, B).orderBy("doc_id").collect()] == [
        (1, 0, 0, 0, 0, 0, 0, ""), (2, 0, 0, 0, 0, 0, 0, "")]
