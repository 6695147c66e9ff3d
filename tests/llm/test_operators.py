"""The ten operators against brute force on small fixtures with nulls, empty and long texts, ties,
repeated rows, empty tables and columns whose names clash with the operators' own."""

import hashlib
import os
import re
import time
import unicodedata
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from panelspark.llm import ann, decontam, jaccard, langid, packing, quality, substrings, text, tokens, toxicity, urls
from panelspark.llm.common import materialize

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint, score double, rn int, items string"


def words(n, seed, vocabulary=4000):
    return [f"w{x}" for x in np.random.RandomState(seed).randint(0, vocabulary, n)]


@pytest.fixture(scope="module")
def rows():
    base = words(300, 1)
    near = [w if i % 60 else w + "x" for i, w in enumerate(base)]
    passage = words(60, 2)
    out = [(1, " ".join(base)), (2, " ".join(base)), (3, " ".join(near)), (4, None), (5, ""), (6, " \n\t "), (7, "Only, three words."),
           (8, "Only, three words."), (9, " ".join(words(90, 3) + passage + words(50, 4))), (10, "\n".join(words(20, 5) + passage)),
           (11, "loop " * 500), (12, "É\u0301t\u00e9 \u4e2d\u6587 caf\u00e9 " * 30), (13, " ".join(words(30_000, 6))), (None, "no id here at all, really"),
           (14, " ".join(words(80, 7))), (14, " ".join(words(80, 7))), (15, "x" * 9000 + " y"), (16, "a\x0bb\x0cc\rd e\u00a0f")]
    return [(d, t, "en", "s", len(t or ""), 0.5, 1, "z") for d, t in out]


@pytest.fixture(scope="module")
def docs(spark, rows):
    return spark.createDataFrame(rows, SCHEMA).repartition(3).cache()


def test_span_hashes_depend_on_bytes_alone():
    data = b" ".join(x.encode() for x in words(60_000, 8)) + b" " + b"q" * 10_000 + b" " + b"q" * 10_000
    buf = np.frombuffer(data, dtype=np.uint8)
    s, e, _ = text.words(buf, np.array([0, len(data)]))
    seen, back = {}, {}
    for a, z, h in zip(s, e, text.span_hashes(buf, s, e)):
        w = data[a:z]
        assert seen.setdefault(w, h) == h and back.setdefault(h, w) == w


def test_windows_and_sliding_min():
    h = np.random.RandomState(0).randint(0, 2**63, 200).astype(np.uint64)
    for k in (1, 2, 5, 35, 200, 201):
        got = text.windows(h, k)
        assert len(got) == max(0, 200 - k + 1) and len(set(got.tolist())) == len(got)
        assert text.sliding_min(h, k).tolist() == [h[i : i + k].min() for i in range(200 - k + 1)]
    assert text.windows(np.concatenate([h, h]), 7)[3] == text.windows(np.concatenate([h, h]), 7)[203]


@pytest.mark.parametrize("name", ["word_bpe_49k.json", "byte_bpe_50k.json"])
def test_every_letter_equals_the_library(name):
    """Some letters turn into a letter and a mark, and marks join punctuation."""
    enc = tokens.Encoder(tokens.tokenizer_path(name))
    letters = [chr(c) for c in range(0x20000) if unicodedata.category(chr(c))[0] == "L"]
    forms = [f for x in letters for f in (x, x + ".", "a" + x + "!", x + "7", "a" + x + "b")]
    forms += ["SAHİ!", "KADIKÖYİ.", "ভয়.", "সময়, হয়."]
    wrong = [f for f, w in zip(forms, enc.tokenizer.encode_batch(forms, add_special_tokens=False))
             if np.frombuffer(enc.encode(f), dtype=enc.type).tolist() != w.ids]
    assert wrong == []


def test_rows_of_one_id_spread_over_ranges(spark):
    many = spark.createDataFrame([(None, f"text {i}") for i in range(2000)] + [(i, "x") for i in range(500)], "doc_id bigint, text string")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    parts = [p for p in tokens.in_order(many).rdd.glom().map(lambda p: [r.doc_id for r in p]).collect() if p]
    spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert max(map(len, parts)) < 1500 and len(parts) > 2
    ids_ = [-1 if d is None else d for p in parts for d in p]
    assert ids_ == sorted(ids_)


@pytest.mark.parametrize("name", ["word_bpe_49k.json", "byte_bpe_50k.json"])
def test_encoder_equals_the_library(name):
    enc = tokens.Encoder(tokens.tokenizer_path(name))
    odd = ["a  b", "a   b \n\n c", " a b ", "\n x", "x\n", "a\tb c", "don't  't 's it's", "a \n b", "a\u00a0b", "  ", "\r\n", "é\u0301 x \u0301y",
           "<|endoftext|> a", "１２ ½ word, x., ...", "ÉCOLE École ΣΑΣ ß İ ﬁ.", "中文 字, の", "a\0b\n\0", " . , !", "A.B. c.,d,.", "ª º ǅ", "\x1c x\x85y", "x" * 300]
    for t in odd * 2:
        assert np.frombuffer(enc.encode(t), dtype=enc.type).tolist() == enc.tokenizer.encode(t, add_special_tokens=False).ids, t


def test_token_files(spark, docs, rows, tmp_path):
    path = tokens.tokenizer_path("word_bpe_49k.json")
    lib = tokens.Encoder.open(path).tokenizer
    got = tokens.encode_and_read(docs, str(tmp_path / "f"), path).collect()
    want = {(d, t): [*lib.encode(t or "", add_special_tokens=False).ids, 2] for d, t, *_ in rows}
    assert len(got) == len(rows) and [r.doc_id for r in sorted(got, key=lambda r: r.start)] == sorted((d for d, *_ in rows), key=lambda d: (d is not None, d))
    at = 0
    for r in sorted(got, key=lambda r: r.start):
        assert r.start == at
        at += r.n_tokens
        crcs = {(len(x), zlib.crc32(np.array(x, "<u4").tobytes())) for (d, _), x in want.items() if d == r.doc_id}
        assert (r.n_tokens, r.ids_crc32) in crcs
    few = {r.doc_id: r.ids for r in tokens.fetch(spark, str(tmp_path / "f"), [3, 12, 999]).collect()}
    assert few == {d: x for (d, _), x in want.items() if d in (3, 12)}
    assert tokens.fetch(spark, str(tmp_path / "f"), []).collect() == []
    assert tokens.encode_and_read(docs.limit(0), str(tmp_path / "e"), path).collect() == []


def test_packing(docs, rows):
    path = tokens.tokenizer_path("byte_bpe_50k.json")
    lib = tokens.Encoder.open(path).tokenizer
    got = packing.pack(docs.where("doc_id is not null and doc_id != 14"), path).collect()
    want = {d: [*lib.encode(t or "", add_special_tokens=False).ids, 0] for d, t, *_ in rows if d not in (None, 14)}
    by, seq = defaultdict(list), defaultdict(list)
    for r in got:
        by[r.doc_id].append(r)
        seq[r.sequence_id].append(r)
    assert by.keys() == want.keys()
    for d, ps in by.items():
        at = 0
        for p in sorted(ps, key=lambda p: p.start):
            assert p.start == at and p.doc_tokens == len(want[d])
            assert p.ids_crc32 == zlib.crc32(np.array(want[d][at : at + p.length], "<u4").tobytes())
            at += p.length
        assert at == len(want[d])
    for ps in seq.values():
        at = 0
        for p in sorted(ps, key=lambda p: p.offset):
            assert p.offset == at
            at += p.length
        assert at <= 1024 and {p.sequence_tokens for p in ps} == {at}
        assert {p.padding for p in ps} == {0 if at & (at - 1) == 0 else 1024 - at}
    order = [p.doc_id for p in sorted(got, key=lambda p: (p.sequence_id, p.offset))]
    assert order == sorted(order)
    assert packing.pack(docs.limit(0), path).collect() == []


def test_packing_frees_its_pieces(spark, docs):
    """The pipeline's workers live on through stages and runs: a task's remembered pieces end with it."""
    path = tokens.tokenizer_path("byte_bpe_50k.json")
    known = docs.where("doc_id is not null and doc_id != 14").coalesce(1)
    keep = {tuple(r) for r in packing.pack(known, path).collect()}
    assert {tuple(r) for r in packing.pack(known, path, remember=False).collect()} == keep
    enc = tokens.Encoder(path)
    ids = [enc.encode(t) for t in ("one two", "two, three")]
    assert enc.memo or enc.spaced
    enc.forget()
    assert not enc.memo and not enc.spaced and [enc.encode(t) for t in ("one two", "two, three")] == ids
    import inspect

    import corpus_pipeline
    assert "remember=False" in inspect.getsource(corpus_pipeline.pack)


def test_plan_is_optimal():
    rnd = np.random.RandomState(3)
    for _ in range(30):
        places = np.unique(rnd.randint(1, 60, 14))
        cost = rnd.choice([0.0, 1.0, 4.0], len(places))
        places, cost = np.append(places[places < 60], 60), np.append(cost[places < 60], 0.0)
        if np.diff(np.append(0, places)).max() > 16:
            continue
        p, pen = [0, *places.tolist()], [0.0, *cost.tolist()]
        price = lambda n: 0 if n & (n - 1) == 0 else 16 - n
        f = [0.0]
        for i in range(1, len(p)):
            f.append(min(f[j] + price(p[i] - p[j]) for j in range(i) if p[i] - p[j] <= 16) + pen[i] + packing.OPEN)
        cuts, at, total = packing.plan(places, cost, 16), 0, 0.0
        for c in cuts:
            total += price(c - at) + packing.OPEN + pen[p.index(c)]
            at = c
        assert total == pytest.approx(f[-1])


def brute_terms(t):
    low = (t or "").translate({c: c + 32 for c in range(65, 91)})
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)


def test_decontamination(spark, docs, rows):
    bench = [(7, " ".join(words(300, 1)[40:90]).upper()), (11, "ONLY three"), (70, None), (None, "really"), (8, "..."), (9, " ".join(words(15, 99)))]
    items = spark.createDataFrame([(i, t, 1) for i, t in bench], "item_id bigint, text string, doc_id int")
    wins = defaultdict(set)
    for i, t in bench:
        w = brute_terms(t)
        for a in range(max(len(w) - 9, 1) if w else 0):
            wins[tuple(w[a : a + 10])].add(i)
    want = Counter()
    for d, t, *_ in rows:
        w, hit, found = brute_terms(t), set(), set()
        for win, who in wins.items():
            for a in range(len(w) - len(win) + 1):
                if tuple(w[a : a + len(win)]) == win:
                    hit |= set(range(a, a + len(win)))
                    found |= who
        names = sorted(str(x) for x in found if x is not None)
        want[(d, len(w), len(hit), len(names), hashlib.sha256(",".join(names).encode()).hexdigest(), bool(hit))] += 1
    assert sum(k[-1] * n for k, n in want.items()) >= 5
    index = materialize(decontam.build_index(docs, 400))
    found = []
    for size, group in ((7, 1), (7, 3), (100_000, 1)):  # blocks joined to groups of shards, or sent to all tasks
        assert (decontam.phrase_blocks(items, size=size).count() > decontam.SHARED_BLOCKS) == (size == 7)
        got = decontam.matches(index, items, block_windows=size, group_shards=group).collect()
        assert len(got) == sum(k[-1] * n for k, n in want.items())
        found.append(Counter((r.doc_id, r.text_hash, tuple(r["items"]), tuple(r.spans)) for r in got))
    assert found[0] == found[1] == found[2]
    assert Counter(tuple(r) for r in decontam.decontaminate(docs, items).collect()) == want
    assert decontam.decontaminate(docs.limit(0), items).collect() == []
    assert not decontam.decontaminate(docs, items.limit(0)).where("contaminated").count()
    kept = decontam.keep_clean(docs, items)
    assert kept.columns == docs.columns and kept.count() == sum(n for k, n in want.items() if not k[-1])


def test_proximity(spark):
    docs = spark.createDataFrame([(1, "alpha x x beta gamma"), (2, "gamma beta y alpha"), (3, "alpha beta"), (4, "beta alpha " + "z " * 20 + "gamma")], "doc_id bigint, text string")
    items = spark.createDataFrame([(5, "alpha beta gamma")], "item_id bigint, text string")
    for shared in (0, 4):
        got = decontam.matches(decontam.build_index(docs), items, slop=4, shared_blocks=shared)
        assert sorted(r.doc_id for r in got.collect()) == [1, 2]


def test_quality(spark):
    rnd = np.random.RandomState(0)
    good = lambda s: " ".join(np.random.RandomState(s).choice(["the", "river", "runs", "under", "stone", "bridges", "and", "old", "mills"], 40))
    junk = lambda s: "!! ".join(np.random.RandomState(s).choice(["BUY", "NOW", "CHEAP"], 40)) if s % 2 else "spam " * 60
    data = [(i, good(i) if i % 5 else junk(i // 5), "x") for i in range(300)] + [(1000, None, "x"), (1001, "", "x"), (None, good(5), "x"), (7, good(7), "x")]
    docs = spark.createDataFrame(data, "doc_id bigint, text string, kept string")
    labels = spark.createDataFrame([(i, int(i % 5 != 0)) for i in rnd.permutation(300)[:200].tolist()] + [(None, 1), (3, None)], "doc_id bigint, quality int")
    got = quality.resample(docs, labels).collect()
    assert len(got) == len(data)
    lost = [r.doc_id for r in got if not r.kept and r.doc_id is not None and r.doc_id < 300]
    assert sum(d % 5 == 0 for d in lost) >= 55 and sum(d % 5 != 0 for d in lost) <= 3
    assert quality.resample(docs.limit(0), labels).collect() == []
    assert all(r.kept for r in quality.resample(docs, labels.limit(0)).collect())
    assert quality.keep_sampled(docs, labels).count() == sum(r.kept for r in got)


def test_kth_largest(spark):
    from panelspark.llm.common import kth_largest

    v = [5, 5, -(2**62), 2**62, 0, -1, 7, 7, 7]
    df = spark.createDataFrame([(x,) for x in v], "x bigint")
    for k in range(1, len(v) + 1):
        assert kth_largest(df, "x", k) == sorted(v, reverse=True)[k - 1]
    assert kth_largest(df, "x", 10) is None


def test_quality_keeps_nothing_where_nothing_is_good(spark, monkeypatch):
    bad = quality.Model(np.zeros(quality.SLOTS, dtype=np.float32), 0.1, (1.0, -12.0))
    monkeypatch.setattr(quality, "fit", lambda docs, labels: bad)
    docs = spark.createDataFrame([(i, f"loop loop loop {i}") for i in range(5)], "doc_id bigint, text string")
    assert [r.kept for r in quality.resample(docs, None).collect()] == [False] * 5
    assert quality.keep_sampled(docs, None).count() == 0


def test_toxicity(spark):
    calm = ["meadow", "lantern", "harbour", "window", "pepper", "violin", "garden", "copper", "winter", "ribbon", "saddle", "timber"]
    mean = ["nastyfool", "vileoaf", "dimwitted"]

    def doc(s, toxic):
        r = np.random.RandomState(s)
        w = list(r.choice(calm, 60))
        for p in r.randint(0, 60, 4) if toxic else ():
            w[p] = r.choice(mean)
        return " ".join(w)

    data = [(i, doc(i, i % 4 == 0), "en") for i in range(400)] + [(900, None, "en"), (901, "", "en"), (None, doc(4, True), "en"), (8, doc(8, True), "en")]
    docs = spark.createDataFrame(data, "doc_id bigint, text string, score string")
    labels = spark.createDataFrame([(i, int(i % 4 == 0)) for i in range(400)] + [(None, 1), (5, None)], "doc_id bigint, toxic int")
    got = toxicity.classify(docs, labels).collect()
    assert len(got) == len(data) and all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.7) for r in got)
    held = [r for r in got if r.held_out]
    assert {r.doc_id for r in held} == {d for d, *_ in data if d is not None and zlib.crc32(str(d).encode()) % 3 == 1}
    assert np.mean([r.predicted == int(r.doc_id % 4 == 0) for r in held if r.doc_id < 400]) > 0.95
    assert {r.predicted for r in got if r.doc_id in (900, 901)} == {0}
    assert {r.score for r in toxicity.classify(docs, labels.where("toxic = 1")).collect()} == {0.0}
    assert toxicity.classify(docs.limit(0), labels).collect() == []


def test_toxic_wording_that_ordinary_texts_also_hold():
    """Every toxic text holds four words of a stem, one ordinary text in five holds one of them."""
    syllables = ["ver", "ach", "lun", "keit", "mor", "gen", "tal", "rup", "ein", "sch", "bel", "ond"]

    def doc(s, toxic):
        r = np.random.RandomState(s)
        w = ["".join(r.choice(syllables, r.randint(1, 5))) for _ in range(80)]
        for p in r.randint(0, 80, 4 if toxic else int(s % 5 == 0)):
            w[p] = "achlurun" + "".join(r.choice(syllables, 2))
        return " ".join(w).encode()

    m = toxicity.fit_texts([doc(s, True) for s in range(200)], [doc(s, False) for s in range(1000, 1600)])
    cs = m.compressors()
    said = lambda s, toxic: m.score(toxicity.savings(doc(s, toxic), *cs)) >= toxicity.THRESHOLD
    assert np.mean([said(s, True) for s in range(5000, 5100)]) > 0.8
    assert np.mean([said(s, False) for s in range(6000, 6300)]) < 0.05


def test_toxic_stems_leave_the_common_content():
    assert toxicity.without("a vileoaf, vileoafs and vile".encode(), [b"vileoaf", b"vileoafs"]) == b"a ,  and vile"
    words = toxicity.own_words([b"vileoafs here", b"vileoaf there", b"calm here"], [b"calm here", b"calm there", b"vileness"])
    assert words[0] == b"vileoaf" and b"calm" not in words
    ordinary, toxic = toxicity.dictionaries(b"calm vileoaf here", [b"vileoaf", b"oafish"], 8)
    assert ordinary == b"calm  here" and toxic == ordinary + b" vileoaf "


def test_toxicity_learns_beside_a_very_long_text(spark):
    first = spark.range(100).selectExpr("id", "id % 2 as y").selectExpr("y", "id", "xxhash64(id) as h").groupBy("y").agg({"h": "min"})
    long = {r.id for r in spark.range(100).selectExpr("id", "id % 2 as y", "xxhash64(id) as h").join(first, "y").where("h = `min(h)`").collect()}
    assert {i % 2 for i in long} == {0, 1}
    data = [(i, " ".join(words(60, i)) + " vileoaf" * (i % 2) + " more" * 60_000 * (i in long)) for i in range(100)]
    docs = spark.createDataFrame(data, "doc_id bigint, text string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(100)], "doc_id bigint, toxic int")
    seen = []
    learn = toxicity.fit_texts
    toxicity.fit_texts = lambda t, o: seen.append((t, o))
    try:
        toxicity.fit(docs, labels, fit_bytes=400_000)
    finally:
        toxicity.fit_texts = learn
    assert [len(x) for x in seen[0]] == [50, 50] and max(len(d) for x in seen[0] for d in x) == 5_000


def test_language(spark):
    forms = {"aa": ["the", "and", "with", "house"], "bb": ["der", "und", "mit", "haus"], "cc": ["ça", "été", "où", "maison"]}
    data = [(i, " ".join(np.random.RandomState(i).choice(forms[k], 30)), k) for i, k in enumerate([*forms] * 60)]
    odd = [(500, None, "aa"), (501, "", "bb"), (502, "12 !! ...", "aa"), (None, "the house", "aa"), (503, "und mit", None), (3, data[3][1], data[3][2])]
    docs = spark.createDataFrame(data + odd, "doc_id bigint, text string, lang string")
    got = langid.identify(docs).collect()
    assert len(got) == len(data) + len(odd) and all(0 <= r.score <= 1 for r in got)
    assert {r.lang_pred for r in got if r.doc_id in (500, 501, 502)} == {"und"}
    truth = {d: k for d, _, k in data} | {503: "bb"}
    assert all(r.lang_pred == truth[r.doc_id] for r in got if r.doc_id in truth)
    assert {r.doc_id for r in got if r.held_out} == {d for d, *_ in data + odd if d is not None and zlib.crc32(str(d).encode()) % 4 == 2}
    assert {r.lang_pred for r in langid.identify(docs.selectExpr("doc_id", "text", "cast(null as string) as lang")).collect()} == {"und"}
    assert langid.identify(docs.limit(0)).collect() == []


def test_neighbours(spark):
    r = np.random.RandomState(0)
    x = r.randn(600, 16).astype(np.float32)
    x[100:300] = x[100]  # one vector very often
    data = [(i, [float(a) for a in v], 1) for i, v in enumerate(x)]
    odd = [(1000, None, 1), (1020, [0.0] * 16, 1), (1040, [float("nan")] * 16, 1), (1060, [1.0] * 15 + [float("inf")], 1), (1080, [], 1), (None, [1.0] * 16, 1),
           (1100, [1.0, None] * 8, 1), (1120, [1.0] * 3, 1), data[20], data[20]]
    df = spark.createDataFrame(data + odd, "vec_id bigint, embedding array<float>, rank int")
    got = defaultdict(list)
    for q in ann.search(df, k=8, block=50).orderBy("query_id", "rank").collect():
        got[q.query_id].append(q)
    assert got.keys() == set(range(0, 600, 20))
    hits = 0
    for q, rows_ in got.items():
        s = (x.astype(np.float64) * x[q].astype(np.float64)).sum(axis=1)
        want = [i for i in np.lexsort((np.arange(600), -s)) if i != q][:20]
        assert [p.rank for p in rows_] == list(range(1, 21)) and all(p.score == s[p.vec_id] for p in rows_)
        hits += len({p.vec_id for p in rows_} & set(want))
        if 100 <= q < 300:
            assert [p.vec_id for p in rows_] == want
    assert hits / (20 * len(got)) >= 0.9
    few = ann.search(df.where("vec_id < 5 or vec_id = 20")).collect()
    assert sorted((p.query_id, p.rank) for p in few) == [(q, k) for q in (0, 20) for k in range(1, 6)]
    assert ann.search(df.limit(0)).collect() == [] and ann.search(df.where("vec_id = 1000")).collect() == []


def test_cell_runs():
    counts, salts = np.array([3, 0, 2, 5, 1, 9, 1]), np.array([1, 1, 1, 1, 1, 3, 1])
    first = np.array([0, 0, 0, 1, 1, 2, 1])
    got = ann.cell_runs(np.array([6, 2, 5, 0, 3]), counts, salts, first)
    assert got[0] == [0, 1, 2, 3, 4]
    assert [x.tolist() for x in got[1]] == [[0, 2], [3, 3, 6, 6], [5, 5], [5, 5], [5, 5]]


def test_neighbours_of_doubles_in_blocks(spark):
    """Components beyond the range and the precision of floats; many query blocks a bucket."""
    r = np.random.RandomState(1)
    x = r.randn(300, 6) + 1e-12 * r.randn(300, 6)
    x[20], x[33] = 1e39, 1e200
    df = spark.createDataFrame([(i, [float(a) for a in v]) for i, v in enumerate(x)] + [(300, [float("inf")] * 6)],
                               "vec_id bigint, embedding array<double>")
    for size in (2, 1_000):
        got = defaultdict(list)
        for q in ann.search(df, every=10, top=5, candidates=300, k=4, block=40, asked_block=size).orderBy("query_id", "rank").collect():
            got[q.query_id].append((q.vec_id, q.score))
        assert got.keys() == set(range(0, 300, 10))
        for q, rows_ in got.items():
            s = (x * x[q]).sum(axis=1)
            want = [i for i in np.lexsort((np.arange(300), -s)) if i != q][:5]
            assert rows_ == [(i, s[i]) for i in want]


def test_urls(spark):
    rules = [("block", "bad.com/"), ("allow", "bad.com/ok"), ("block", "a.bad.com/ok"), ("block", "q.org/x?")]
    data = ["http://bad.com/x", "HTTP://www.BAD.com/okay?x", "http://a.bad.com/ok", "http://notbad.com/", "http://bad.com", None, "", "bad.com/x",
            "http://x.bad.com?y/z", "a://b://bad.com/", "http://bad.com:80/", "http://é.bad.com/é#f", "http://bad.com/\nx"]
    pages = spark.createDataFrame([(i, u, "h", "v") for i, u in enumerate(data)] + [(0, data[0], "h", "v")], "page_id bigint, url string, host string, verdict string")

    def brute(u):
        host, path = "", ""
        if u and "://" in u:
            rest = u.split("://", 1)[1]
            host = re.match(r"[^/?#]*", rest)[0]
            path = re.match(r"[^?#]*", rest[len(host) :])[0]
            host = host.translate({c: c + 32 for c in range(65, 91)})
        fits = [(len(r), r.index("/"), r, v) for v, r in rules if (host == r[: r.index("/")] or host.endswith("." + r[: r.index("/")])) and path.startswith(r[r.index("/") :])]
        return (host, path, *(max(fits)[2:] if fits else (None, "allow")))

    got = [tuple(r) for r in urls.judge(pages, rules, segment_rules=2).collect()]
    assert Counter(got) == Counter([(i, *brute(u)) for i, u in enumerate(data)] + [(0, *brute(data[0]))])
    assert urls.judge(pages.limit(0)).collect() == []
    with pytest.raises(ValueError):
        urls.checked([("block", "a/"), ("allow", "a/")])


def test_url_hash_collisions_do_not_decide(tmp_path):
    same = lambda s: 7
    (tmp_path / "s").write_bytes(urls.pack([("block", "a.com/"), ("allow", "b.com/")], same))
    seg = urls.unpack(str(tmp_path / "s"))
    rows_ = urls.lookup(seg, ["a.com/", "c.com/", "b.com/"], same)
    assert rows_[1] == -1 and sorted(rows_.tolist()) == [-1, 0, 1] and bool(seg[2][rows_[0]]) and not seg[2][rows_[2]]


def brute_substrings(texts, k):
    ws = [re.findall(r"[^\x20\x09-\x0D]+", t or "") for t in texts]
    count = Counter(tuple(w[i : i + k]) for w in ws for i in range(len(w) - k + 1))
    out = []
    for w in ws:
        gone = {i + j for i in range(len(w) - k + 1) if count[tuple(w[i : i + k])] > 1 for j in range(k)}
        out.append((len(w), len(gone), hashlib.sha256(" ".join(x for i, x in enumerate(w) if i not in gone).encode()).hexdigest()))
    return out


@pytest.mark.parametrize("bucket,bits", [(25_000, 12), (3, 6)])  # the second makes most slots overfull
def test_substrings(docs, rows, bucket, bits):
    want = Counter((d, *x) for (d, *_), x in zip(rows, brute_substrings([r[1] for r in rows], 35)))
    got = Counter(tuple(r) for r in substrings.dedup(docs, bits=bits, bucket=bucket).collect())
    assert got == want and sum(n for (_, _, gone, _), n in got.items() if gone) >= 8


def test_substrings_of_few_words(spark):
    data = [(i, " ".join(words(40, i % 3, 6))) for i in range(12)] + [(99, None)]
    df = spark.createDataFrame(data, "doc_id bigint, text string")
    want = Counter((d, *x) for (d, _), x in zip(data, brute_substrings([t for _, t in data], 6)))
    assert Counter(tuple(r) for r in substrings.dedup(df, k=6, m=2, bits=8, bucket=4).collect()) == want
    assert substrings.dedup(df.limit(0)).collect() == []


def test_without_repeats(docs):
    out = {r.doc_id: r for r in substrings.without_repeats(docs).collect()}
    assert 1 not in out and 2 not in out and 4 in out and out[4].text is None
    assert out[13].text == docs.where("doc_id = 13").first().text and out[9].n_chars == len(out[9].text)
    assert substrings.without_repeats(docs).columns == docs.columns


def brute_components(rows_, percent=80):
    sets = []
    for _, t in rows_:
        w = re.findall(r"[^\x20\x09-\x0D]+", (t or "").translate({c: c + 32 for c in range(65, 91)}))
        sets.append({tuple(w[i : i + 5]) for i in range(max(len(w) - 4, 1))} if w else set())
    root = list(range(len(sets)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, a in enumerate(sets):
        for j in range(i):
            b = sets[j]
            if a and b and 100 * len(a & b) >= percent * len(a | b):
                root[max(find(i), find(j))] = min(find(i), find(j))
    by = defaultdict(list)
    for i, (d, _) in enumerate(rows_):
        by[find(i)].append(d)
    return Counter((d, len(sets[i]), min((x for x in by[find(i)] if x is not None), default=None)) for i, (d, _) in enumerate(rows_))


def edited(seed, n, edits, of):
    w, r = words(n, of), np.random.RandomState(seed)
    for p in r.randint(0, n, edits):
        w[p] = f"e{seed}-{p}"
    return " ".join(w)


@pytest.mark.parametrize("options", [{}, {"group": 3, "hot_class": 8, "block": 4, "bits": 8}])  # the second: nearly all groups hot, small blocks
def test_jaccard(spark, docs, rows, options):
    family = [(100 + i, edited(i, 120, 1 + i % 5, 50 + i % 2)) for i in range(40)] + [(400 + i, edited(900 + i, 12, 1, 60)) for i in range(6)]
    family += [(500 + i, " ".join(words(25, 70) + words(30, 700 + i))) for i in range(12)]  # share a passage, don't link
    data = [(d, t) for d, t, *_ in rows] + family
    df = spark.createDataFrame([(d, t, "a", 1, 2) for d, t in data], "doc_id bigint, text string, rid string, n int, root int")
    got = Counter(tuple(r) for r in jaccard.near_components(df, **options).collect())
    assert got == brute_components(data)
    assert jaccard.near_components(df.limit(0)).collect() == []
    kept = jaccard.one_of_each(df, **options).collect()
    assert sorted((r.doc_id for r in kept if r.doc_id is not None)) == sorted(
        {c for d, n, c in brute_components(data) if n and c is not None} | {4, 5, 6}) and kept[0].__fields__ == df.columns


def test_documents_without_words_all_stay(spark):
    data = [(1, "\t\n"), (1, "\t\n"), (None, "\t\n"), (None, "\t\n"), (2, ""), (2, ""), (3, None), (4, "a b"), (4, "a b"), (5, "a b")]
    kept = jaccard.one_of_each(spark.createDataFrame(data, "doc_id bigint, text string").repartition(3)).collect()
    assert sorted(map(tuple, kept), key=repr) == sorted(data[:7] + [(4, "a b")], key=repr)
    assert jaccard.one_of_each(spark.createDataFrame([], "doc_id bigint, text string, _bare int")).collect() == []


def test_overlap_bounds():
    for a in range(1, 40):
        for b in range(1, 40):
            need = next((o for o in range(min(a, b) + 1) if 100 * o >= 80 * (a + b - o)), None)
            if need is not None:
                assert jaccard.overlap_needed(a, b) == need
            else:
                assert jaccard.overlap_needed(a, b) > min(a, b)


def test_min_links(spark):
    from panelspark.llm.common import min_links

    edges = [(i, i + 1) for i in range(1, 40)] + [(100, 50), (100, 60), (70, 60), (80, 80)]
    got = {r.node: r.root for r in min_links(spark.createDataFrame(edges, "a bigint, b bigint")).collect()}
    assert got == {**{i: 1 for i in range(1, 41)}, 50: 50, 60: 50, 70: 50, 100: 50}


def shuffle_files(spark):
    files = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles().mkString("\n").split("\n")
    return {f for f in files if "/shuffle_" in f}


def test_materialize_leaves_no_shuffle_files(spark):
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    df = spark.range(1000).selectExpr("id % 7 as k").groupBy("k").count()
    before, setting = shuffle_files(spark), spark.conf.get(key, None)
    assert sorted(tuple(r) for r in materialize(df).collect()) == sorted((k, 143 if k < 6 else 142) for k in range(7))
    assert spark.conf.get(key, None) == setting
    end = time.time() + 20  # files are deleted in the background
    while not shuffle_files(spark) <= before and time.time() < end:
        time.sleep(0.1)
    assert shuffle_files(spark) <= before


def test_marks(spark):
    from panelspark.llm.common import marks, with_mark

    keys = spark.createDataFrame([(i, None if i % 3 else i) for i in range(0, 3000, 2)] + [(None, 5), (None, None)], "a bigint, b bigint")
    rest = spark.createDataFrame([(i, None if i % 3 else i) for i in range(1, 3000, 2)], "a bigint, b bigint")
    assert with_mark(keys.union(keys), marks(keys), "a", "b").where("_llm_marked").count() == 2 * keys.count()
    assert with_mark(rest, marks(keys), "a", "b").where("_llm_marked").count() < 20
    assert with_mark(keys, marks(keys.limit(0)), "a", "b").where("_llm_marked").count() == 0


def test_stored_sets_without_a_shuffle_of_texts(spark, docs, monkeypatch):
    plans = []

    def kept(df, name="t"):
        plans.append((name, df._jdf.queryExecution().toString()))
        return materialize(df, name)

    setting = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        join = jaccard.Join(docs)
        sets = join.sets().where("n > 0")
        all_ = {r.rid: r.n for r in sets.collect()}
        classes = sets.groupBy("rid").agg({"place": "min"}).withColumnRenamed("min(place)", "place")
        monkeypatch.setattr(jaccard, "materialize", kept)
        wanted = sorted(all_)[::2]
        got = join.stored(spark.createDataFrame([(r,) for r in wanted * 2], "rid bigint"), classes).collect()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", setting)
    assert sorted((r.rid, len(r.tokens) // 8, jaccard.set_id(np.frombuffer(r.tokens, np.uint64))) for r in got) == [(r, all_[r], r) for r in wanted]
    plan = dict(plans)["sets"]
    assert "hashpartitioning(place" not in plan and "MapInArrow" in plan


def test_documents_that_stay_are_not_shuffled(spark):
    data = [(i, " ".join(words(2000, 5000 + i))) for i in range(150)] + [(200, " ".join(words(2000, 5000)))] + [(None, " ".join(words(300, 5200)))] * 3
    df = materialize(spark.createDataFrame(data, "doc_id bigint, text string").repartition(3))
    out = jaccard.one_of_each(df)
    size = lambda: sum(os.path.getsize(f) for f in shuffle_files(spark) if os.path.exists(f))
    setting = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        before = size()
        got = out.collect()
        moved = size() - before
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", setting)
    assert sorted(map(tuple, got), key=repr) == sorted(data[:150] + data[-1:], key=repr)
    assert moved < sum(len(t) for _, t in data) / 10
