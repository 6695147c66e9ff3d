"""Token-id files (operator 1), and the tokenizing that packing shares.

File format: a Parquet table of chunks in ascending document order. A chunk holds the zstandard
frames of its documents one after another, each compressed alone with a shared dictionary, with
doc_ids, frame offsets and token counts beside them; so one document is read by one slice and one
small decompression. Every chunk names the SHA-256 of the dictionary, which is a one-row table.
"""

from __future__ import annotations

import hashlib
import re
import unicodedata
import zlib
from array import array

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from panelspark.llm.common import ids, lean, rows

END_ID = 2
DICT_BYTES = 64 << 10
FIT_ROWS = 2_000  # documents the dictionary is trained on, by least id hash
FIT_BYTES = 16 << 20  # of their ids
CHUNK_BYTES = 1 << 18  # compressed
CHUNK_DOCS = 4096
LEVEL = 3
CHUNKS = ("shard int, chunk int, dict_hash string, item_bytes int, doc_ids array<bigint>, offsets array<bigint>, "
          "counts array<bigint>, before bigint, n_tokens bigint, min_id bigint, max_id bigint, payload binary")

#: White space but the single space and line feed, as characters and pairs.
_ODD_SPACE = ["  ", " \n", "\n ", "\n\n", *"\t\r\x0b\x0c\x1c\x1d\x1e\x1f\x85\xa0\u1680\u2028\u2029\u202f\u205f\u3000", *map(chr, range(0x2000, 0x200B))]
_LONE_SPACE = re.compile(r"(?<=\S) (?=\S)")
MEMO = 900_000  # pieces whose ids a worker remembers, the first it meets: about 150 bytes each, two workers an executor


#: Letters that byte-level tokenizers write for bytes: printable ones stand for themselves, the
#: others follow from 256 on.
_PRINTABLE = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
BYTE_LETTERS = {b: 256 + i for i, b in enumerate(sorted(set(range(256)) - set(_PRINTABLE)))}


def tokenizer_path(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


class Encoder:
    """Token ids of whole texts, equal to encoding each text at once, but faster: texts are cut at
    single spaces and line ends, which no token crosses, ids of pieces are remembered, and a piece of
    letters alone goes to the tokenizer's model without its normaliser and splitter, which would
    leave it as it is."""

    _open: dict[str, Encoder] = {}

    def __init__(self, path: str):
        import os

        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        self.code = "H" if self.tokenizer.get_vocab_size() <= 1 << 16 else "I"
        self.type = np.dtype("<u2" if self.code == "H" else "<u4")
        # a tokenizer that drops white space encodes "a b" as "a" + "b", others as "a" + " b"
        self.drops_space = not self.tokenizer.encode(" ", add_special_tokens=False).ids
        self.lowers = self._whole("A") == self._whole("a")
        self.limit = MEMO
        self.memo: dict[str, bytes] = {}  # pieces as they stand
        self.spaced: dict[str, bytes] = {}  # pieces that a space precedes, without it

    @classmethod
    def open(cls, path: str, memo: int = MEMO) -> Encoder:
        """A worker's encoder, which remembers at most ``memo`` pieces (about 150 bytes each)."""
        if path not in cls._open:
            cls._open[path] = cls(path)
        cls._open[path].limit = memo
        return cls._open[path]

    def forget(self) -> None:
        """Free the remembered pieces."""
        self.memo.clear()
        self.spaced.clear()

    def _whole(self, piece: str) -> bytes:
        return array(self.code, self.tokenizer.encode(piece, add_special_tokens=False).ids).tobytes()

    def _stays_letters(self, core: str) -> bool:
        """Whether the tokenizer's normaliser leaves a letter at the end: some letters turn into a
        letter and a mark, and marks do join punctuation."""
        return core.isascii() or not self.lowers or (unicodedata.is_normalized("NFC", core) and core.lower()[-1].isalpha())

    def _letters(self, word: str, space: str) -> bytes:
        if not word.isascii():
            if self.lowers and (word != word.lower() or not unicodedata.is_normalized("NFC", word)):
                return self._whole(space + word)
            word = word.encode().decode("latin-1").translate(BYTE_LETTERS)
        return array(self.code, [t.id for t in self.model.tokenize(("Ġ" if space else "") + word)]).tobytes()

    def _piece(self, p: str) -> bytes:
        ids_ = self.spaced.get(p[1:]) if p[:1] == " " else self.memo.get(p)
        if ids_ is None:
            core = p.rstrip(".,!?")
            if len(core) < len(p) and core[-1:].isalpha() and self._stays_letters(core):
                ids_ = self._piece(core) + self._piece(p[len(core) :])  # letters never join punctuation
            else:
                word = p[1:] if p[:1] == " " else p
                ids_ = self._letters(word, p[: len(p) - len(word)]) if word.isalpha() else self._whole(p)
            if len(self.memo) + len(self.spaced) < self.limit and len(p) <= 64:
                if p[:1] == " ":
                    self.spaced[p[1:]] = ids_
                else:
                    self.memo[p] = ids_
        return ids_

    def _line(self, pieces: list[str]) -> list[bytes]:
        """Ids of pieces of which all but the first stand after a space."""
        got = list(map(self.spaced.get, pieces))
        got[0] = self._piece(pieces[0]) if pieces[0] else b""
        if None in got:
            for i, x in enumerate(got):
                if x is None:
                    p = pieces[i]
                    if p.isalpha():  # most of them
                        got[i] = x = self._letters(p, " ")
                        if len(self.memo) + len(self.spaced) < self.limit and len(p) <= 64:
                            self.spaced[p] = x
                    else:
                        got[i] = self._piece(" " + p)
        return got

    def encode(self, text: str | None) -> bytes:
        """Ids as little-endian integers of ``self.type``."""
        if not text:
            return b""
        if self.lowers:
            text = text.encode("utf-8", "surrogatepass").lower().decode("utf-8", "surrogatepass")  # A-Z alone
        if self.drops_space:
            pieces = text.replace("\n", " ").split(" ")
            got = list(map(self.memo.get, pieces))
            if None in got:
                for i, x in enumerate(got):
                    if x is None:
                        got[i] = self._piece(pieces[i])
            return b"".join(got)
        if any(map(text.__contains__, _ODD_SPACE)):
            return b"".join(self._line(_LONE_SPACE.split(text)))
        got = []
        for i, line in enumerate(text.split("\n")):
            if i:
                got.append(self._piece("\n"))
            got += self._line(line.split(" "))
        return b"".join(got)


def crc(ids_: np.ndarray) -> int:
    """Unsigned crc32 of the ids as little-endian unsigned 32-bit integers."""
    return zlib.crc32(ids_.astype("<u4").tobytes())


def in_order(docs: DataFrame) -> DataFrame:
    """``doc_id, text`` in ranges of ascending doc_id (null first; equal ids by text hash, in the ranges
    too, so that the rows of one hot id are spread)."""
    keys = [F.col("doc_id").asc_nulls_first(), F.xxhash64("text")]
    return docs.select("doc_id", "text").repartitionByRange(*keys).sortWithinPartitions(*keys)


def train_dictionary(docs: DataFrame, path: str, end_id: int = END_ID, fit_rows: int = FIT_ROWS) -> bytes:
    """A zstandard dictionary trained on the serialized ids of a bounded sample (compression only:
    every document is encoded whatever the sample)."""
    chosen = (docs.select("doc_id").where("doc_id is not null").distinct()
              .orderBy(F.xxhash64("doc_id"), "doc_id").limit(fit_rows))

    def run(batches):
        enc = Encoder.open(path)
        for b in batches:
            tail = np.array([end_id], dtype=enc.type).tobytes()
            yield pa.RecordBatch.from_pydict({"ids": pa.array([enc.encode(t) + tail for t, in rows(b, "text")], pa.binary())})

    named = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id", "left_semi")  # fit_rows ids
    samples, size = [], 0
    for r in named.select("text").mapInArrow(lean(run), "ids binary").toLocalIterator():
        if size + len(r["ids"]) <= FIT_BYTES:
            samples.append(bytes(r["ids"]))
            size += len(r["ids"])
    samples.sort()
    try:
        return zstandard.train_dictionary(DICT_BYTES, samples).as_bytes()
    except zstandard.ZstdError:  # too little to train on: the ids themselves
        return b"".join(samples)[-DICT_BYTES:]


def _dictionary(data: bytes):
    return zstandard.ZstdCompressionDict(data) if len(data) >= 8 else None


def write(docs: DataFrame, folder: str, path: str, end_id: int = END_ID, fit_rows: int = FIT_ROWS) -> None:
    """Encode every whole text (null: empty), append ``end_id`` and write the chunks in ascending
    doc_id order under ``folder``. One range shuffle of the texts; a task holds one chunk."""
    spark = docs.sparkSession
    data = train_dictionary(docs, path, end_id, fit_rows)
    name = hashlib.sha256(data).hexdigest()
    spark.createDataFrame([(name, bytearray(data))], "dict_hash string, data binary").coalesce(1).write.parquet(f"{folder}/dictionary")
    shared = spark.sparkContext.broadcast(data)  # at most DICT_BYTES

    def run(batches):
        enc, shard = Encoder.open(path), TaskContext.get().partitionId()
        z = zstandard.ZstdCompressor(level=LEVEL, dict_data=_dictionary(shared.value))
        tail = np.array([end_id], dtype=enc.type).tobytes()
        frames, docs_, counts, size, chunk, before = [], [], [], 0, 0, 0

        def flush():
            nonlocal frames, docs_, counts, size, chunk, before
            known = [d for d in docs_ if d is not None]
            row = {"shard": [shard], "chunk": [chunk], "dict_hash": [name], "item_bytes": [enc.type.itemsize],
                   "doc_ids": [docs_], "offsets": [np.cumsum([0, *map(len, frames)]).tolist()], "counts": [counts],
                   "before": [before], "n_tokens": [sum(counts)], "min_id": [min(known, default=None)],
                   "max_id": [max(known, default=None)], "payload": [b"".join(frames)]}
            chunk, before = chunk + 1, before + sum(counts)
            frames, docs_, counts, size = [], [], [], 0
            return pa.RecordBatch.from_pydict(row, schema=ARROW)

        for b in batches:
            for d, t in rows(b, "doc_id", "text"):
                raw = enc.encode(t) + tail
                f = z.compress(raw)
                frames.append(f)
                docs_.append(d)
                counts.append(len(raw) // enc.type.itemsize)
                size += len(f)
                if size >= CHUNK_BYTES or len(docs_) >= CHUNK_DOCS:
                    yield flush()
        if docs_:
            yield flush()

    in_order(docs).mapInArrow(lean(run), CHUNKS).write.option("compression", "uncompressed").parquet(f"{folder}/chunks")


ARROW = pa.schema([("shard", pa.int32()), ("chunk", pa.int32()), ("dict_hash", pa.string()), ("item_bytes", pa.int32()),
                   ("doc_ids", pa.list_(pa.int64())), ("offsets", pa.list_(pa.int64())), ("counts", pa.list_(pa.int64())),
                   ("before", pa.int64()), ("n_tokens", pa.int64()), ("min_id", pa.int64()), ("max_id", pa.int64()),
                   ("payload", pa.binary())])


def _reader(spark: SparkSession, folder: str):
    row = spark.read.parquet(f"{folder}/dictionary").first()
    data = bytes(row["data"])
    if hashlib.sha256(data).hexdigest() != row["dict_hash"]:
        raise ValueError("the dictionary file doesn't match its hash")
    shared = spark.sparkContext.broadcast((row["dict_hash"], data))

    def frames(batch, wanted=None):
        """(row, position, doc_id, ids) of the documents in a batch of chunks, or of those wanted."""
        name, content = shared.value
        z = zstandard.ZstdDecompressor(dict_data=_dictionary(content))
        col = {c: ids(batch, c) for c in batch.schema.names}
        for i in range(batch.num_rows):
            if col["dict_hash"][i].as_py() != name:
                raise ValueError("a chunk was written with another dictionary")
            payload, off = memoryview(col["payload"][i].as_buffer()), col["offsets"][i].as_py()
            kind = f"<u{col['item_bytes'][i].as_py()}"
            for j, d in enumerate(col["doc_ids"][i].as_py()):
                if wanted is None or d in wanted:
                    yield i, j, d, np.frombuffer(z.decompress(payload[off[j] : off[j + 1]]), dtype=kind)

    return frames


def read(spark: SparkSession, folder: str) -> DataFrame:
    """``doc_id, start, n_tokens, ids_crc32, n_bytes`` of every document, from the files alone."""
    frames = _reader(spark, folder)
    chunks = spark.read.schema(CHUNKS).parquet(f"{folder}/chunks")
    # one row a shard: as many as write tasks
    totals = chunks.groupBy("shard").agg(F.sum("n_tokens").alias("n"))
    order = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    base = totals.select("shard", F.coalesce(F.sum("n").over(order), F.lit(0)).alias("base"))

    def run(batches):
        for b in batches:
            base_, before, off = ids(b, "base").to_pylist(), ids(b, "before").to_pylist(), ids(b, "offsets").to_pylist()
            out, at, last = [], 0, -1
            for i, j, d, x in frames(b):
                at = base_[i] + before[i] if i != last else at
                out.append((d, at, len(x), crc(x), off[i][j + 1] - off[i][j]))
                at, last = at + len(x), i
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in (zip(*out) if out else [[]] * 5)],
                                             names=["doc_id", "start", "n_tokens", "ids_crc32", "n_bytes"])

    inner = chunks.join(F.broadcast(base), "shard").select("dict_hash", "item_bytes", "doc_ids", "offsets", "before", "payload", "base")
    return inner.mapInArrow(lean(run), "doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint, n_bytes bigint")


def fetch(spark: SparkSession, folder: str, doc_ids: list[int]) -> DataFrame:
    """``doc_id, ids`` of a few documents: other chunks are skipped by their id ranges, and only the
    frames asked for are decompressed."""
    frames, wanted = _reader(spark, folder), set(doc_ids)

    def run(batches):
        for b in batches:
            out = [(d, x.tolist()) for _, _, d, x in frames(b, wanted)]
            yield pa.RecordBatch.from_pydict({"doc_id": pa.array([d for d, _ in out], pa.int64()),
                                              "ids": pa.array([x for _, x in out], pa.list_(pa.int64()))})

    chunks = spark.read.schema(CHUNKS).parquet(f"{folder}/chunks")
    if not wanted:
        return chunks.limit(0).select(F.lit(0).cast("bigint").alias("doc_id"), F.array().cast("array<bigint>").alias("ids"))
    near = F.lit(False)
    for d in sorted(wanted):
        near = near | ((F.col("min_id") <= d) & (F.col("max_id") >= d))
    return (chunks.where(near).select("dict_hash", "item_bytes", "doc_ids", "offsets", "payload")
            .mapInArrow(lean(run), "doc_id bigint, ids array<bigint>"))


def encode_and_read(docs: DataFrame, folder: str, path: str, end_id: int = END_ID) -> DataFrame:
    """``write`` then ``read``. Null and empty texts hold the end id alone; rows without doc_id come
    first; repeated rows are written each; other columns are ignored; an empty table gives an empty
    result."""
    write(docs, folder, path, end_id)
    return read(docs.sparkSession, folder)
