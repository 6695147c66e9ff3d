"""Byte-level text tools for Arrow batches: words, hashes and shingles as numpy arrays.

A batch's text column is one UTF-8 buffer plus offsets; everything here works on slices of it, so
no Python string is made per word. Slices are bounded (``max_bytes``, or one longer document).
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash

U64 = np.uint64
SEGMENT = 1 << 18  # bytes hashed at once
LONG_WORD = 4096  # longer words are hashed one by one

_SPACES = [0x20, *range(0x09, 0x0E)]
NOT_SPACE = np.ones(256, dtype=bool)
NOT_SPACE[_SPACES] = False
#: [^\x00-\x2F\x3A-\x60\x7B-\x7F] on bytes: digits, a-z and every byte of a non-ASCII character.
TERM = np.zeros(256, dtype=bool)
TERM[0x30:0x3A] = TERM[0x61:0x7B] = TERM[0x80:] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 32


def slices(batch: pa.RecordBatch, column: str = "text", max_bytes: int = 1 << 21):
    """Yield ``(lo, hi, buf, offsets)``: rows lo..hi of the batch, their bytes and offsets."""
    col = batch.column(batch.schema.get_field_index(column))
    if col.null_count:
        col = col.fill_null("")
    n = len(col)
    if not n:
        return
    wide = pa.types.is_large_string(col.type) or pa.types.is_large_binary(col.type)
    _, off, data = col.buffers()
    off = np.frombuffer(off, np.int64 if wide else np.int32)[col.offset : col.offset + n + 1].astype(np.int64)
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    lo = 0
    while lo < n:
        hi = max(lo + 1, int(np.searchsorted(off, off[lo] + max_bytes, side="right")) - 1)
        yield lo, hi, data[off[lo] : off[hi]], off[lo : hi + 1] - off[lo]
        lo = hi


def mix(h: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: spreads every input bit over the whole word."""
    h = (h ^ (h >> U64(30))) * U64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> U64(27))) * U64(0x94D049BB133111EB)
    return h ^ (h >> U64(31))


def words(buf: np.ndarray, offsets: np.ndarray, table: np.ndarray = NOT_SPACE):
    """Starts and ends of all words, and the first word of each document (length docs + 1)."""
    inside = table[buf]
    begins, finishes = inside.copy(), inside.copy()
    if len(buf):
        begins[1:] &= ~inside[:-1]
        finishes[:-1] &= ~inside[1:]
        cut = offsets[(offsets > 0) & (offsets < len(buf))]
        begins[cut] = inside[cut]
        finishes[cut - 1] = inside[cut - 1]
    starts = np.flatnonzero(begins)
    return starts, np.flatnonzero(finishes) + 1, np.searchsorted(starts, offsets)


_POWERS: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def _powers(seed: int):
    if seed not in _POWERS:
        base = (0x9E3779B97F4A7C15 * (2 * seed + 1) + 2 * seed) % 2**64 | 1
        n = SEGMENT + LONG_WORD + 1
        tables = []
        for b in (base, pow(base, -1, 2**64)):
            steps = np.full(n + 1, b, dtype=U64)
            steps[0] = 1
            tables.append(np.cumprod(steps, dtype=U64))
        _POWERS[seed] = tuple(tables)
    return _POWERS[seed]


def span_hashes(buf: np.ndarray, starts: np.ndarray, ends: np.ndarray, seed: int = 0) -> np.ndarray:
    """64-bit hash of each byte span (spans in order of start, each hashed whole). A span's hash
    depends on its bytes alone; spans over ``LONG_WORD`` bytes are hashed with xxh64."""
    out = np.empty(len(starts), dtype=U64)
    if not len(starts):
        return out
    power, inverse = _powers(seed)
    size = ends - starts
    long = size > LONG_WORD
    for i in np.flatnonzero(long):
        out[i] = xxhash.xxh64_intdigest(buf[starts[i] : ends[i]].tobytes(), seed=seed)
    todo = np.flatnonzero(~long)
    s, e = starts[todo], ends[todo]
    a = 0
    while a < len(s):
        base = s[a]
        b = int(np.searchsorted(s, base + SEGMENT))
        top = int(e[a:b].max()) - base
        sums = np.empty(top + 1, dtype=U64)
        sums[0] = 0
        np.cumsum((buf[base : base + top].astype(U64) + U64(1)) * power[:top], out=sums[1:])
        out[todo[a:b]] = (sums[e[a:b] - base] - sums[s[a:b] - base]) * inverse[s[a:b] - base]
        a = b
    return mix(out ^ (size.astype(U64) * U64(0xD6E8FEB86659FD93)))


def windows(h: np.ndarray, k: int) -> np.ndarray:
    """Hash of each run of k consecutive word hashes (length n - k + 1)."""
    mult = 0xC2B2AE3D27D4EB4F
    n = len(h) - k + 1
    if n <= 0:
        return np.zeros(0, dtype=U64)
    out, have, part, width = np.zeros(n, dtype=U64), 0, h, 1
    while True:  # k in binary: runs of 1, 2, 4, .. words, each made of two halves
        if k & width:
            out += part[have : have + n] * U64(pow(mult, have, 2**64))
            have += width
        if 2 * width > k:
            return mix(out)
        part = part[: len(part) - width] + part[width:] * U64(pow(mult, width, 2**64))
        width *= 2


def sliding_min(v: np.ndarray, width: int) -> np.ndarray:
    """Minimum of each run of ``width`` values (length n - width + 1)."""
    have = 1
    while 2 * have <= width:
        v = np.minimum(v[:-have], v[have:]) if len(v) > have else v[:0]
        have *= 2
    rest = width - have
    return np.minimum(v[:-rest], v[rest:]) if rest and len(v) > rest else v[: 0 if rest else None]


def ranges(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """start_0, start_0 + 1, .. of every range, one after another."""
    lengths = lengths.astype(np.int64)
    if not lengths.sum():
        return np.zeros(0, dtype=np.int64)
    keep = lengths > 0
    starts, lengths = starts[keep].astype(np.int64), lengths[keep]
    step = np.ones(lengths.sum(), dtype=np.int64)
    first = np.cumsum(lengths)[:-1]
    step[0] = starts[0]
    step[first] = starts[1:] - starts[:-1] - lengths[:-1] + 1
    return np.cumsum(step)


def squeeze(buf: np.ndarray, offsets: np.ndarray):
    """Words joined by one space, documents by one line feed.

    Returns the new bytes, word starts and ends in them, and each document's first word."""
    s, e, first = words(buf, offsets)
    size = e - s
    starts = np.cumsum(size + 1) - size - 1
    out = np.full(int(size.sum()) + len(s), 0x20, dtype=np.uint8)
    out[ranges(starts, size)] = buf[NOT_SPACE[buf]]
    last = first[1:][first[1:] > first[:-1]] - 1
    out[starts[last] + size[last]] = 0x0A
    return out, starts, starts + size, first
