"""URL filter over a sorted digest array (operator 8).

Each rule ``host/path-prefix`` is one 64-bit xxhash key; the keys are sorted into files that
executors memory-map, with the full strings beside them. A url is judged by the keys of all its
(host suffix, path prefix) pairs whose prefix length some rule has: one vectorised binary search a
batch, then each hit is confirmed against the stored string, so a collision never decides.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import SparkFiles
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from panelspark.llm.common import ids, lean
from panelspark.session import scratch_path

#: (verdict, rule) as the contract gives them.
RULES = [("allow", "com/"), ("block", "example.com/en/"), ("allow", "www.example.com/en/"),
         ("block", "net/es/"), ("block", "net/fr/")]
DEFAULT = "allow"  # no key of the url is in the array
SEGMENT_RULES = 4_000_000  # rules in one file; more rules make more files, probed in turn


def url_parts(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path; both empty without ``://`` or for null."""
    pattern = r"(?s)^.*?://([^/?#]*)([^?#]*)"
    part = lambda k: F.coalesce(F.regexp_extract(url, pattern, k), F.lit(""))
    return F.translate(part(1), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"), part(2)


def _key(s: str) -> int:
    return xxhash.xxh64_intdigest(s.encode())


def pack(rules: list[tuple[str, str]], key=_key) -> bytes:
    """One segment: count, sorted keys, string offsets, verdict flags, strings. ``key`` is there
    so that tests can force collisions."""
    rows = sorted((key(r), r, v == "block") for v, r in rules)
    text = [r.encode() for _, r, _ in rows]
    off = np.cumsum([0, *map(len, text)]).astype("<i8")
    return b"".join([np.array([len(rows)], "<i8").tobytes(), np.array([k for k, _, _ in rows], "<u8").tobytes(),
                     off.tobytes(), np.array([b for *_, b in rows], "u1").tobytes(), *text])


def unpack(path: str):
    """Memory-mapped (keys, offsets, block flags, strings) of a segment."""
    raw = np.memmap(path, dtype=np.uint8, mode="r")
    n = int(raw[:8].view("<i8")[0])
    a, b = 8 + 8 * n, 8 + 8 * n + 8 * (n + 1)
    return raw[8:a].view("<u8"), raw[a:b].view("<i8"), raw[b : b + n], raw[b + n :]


def lookup(segment, strings: list[str], key=_key) -> np.ndarray:
    """Row of each string in the segment, -1 where it is not stored."""
    keys, off, _, blob = segment
    found = np.full(len(strings), -1, dtype=np.int64)
    if not len(keys) or not strings:
        return found
    probe = np.fromiter((key(s) for s in strings), dtype=np.uint64, count=len(strings))
    lo, hi = np.searchsorted(keys, probe, "left"), np.searchsorted(keys, probe, "right")
    for i in np.flatnonzero(hi > lo):
        want = strings[i].encode()
        for j in range(lo[i], hi[i]):  # equal keys: compare the strings
            if blob[off[j] : off[j + 1]].tobytes() == want:
                found[i] = j
                break
    return found


def _publish(spark: SparkSession, data: bytes) -> str:
    """Put a segment into the shared folder and let executors fetch it as a Spark file."""
    name = f"rules-{hashlib.sha256(data).hexdigest()[:24]}.bin"
    target = spark._jvm.org.apache.hadoop.fs.Path(scratch_path(spark, name))
    fs = target.getFileSystem(spark._jsc.hadoopConfiguration())
    if not fs.exists(target):
        out = fs.create(target)
        out.write(bytearray(data))
        out.close()
    spark.sparkContext.addFile(target.toString())
    return name


def checked(rules: list[tuple[str, str]]) -> list[tuple[str, str]]:
    """Distinct rules; each needs a host, a path that starts with ``/``, and one verdict."""
    seen: dict[str, str] = {}
    for verdict, rule in rules:
        if verdict not in ("allow", "block") or rule.find("/") < 1:
            raise ValueError(f"bad rule {verdict} {rule!r}")
        if seen.setdefault(rule, verdict) != verdict:
            raise ValueError(f"rule {rule!r} has two verdicts")
    return [(v, r) for r, v in seen.items()]


def judge(pages: DataFrame, rules: list[tuple[str, str]] = RULES, default: str = DEFAULT,
          segment_rules: int = SEGMENT_RULES) -> DataFrame:
    """``page_id, host, path, rule, verdict`` of every page.

    A rule fits its host and all subdomains if the path starts with the rule's; the longest rule
    wins (the longer host among equally long ones); without one the verdict is ``default`` and
    the rule null. Null urls and urls without ``://`` have empty host and path. Repeated rows are
    judged one by one, an empty table gives an empty result, other columns are ignored.
    One map over the pages, no shuffle; only ``url`` and ``page_id`` are read.
    """
    spark, rules = pages.sparkSession, checked(rules)
    names = [_publish(spark, pack(rules[i : i + segment_rules])) for i in range(0, len(rules), segment_rules)]
    lengths = sorted({len(r) - r.index("/") for _, r in rules}, reverse=True)

    def run(batches):
        segments = [unpack(SparkFiles.get(n)) for n in names]
        for b in batches:
            hosts, paths = ids(b, "host").to_pylist(), ids(b, "path").to_pylist()
            probes, owner = [], []
            for i, (host, path) in enumerate(zip(hosts, paths)):
                at = 0
                while host and at >= 0:
                    tail = host[at:]
                    for k in lengths:
                        if k <= len(path):
                            probes.append(tail + path[:k])
                            owner.append(i)
                    dot = host.find(".", at)
                    at = dot + 1 if dot >= 0 else -1
            best: list = [None] * len(hosts)
            for seg in segments:
                row = lookup(seg, probes)
                for j in np.flatnonzero(row >= 0):
                    p = probes[j]
                    rank = (len(p), p.index("/"), p, bool(seg[2][row[j]]))
                    if best[owner[j]] is None or rank > best[owner[j]]:
                        best[owner[j]] = rank
            yield pa.RecordBatch.from_arrays([
                ids(b, "page_id"), ids(b, "host"), ids(b, "path"),
                pa.array([x and x[2] for x in best], pa.string()),
                pa.array([default if x is None else "block" if x[3] else "allow" for x in best], pa.string()),
            ], names=["page_id", "host", "path", "rule", "verdict"])

    host, path = url_parts(F.col("url"))
    return pages.select("page_id", host.alias("host"), path.alias("path")).mapInArrow(
        lean(run), "page_id bigint, host string, path string, rule string, verdict string")


def oracle(rules=RULES, default: str = DEFAULT) -> str:
    values = ", ".join(f"('{v}', '{r[:r.index('/')]}', '{r[r.index('/'):]}')" for v, r in rules)
    pattern = r"(?s)^.*?://([^/?#]*)([^?#]*)"
    part = lambda k: f"coalesce(regexp_extract(url, '{pattern}', {k}), '')"
    return f"""
with p as (select row_number() over () as n, page_id,
      translate({part(1)}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as host, {part(2)} as path from pages),
r(verdict, rhost, rpath) as (values {values}),
hit as (select n, arg_max(row(r.rhost || r.rpath, r.verdict), length(r.rhost || r.rpath) * 10000 + length(r.rhost)) as best
      from p join r on (p.host = r.rhost or ends_with(p.host, '.' || r.rhost)) and starts_with(p.path, r.rpath) group by n)
select page_id, host, path, best[1] as rule, coalesce(best[2], '{default}') as verdict from p left join hit using (n)"""
