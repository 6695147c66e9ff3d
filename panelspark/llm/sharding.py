"""Balanced contiguous shards (operator 11): DataFrame and SQL functions alone.

Documents stand in one global order (doc_id, null first; equal ids by checksum and size). A shard is
a run of that order. Each range of the order is summed on its own, the ranges' totals get exclusive
prefix sums, and a document's place on the byte line is the sum before its range plus the running sum
inside it. The line is cut at equal targets; a document goes to the shard that holds its middle, so a
shard's bytes miss the target by at most one document.

Only ``doc_id, size, checksum`` and a row tag move, never a text.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from panelspark.llm.common import materialize, release

ROW_BYTES = 16  # counted for every document beside its text
SHARDS = 40
LAW = "bytes"


def text_size(text: Column) -> Column:
    """UTF-8 bytes of a text (null: none) plus ``ROW_BYTES``."""
    return (F.coalesce(F.octet_length(text), F.lit(0)) + F.lit(ROW_BYTES)).cast("bigint")


def text_crc(text: Column) -> Column:
    """Unsigned crc32 of the UTF-8 bytes (null: of no bytes, 0)."""
    return F.crc32(F.coalesce(text, F.lit("")).cast("binary"))


def in_ranges(slim: DataFrame, order: list[str]) -> DataFrame:
    """``slim`` with its range number ``_range``, ascending in ``order``. ``order`` ends in a row tag, so
    that rows of one hot id, and copies of one row, spread over ranges too. Written, for range bounds
    are sampled: every later pass sees the same ranges."""
    n = int(slim.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    keys = [F.col(c).asc_nulls_first() for c in order]
    return materialize(slim.repartitionByRange(n, *keys).withColumn("_range", F.spark_partition_id()), "ranges")


def with_prefix_sums(ranged: DataFrame, order: list[str], size: str) -> DataFrame:
    """Adds ``before`` (sum of ``size`` over all rows before this one), ``position`` (their number) and
    ``total`` (the sum over all rows)."""
    totals = ranged.groupBy("_range").agg(F.sum(size).alias("s"), F.count(F.lit(1)).alias("c"))  # one row a range
    earlier = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.partitionBy(F.lit(1))
    base = totals.select("_range", F.coalesce(F.sum("s").over(earlier), F.lit(0)).alias("_bytes"),
                         F.coalesce(F.sum("c").over(earlier), F.lit(0)).alias("_rows"),
                         F.sum("s").over(everything).alias("total"))
    inside = Window.partitionBy("_range").orderBy(*[F.col(c).asc_nulls_first() for c in order])
    up_to = inside.rowsBetween(Window.unboundedPreceding, 0)
    return (ranged.withColumns({"_sum": F.sum(size).over(up_to), "_at": F.row_number().over(inside)})
            .join(F.broadcast(base), "_range")  # as many rows as ranges
            .withColumns({"before": F.col("_bytes") + F.col("_sum") - F.col(size),
                          "position": (F.col("_rows") + F.col("_at") - 1).cast("bigint")})
            .drop("_range", "_bytes", "_rows", "_sum", "_at"))


def shards(docs: DataFrame, n_shards: int = SHARDS) -> DataFrame:
    """``doc_id, size, text_crc32, law, shard, slot, grown_shard``: one row a document.

    ``shard`` is 0 to n_shards - 1, ``slot`` counts a shard's documents from 0 without gaps in the
    global order, ``law`` is ``bytes`` and ``grown_shard`` null (this law re-cuts the line when a
    shard is added). Null and empty texts have size 16 and checksum 0; rows without doc_id come first;
    repeated rows take a place each (they may fall on both sides of a cut); equal texts aren't kept
    together, as one group may be larger than a shard; a document larger than the target leaves the
    shards it covers without its middle empty; other columns are ignored; an empty table gives an
    empty result. The sum of sizes must stay below 2**63 / (2 n_shards), 115 PB for 40."""
    slim = materialize(docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), text_size(F.col("text")).alias("size"),
                                   text_crc(F.col("text")).alias("text_crc32"))
                       .withColumn("_tag", F.monotonically_increasing_id()), "sizes")
    order = ["doc_id", "text_crc32", "size", "_tag"]
    ranged = in_ranges(slim, order)
    release(slim)
    placed = with_prefix_sums(ranged, order, "size")
    middle = F.expr(f"((2 * before + size) * {n_shards}) div (2 * total)")
    cut = materialize(placed.withColumn("shard", F.least(middle, F.lit(n_shards - 1)).cast("int")).drop("_tag", "before", "total"), "shards")
    release(ranged)
    first = cut.groupBy("shard").agg(F.min("position").alias("_first"))  # at most n_shards rows
    return cut.join(F.broadcast(first), "shard").select(
        "doc_id", "size", "text_crc32", F.lit(LAW).alias("law"), "shard", (F.col("position") - F.col("_first")).alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"))


#: The crc32 table follows from its polynomial; the checksum folds over a text's bytes.
ORACLE = """
WITH steps AS (SELECT i, list_reduce(list_prepend(i, range(8)),
    lambda c, k: CASE WHEN c % 2 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) AS v FROM range(256) g(i)),
tab AS (SELECT list(v ORDER BY i) AS t FROM steps),
hexed AS (SELECT doc_id, CAST(strlen(coalesce(text, '')) + 16 AS BIGINT) AS size, hex(encode(coalesce(text, ''))) AS h FROM documents),
sized AS (SELECT doc_id, size, CAST(xor(list_reduce(list_prepend(4294967295,
    list_transform(regexp_extract_all(h, '..'), lambda x: CAST(concat('0x', x) AS BIGINT))),
    lambda c, x: xor(c >> 8, t[(xor(c, x) & 255) + 1])), 4294967295) AS BIGINT) AS text_crc32 FROM hexed, tab),
line AS (SELECT *, row_number() OVER w AS place, sum(size) OVER (w ROWS UNBOUNDED PRECEDING) - size AS before,
    (SELECT sum(size) FROM sized) AS total FROM sized WINDOW w AS (ORDER BY doc_id NULLS FIRST, text_crc32, size)),
cut AS (SELECT *, CAST(least(39, ((2 * before + size) * 40) // (2 * total)) AS INTEGER) AS shard FROM line)
SELECT doc_id, size, text_crc32, 'bytes' AS law, shard, row_number() OVER (PARTITION BY shard ORDER BY place) - 1 AS slot,
    CAST(NULL AS INTEGER) AS grown_shard FROM cut"""
