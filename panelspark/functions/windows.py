"""Window helpers with pandas null semantics.

All per-ticker windows are built from one ``Window.partitionBy(key).orderBy(order)`` spec so
Catalyst places every Window node behind a single ``Exchange hashpartitioning(ticker)``.
After dedupe a ticker holds at most one row per calendar day, so a window partition is
bounded by the calendar, not by the data volume; the data grows in the number of tickers,
which spreads over partitions.

Window functions cannot nest, so helpers that need a derived input (pct_change needs the
padded value first) add it as a column in an earlier stage.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

KEY = "ticker"
ORDER = "Date"


def by_key(key: str = KEY, order: str | list = ORDER) -> WindowSpec:
    orders = [order] if isinstance(order, str) else list(order)
    return Window.partitionBy(key).orderBy(*orders)


def trailing(w: WindowSpec, n: int) -> WindowSpec:
    """Frame of the current row and the n-1 rows before it (row-based, R8)."""
    return w.rowsBetween(-(n - 1), 0)


def running(w: WindowSpec) -> WindowSpec:
    return w.rowsBetween(Window.unboundedPreceding, 0)


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def roll_mean(c, w: WindowSpec, n: int, min_periods: int | None = None) -> Column:
    """pandas ``rolling(n, min_periods).mean()``: null until min_periods non-null values."""
    f = trailing(w, n)
    mp = n if min_periods is None else min_periods
    return F.when(F.count(_c(c)).over(f) >= mp, F.avg(_c(c)).over(f))


def roll_std(c, w: WindowSpec, n: int, min_periods: int | None = None) -> Column:
    """Sample standard deviation (ddof=1, R6) over a trailing frame."""
    f = trailing(w, n)
    mp = n if min_periods is None else min_periods
    return F.when(F.count(_c(c)).over(f) >= mp, F.stddev_samp(_c(c)).over(f))


def roll_median(c, w: WindowSpec, n: int, min_periods: int | None = None) -> Column:
    """Interpolated median over a trailing frame (``percentile`` accepts a frame)."""
    f = trailing(w, n)
    mp = n if min_periods is None else min_periods
    return F.when(F.count(_c(c)).over(f) >= mp, F.percentile(_c(c), F.lit(0.5)).over(f))


def padded(c, w: WindowSpec) -> Column:
    """Forward fill (last non-null so far), the padding pandas applies in pct_change."""
    return F.last(_c(c), ignorenulls=True).over(running(w))


def ratio_change(padded_col, w: WindowSpec) -> Column:
    """pct_change on an already padded column: x_t / x_{t-1} - 1, null when undefined."""
    pc = _c(padded_col)
    return F.try_divide(pc, F.lag(pc, 1).over(w)) - F.lit(1.0)


def flag(cond: Column) -> Column:
    """Boolean mask with pandas comparison semantics (R2): null comparisons are false."""
    return F.coalesce(cond, F.lit(False))


def flag_int(cond: Column) -> Column:
    return flag(cond).cast("int")


def safe_div(num: Column, den: Column) -> Column:
    """Division with the reference's ``replace(0, nan)`` guard: null for a zero denominator."""
    return F.try_divide(num, F.nullif(den, F.lit(0.0)))


def clip(c: Column, lo: float, hi: float) -> Column:
    """pandas clip: keeps nulls (greatest/least would skip them)."""
    return F.when(c.isNull(), F.lit(None)).otherwise(F.least(F.greatest(c, F.lit(lo)), F.lit(hi)))


# ---------------------------------------------------------------------------
# Recursive EMA (pandas ewm(span, adjust=False).mean()) as blocked window sums.
# ---------------------------------------------------------------------------

EMA_BLOCK = 40.0  # decay (in nats) that one block spans; what is older than a block weighs below e**-40


def add_ewm(df: DataFrame, items, key: str = KEY, order: str = ORDER, block: float | None = None, then=None) -> DataFrame:
    """EMA columns for ``items`` = [(source_col, out_col, span), ...], optionally followed by a
    ``then`` chain: (derived_col, Column-builder, [(src, out, span)]) steps that compute a column
    from earlier outputs and smooth it (MACD -> signal). Null sources follow the reference's gap
    rule: the average stays, and its weight decays by every row of the gap."""
    out = _add_ewm(df, items, key, order, block)
    for col, build, more in then or []:
        out = _add_ewm(out.withColumn(col, build()), more, key, order, block)
    return out


def _add_ewm(df: DataFrame, items, key: str, order: str, block: float | None) -> DataFrame:
    """Between values g rows apart the recurrence is y = A y_before + B x with
    A = q^g / (q^g + a), B = a / (q^g + a), q = 1 - a (g = 1: A = q, B = a); the first value is y.

    With the running decay D = sum(-ln A), y = e^-D sum(B x e^D). Rows are cut into blocks by
    D div ``block``, and inside a block S is that sum with D from the block's first row on, so no
    exponent exceeds ``block``. What a block inherits is the last S of the block before it, decayed;
    older blocks lie more than ``block`` nats back, far below double precision. All of it are window
    functions over the ticker partitioning ((ticker, block) windows need no new exchange)."""
    width = EMA_BLOCK if block is None else float(block)
    w = by_key(key, order)
    before = w.rowsBetween(Window.unboundedPreceding, -1)
    run = running(w)
    out = df.withColumn("_ewm_t", F.row_number().over(w))
    srcs = list(dict.fromkeys(src for src, _, _ in items))
    for n, src in enumerate(srcs):  # rows since the last value; null: this is the first
        gap = F.col("_ewm_t") - F.last(F.when(F.col(src).isNotNull(), F.col("_ewm_t")), ignorenulls=True).over(before)
        out = out.withColumn(f"_ewm_g{n}", F.when(F.col(src).isNotNull(), gap))
    decay, place, edge, sums, carry, final = ({} for _ in range(6))
    for i, (src, dst, span) in enumerate(items):
        a = 2.0 / (span + 1.0)
        has, g = F.col(src).isNotNull(), F.col(f"_ewm_g{srcs.index(src)}")
        kept = F.exp(g * F.lit(math.log(1.0 - a)))
        inner = Window.partitionBy(key, f"_ewm_b{i}").orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
        # -ln(A) = g (-ln q) + ln(q^g + a): counted in rows, which is exact, and in the logarithms of
        # gaps alone (without a gap q + a = 1)
        per_row, gap_log = F.lit(-math.log(1.0 - a)), F.col(f"_ewm_c{i}")
        rows = F.coalesce(g, F.lit(0))
        decay[f"_ewm_c{i}"] = F.when(g > 1, F.log(kept + F.lit(a))).otherwise(F.lit(0.0))
        decay[f"_ewm_x{i}"] = F.when(has, F.when(g.isNull(), F.col(src)).when(g == 1, F.col(src) * F.lit(a))
                                     .otherwise(F.col(src) * F.lit(a) / (kept + F.lit(a))))
        place[f"_ewm_b{i}"] = F.floor((F.sum(rows).over(run) * per_row + F.sum(gap_log).over(run)) / F.lit(width))
        # decay since the block's first row
        edge[f"_ewm_f{i}"] = F.first(rows).over(inner) * per_row + F.first(gap_log).over(inner)
        edge[f"_ewm_r{i}"] = (F.sum(rows).over(inner) - F.first(rows).over(inner)) * per_row + F.sum(gap_log).over(inner) - F.first(gap_log).over(inner)
        rise, s, b = F.col(f"_ewm_r{i}"), F.col(f"_ewm_s{i}"), F.col(f"_ewm_b{i}")
        sums[f"_ewm_s{i}"] = F.exp(-rise) * F.sum(F.col(f"_ewm_x{i}") * F.exp(rise)).over(inner)
        carry[f"_ewm_h{i}"] = F.when(F.lag(b).over(w) != b, F.lag(s).over(w))
        held = F.first(f"_ewm_h{i}").over(inner) * F.exp(-(rise + F.col(f"_ewm_f{i}")))
        final[dst] = F.when(F.count(src).over(run) > 0, F.coalesce(s, F.lit(0.0)) + F.coalesce(held, F.lit(0.0)))
    steps = (decay, place, edge, sums, carry, final)
    for step in steps:
        out = out.withColumns(step)
    made = [c for step in steps[:-1] for c in step]
    return out.drop("_ewm_t", *made, *[f"_ewm_g{n}" for n in range(len(srcs))])
