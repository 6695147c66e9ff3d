"""Global running sums and row numbers without a single-partition window.

A window with ``orderBy`` and no ``partitionBy`` moves every row into one task. Instead rows are
range-partitioned on the whole order key, written once, and each range is finished by a window of
its own:

1. ``repartitionByRange`` on the composite key splits hot leading values by themselves, since the
   later keys count too;
2. the ranges' totals (one row a range and group) get exclusive prefix sums;
3. inside a range an ordinary window adds what lies before the row.

The table is written between 1 and 2 because range bounds are sampled: reading it back, both passes
see the same ranges.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from panelspark.session import materialize


def _order(levels: list[tuple[str, bool]]) -> list:
    return [F.col(c).desc() if desc else F.col(c).asc() for c, desc in levels]


def _ranged(df: DataFrame, levels: list[tuple[str, bool]]) -> DataFrame:
    """``df`` with its range number ``_rg``, ascending in the order of ``levels``."""
    n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return materialize(df.repartitionByRange(n, *_order(levels)).withColumn("_rg", F.spark_partition_id()))


def running_sums(df: DataFrame, order_col: str, sum_cols: list[str], descending: bool = False,
                 prefix: str = "cum_", by: list[str] | None = None, leads: list[str] | None = None,
                 totals_as: dict[str, str] | None = None) -> DataFrame:
    """Add ``cum_<c>``: sum of ``c`` over rows up to and including this one in key order,
    separately per ``by`` group. ``order_col`` must be unique within a group (aggregate to
    distinct keys first). ``leads`` adds ``next_<c>`` of the row that follows in the group (null after
    the last): the last row of a range gets it from the first row of the next one. ``totals_as`` adds a
    column's sum over the group under the name given."""
    by, leads, totals_as = by or [], leads or [], totals_as or {}
    levels = [(c, False) for c in by] + [(order_col, descending)]
    d = _ranged(df, levels)
    firsts = F.struct(order_col, *leads)  # nulls and NaN compare as they sort
    totals = d.groupBy(*by, "_rg").agg(*[F.sum(c).alias(f"_o_{c}") for c in sum_cols],
                                       (F.max(firsts) if descending else F.min(firsts)).alias("_first"))
    wg = Window.partitionBy(*by).orderBy("_rg")
    wt, wa = wg.rowsBetween(Window.unboundedPreceding, -1), Window.partitionBy(*by)
    offs = totals.select(*by, "_rg", *[F.coalesce(F.sum(f"_o_{c}").over(wt), F.lit(0)).alias(f"_o_{c}") for c in sum_cols],
                         *[F.sum(f"_o_{c}").over(wa).alias(name) for c, name in totals_as.items()],
                         *([F.lead("_first").over(wg).alias("_halo")] if leads else []))
    wr = Window.partitionBy(*by, "_rg").orderBy(*_order(levels[-1:]))
    wi = wr.rowsBetween(Window.unboundedPreceding, 0)
    d = d.join(offs, [*by, "_rg"])
    new = {f"{prefix}{c}": F.col(f"_o_{c}") + F.sum(c).over(wi) for c in sum_cols}
    if leads:
        following = F.coalesce(F.lead(F.struct(*leads)).over(wr), F.struct(*[F.col(f"_halo.{c}") for c in leads]))
        new["_next"] = following
    d = d.withColumns(new)
    if leads:
        d = d.withColumns({f"next_{c}": F.col(f"_next.{c}") for c in leads}).drop("_next", "_halo")
    return d.drop("_rg", *[f"_o_{c}" for c in sum_cols])


def row_numbers(df: DataFrame, levels: list[tuple[str, bool]], out: str = "rn",
                sum_cols: list[str] | None = None) -> DataFrame:
    """Global 1-based row number for the order given by ``levels`` = [(col, descending), ...],
    plus inclusive running sums ``cum_<c>`` of ``sum_cols`` in that order. The levels together
    must make the order total."""
    sum_cols = sum_cols or []
    d = _ranged(df, levels)
    totals = d.groupBy("_rg").agg(F.count(F.lit(1)).alias("_o_n"), *[F.sum(c).alias(f"_o_{c}") for c in sum_cols])
    wt = Window.orderBy("_rg").rowsBetween(Window.unboundedPreceding, -1)  # one row a range
    names = ["n", *sum_cols]
    offs = totals.select("_rg", *[F.coalesce(F.sum(f"_o_{c}").over(wt), F.lit(0)).alias(f"_o_{c}") for c in names])
    w = Window.partitionBy("_rg").orderBy(*_order(levels))
    new = {out: (F.col("_o_n") + F.row_number().over(w)).cast("bigint")}
    for c in sum_cols:
        new[f"cum_{c}"] = F.col(f"_o_{c}") + F.sum(c).over(w.rowsBetween(Window.unboundedPreceding, 0))
    return d.join(offs, "_rg").withColumns(new).drop("_rg", *[f"_o_{c}" for c in names])


def rolling_mean_global(df: DataFrame, rn_col: str, value_col: str, window: int, out: str,
                        block: int = 100_000) -> DataFrame:
    """Trailing mean over ``window`` rows of a global order (rows numbered 1..n in ``rn_col``),
    null until the window is full. Rows are cut into blocks; each block also receives the
    ``window - 1`` rows before it as halo, so a window partitioned by block sees full frames."""
    halo = window - 1
    base = df.withColumn("_blk", F.floor((F.col(rn_col) - 1) / block))
    copy = (base.filter(((F.col(rn_col) - 1) % block) >= block - halo)
            .withColumn("_blk", F.col("_blk") + 1).withColumn("_halo", F.lit(True)))
    u = base.withColumn("_halo", F.lit(False)).unionByName(copy)
    f = Window.partitionBy("_blk").orderBy(rn_col).rowsBetween(-halo, 0)
    m = F.when(F.count(value_col).over(f) >= window, F.avg(value_col).over(f))
    return u.withColumn(out, m).filter(~F.col("_halo")).drop("_blk", "_halo")


def order_statistics_multi(df: DataFrame, cols: list[str], ranks: list[int] | dict) -> dict[str, dict[int, float]]:
    """Values at 0-based ranks of each column's sorted non-null values; ``ranks`` is one list
    for all columns or a dict per column. Values are counted, the counts summed up in value order
    per column, and only the rows whose count interval holds a wanted rank reach the driver."""
    targets = ranks if isinstance(ranks, dict) else {c: list(ranks) for c in cols}
    targets = {c: sorted(set(int(r) for r in t)) for c, t in targets.items() if t}
    out: dict = {c: {} for c in cols}
    if not cols or not targets:
        return out
    vals = _stacked(df, cols).groupBy("_c", "_v").agg(F.count(F.lit(1)).alias("_n"))
    cum = running_sums(vals, "_v", ["_n"], by=["_c"])
    tmap = F.create_map(*[x for c, t in targets.items()
                          for x in (F.lit(c), F.array(*[F.lit(v).cast("bigint") for v in t]))])
    prev = F.col("cum__n") - F.col("_n")
    hits = cum.select("_c", "_v", F.explode(F.filter(F.coalesce(tmap[F.col("_c")], F.array().cast("array<bigint>")),
                                                     lambda r: (r >= prev) & (r < F.col("cum__n")))).alias("_r"))
    for row in hits.collect():
        out[row["_c"]][int(row["_r"])] = float(row["_v"])
    return out


def _stacked(df: DataFrame, cols: list[str]) -> DataFrame:
    """``_c, _v``: one row for each value of each column, without null and NaN."""
    pairs = F.array(*[F.struct(F.lit(c).alias("_c"), F.col(c).cast("double").alias("_v")) for c in cols])
    return df.select(F.explode(pairs).alias("_s")).select("_s._c", "_s._v").filter(F.col("_v").isNotNull() & ~F.isnan("_v"))


def exact_quantiles_multi(df: DataFrame, cols: list[str], probs: list[float]) -> dict[str, list]:
    """Exact linear-interpolated quantiles of many columns (the numpy / DuckDB ``quantile_cont``
    definition) without an aggregate that holds every value in one task. Nulls and NaN are ignored;
    [None, ...] for a column without values."""
    out = {c: [None for _ in probs] for c in cols}
    if not cols:
        return out
    ns = {r["_c"]: r["count"] for r in _stacked(df, cols).groupBy("_c").count().collect()}  # a row a column
    plans = {c: [(int((n - 1) * float(p)), (n - 1) * float(p) - int((n - 1) * float(p))) for p in probs] for c, n in ns.items()}
    stats = order_statistics_multi(df, list(plans), {c: [r for lo, _ in pl for r in (lo, min(lo + 1, ns[c] - 1))] for c, pl in plans.items()})
    for c, plan in plans.items():
        for i, (lo, frac) in enumerate(plan):
            a, b = stats[c][lo], stats[c][min(lo + 1, ns[c] - 1)]
            out[c][i] = a if frac == 0 or a == b else a + (b - a) * frac
    return out


def exact_quantiles_stacked(vals: DataFrame, probs: list[float]) -> dict[str, list[float]]:
    """``exact_quantiles_multi`` of many groups of values: ``vals`` has a group name ``_c`` and a value
    ``_v`` without null and NaN. The wanted ranks, two a group and quantile, are joined."""
    counted = vals.groupBy("_c", "_v").agg(F.count(F.lit(1)).alias("_n"))
    cum = running_sums(counted, "_v", ["_n"], by=["_c"])
    ends = cum.groupBy("_c").agg(F.max("cum__n").alias("_all"))  # a row a group
    place = F.explode(F.array(*[F.struct(F.lit(i).alias("i"), ((F.col("_all") - 1) * F.lit(float(p))).alias("at")) for i, p in enumerate(probs)]))
    want = ends.select("_c", "_all", place.alias("w")).select("_c", "_all", "w.i", "w.at", F.explode(F.array(F.lit(0), F.lit(1))).alias("up"))
    want = want.withColumn("rank", F.least(F.floor("at") + F.col("up"), F.col("_all") - 1))
    prev = F.col("cum__n") - F.col("_n")
    hits = cum.join(F.broadcast(want), "_c").where((F.col("rank") >= prev) & (F.col("rank") < F.col("cum__n")))
    found: dict = {}
    for r in hits.select("_c", "i", "up", "at", "_v").collect():
        found.setdefault(r["_c"], {}).setdefault(r["i"], {})[r["up"]] = (r["at"], float(r["_v"]))
    out = {}
    for c, by in found.items():
        out[c] = []
        for i in range(len(probs)):
            (at, a), (_, b) = by[i][0], by[i][1]
            out[c].append(a if at == int(at) or a == b else a + (b - a) * (at - int(at)))
    return out
