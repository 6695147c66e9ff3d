"""Splits, purge, calendar blocks and walk-forward folds (K1-K9), pooled panels.

A fold is not a copy of rows: after purging it is fully described by inclusive date bounds
per ticker, ``fold_bounds(ticker, fold, train_lo, train_hi, val_lo, val_hi, n_train, n_val)``.
Bounds are computed with windows on the ticker partitioning only:

* rows are numbered per ticker (dates are unique after dedupe);
* block edges and train cut-offs are unioned into the row stream as marker rows, and a
  running count gives "rows before this marker" without a range join (a range join of rows
  to cut-offs would pair every row with every block);
* val bounds come from a per-(ticker, block) aggregate of the rows.

Later uses (pooled pairs, in-sample set) are equi-joins on ticker with a between predicate
against the small bounds table.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from panelspark.functions.windows import KEY, ORDER, by_key
from panelspark.session import materialize

NON_FEATURE_COLS = ("Target", "Open", "High", "Low", "Close", "Volume")


def ts_lit(s: str) -> Column:
    return F.lit(s).cast("timestamp_ntz")


# ------------------------------------------------------------------ K1-K5

def split2(df: DataFrame, train_cutoff: str, order: str = ORDER) -> DataFrame:
    """K1: ``split`` = train for Date < cutoff, else test (null dates land in test, D13)."""
    is_train = F.coalesce(F.col(order) < ts_lit(train_cutoff), F.lit(False))
    return df.withColumn("split", F.when(is_train, "train").otherwise("test"))


def split3(df: DataFrame, train_cutoff: str, validate_cutoff: str, order: str = ORDER) -> DataFrame:
    """K2: train / validate / test on two cut-offs, half-open; null dates fall in no split."""
    d = F.col(order)
    return df.withColumn("split", F.when(d < ts_lit(train_cutoff), "train")
                         .when(d < ts_lit(validate_cutoff), "validate")
                         .when(d >= ts_lit(validate_cutoff), "test"))


def xy_projection(df: DataFrame, y_col: str = "Target", non_feature_cols=NON_FEATURE_COLS) -> DataFrame:
    """K3: X columns (everything but the label and OHLCV) plus the label."""
    keep = [c for c in df.columns if c not in non_feature_cols]
    return df.select(*keep, y_col)


def purge_tail(df: DataFrame, horizon: int, key: str = KEY, order: str = ORDER) -> DataFrame:
    """K4: drop each ticker's last ``horizon`` rows (everything when it has <= horizon rows)."""
    if horizon <= 0:
        return df
    w = Window.partitionBy(key).orderBy(F.col(order).desc())
    return df.withColumn("_rk", F.row_number().over(w)).filter(F.col("_rk") > horizon).drop("_rk")


# ------------------------------------------------------------------ K6

_FREQ = re.compile(r"^(\d*)\s*([A-Za-z]+)$")


def _edges(start: Column, end: Column, fold_len: str) -> Column:
    """Array of block edges over [start, end], like ``pandas.date_range`` plus the fixes of the
    reference: start prefixed when it is not an edge, end appended when beyond the last edge."""
    m = _FREQ.match(fold_len.strip())
    if not m:
        raise ValueError(f"unsupported fold_len {fold_len!r}")
    n = int(m.group(1) or 1)
    unit = m.group(2).upper()
    if unit == "D":
        raw = F.sequence(start, end, F.make_dt_interval(F.lit(n)))
    elif unit in ("Q", "QE", "Y", "YE", "A", "M", "ME"):
        step = {"Q": 3, "QE": 3, "Y": 12, "YE": 12, "A": 12, "M": 1, "ME": 1}[unit] * n
        months = F.sequence(F.trunc(F.to_date(start), "MM"), F.to_date(end), F.expr("INTERVAL 1 MONTH"))
        ends = F.transform(months, lambda d: F.last_day(d).cast("timestamp_ntz"))
        if step % 12 == 0:
            keep = lambda d: F.month(d) == 12
        elif step % 3 == 0:
            keep = lambda d: F.month(d) % 3 == 0
        else:
            keep = lambda d: F.lit(True)
        anchored = F.filter(ends, lambda d: keep(d) & (d >= start) & (d <= end))
        if step not in (1, 3, 12):
            anchored = F.filter(anchored, lambda d, i: i % F.lit(step // (12 if step % 12 == 0 else 3 if step % 3 == 0 else 1)) == 0)
        raw = anchored
    else:
        raise ValueError(f"unsupported fold_len {fold_len!r}")
    with_start = F.when((F.size(raw) > 0) & (F.element_at(raw, 1) == start), raw).otherwise(
        F.concat(F.array(start), raw))
    return F.when(F.element_at(with_start, -1) < end,
                  F.concat(with_start, F.array(end))).otherwise(with_start)


def calendar_blocks(ranges: DataFrame, fold_len: str = "365D", key: str = KEY) -> DataFrame:
    """K6: per ticker half-open blocks (k, vs, ve) over [start, end); none if start >= end."""
    e = _edges(F.col("start"), F.col("end"), fold_len)
    ex = ranges.filter(F.col("start") < F.col("end")).select(key, F.posexplode(e).alias("k", "vs"))
    w = Window.partitionBy(key).orderBy("k")
    return (ex.withColumn("ve", F.lead("vs").over(w)).filter(F.col("ve").isNotNull())
            .select(key, F.col("k").cast("int").alias("k"), "vs", "ve"))


# ------------------------------------------------------------------ K7-K9

def insample_test(df: DataFrame, validate_cutoff: str, horizon: int, key: str = KEY,
                  order: str = ORDER) -> tuple[DataFrame, DataFrame]:
    """Final-test split at ``validate_cutoff``, each side purged by K4."""
    cut = ts_lit(validate_cutoff)
    ins = purge_tail(df.filter(F.col(order) < cut), horizon, key, order)
    test = purge_tail(df.filter(F.col(order) >= cut), horizon, key, order)
    return ins, test


def _marker_counts(rows: DataFrame, markers: DataFrame, key: str, order: str,
                   lag_h: int) -> DataFrame:
    """For each marker (key, order=cut, k, tag): rows strictly before the cut, and the date of
    the row ``lag_h`` positions before the last such row (null when there is none)."""
    w_rows = by_key(key, order)
    r = rows.select(key, order).withColumns({
        "_is_row": F.lit(1),
        "_back": F.lag(order, lag_h).over(w_rows) if lag_h > 0 else F.col(order),
        "k": F.lit(None).cast("int"), "tag": F.lit(None).cast("string")})
    m = markers.select(key, order, "k", "tag").withColumns({
        "_is_row": F.lit(0), "_back": F.lit(None).cast("timestamp_ntz")})
    u = r.unionByName(m)
    # Markers sort before rows stamped at the same instant: counts are strictly "before".
    w = Window.partitionBy(key).orderBy(order, "_is_row").rowsBetween(Window.unboundedPreceding, 0)
    u = u.withColumns({"_cnt": F.sum("_is_row").over(w),
                       "_back_last": F.last("_back", ignorenulls=True).over(w)})
    return (u.filter(F.col("_is_row") == 0)
            .select(key, "k", "tag", F.col("_cnt").alias("n_before"), F.col("_back_last").alias("back_date")))


def fold_bounds(df: DataFrame, validate_cutoff: str, horizon: int = 5, embargo_days: int | None = None,
                fold_len: str = "365D", fold_mode: str = "expanding", sliding_train_years: int | None = None,
                min_train: int = 50, min_val: int = 5, key: str = KEY, order: str = ORDER,
                align: str = "ordinal") -> DataFrame:
    """K7: walk-forward folds per ticker, as inclusive date bounds after purge and embargo.

    ``align="ordinal"`` (the reference): blocks start at each ticker's own first in-sample
    date, so fold k may cover different dates per ticker. ``align="calendar"``: every ticker
    uses the same edges over the global in-sample range, so fold k is one calendar window."""
    emb = horizon if embargo_days is None else int(embargo_days)
    ins, _ = insample_test(df, validate_cutoff, horizon, key, order)
    # The purged in-sample keys feed four branches (ranges, block stream, train markers,
    # row numbers); written once so the panel's window stack is not recomputed per branch.
    ins = ins.select(key, order).transform(materialize)
    ranges = ins.groupBy(key).agg(F.min(order).alias("start"), F.max(order).alias("end"))
    if align == "calendar":
        g_start = ranges.select(F.min("start")).scalar()
        g_end = ranges.select(F.max("end")).scalar()
        block_ranges = ranges.select(key, g_start.alias("start"), g_end.alias("end"))
    elif align == "ordinal":
        block_ranges = ranges
    else:
        raise ValueError("align must be 'ordinal' or 'calendar'")
    blocks = calendar_blocks(block_ranges, fold_len, key)

    # Validation rows: the rows of each block, last `horizon` of them purged.
    edge_marks = blocks.select(key, F.col("vs").alias(order), "k", F.lit("vs").alias("tag"))
    end_marks = block_ranges.select(key, F.col("end").alias(order), F.lit(None).cast("int").alias("k"),
                              F.lit("end").alias("tag"))
    w_rows = by_key(key, order)
    stream = (ins.withColumns({"_is_row": F.lit(1), "k": F.lit(None).cast("int"), "tag": F.lit(None).cast("string")})
              .unionByName(edge_marks.unionByName(end_marks).withColumn("_is_row", F.lit(0))))
    wrun = Window.partitionBy(key).orderBy(order, "_is_row").rowsBetween(Window.unboundedPreceding, 0)
    stream = stream.withColumn("_blk", F.last(F.when(F.col("tag") == "vs", F.col("k"))
                                              .when(F.col("tag") == "end", F.lit(-1)), ignorenulls=True).over(wrun))
    val_rows = stream.filter((F.col("_is_row") == 1) & (F.col("_blk") >= 0)).select(key, order, F.col("_blk").alias("k"))
    wb = Window.partitionBy(key, "k").orderBy(order)
    val_rows = val_rows.withColumns({"_rb": F.row_number().over(wb),
                                     "_vc": F.count(F.lit(1)).over(Window.partitionBy(key, "k"))})
    val = (val_rows.filter(F.col("_rb") <= F.col("_vc") - horizon)
           .groupBy(key, "k").agg(F.min(order).alias("val_lo"), F.max(order).alias("val_hi"),
                                  F.count(F.lit(1)).alias("n_val")))

    # Train rows: ins rows before vs - embargo (and from train_end - years when sliding),
    # last `horizon` purged.
    train_end = F.col("vs") - F.make_dt_interval(F.lit(emb))
    marks = blocks.select(key, train_end.alias(order), "k", F.lit("end").alias("tag"))
    if fold_mode == "sliding":
        if not sliding_train_years:
            raise ValueError("sliding mode needs sliding_train_years")
        start_m = blocks.select(key, (train_end - F.make_ym_interval(F.lit(int(sliding_train_years)), F.lit(0))).alias(order),
                                "k", F.lit("start").alias("tag"))
        marks = marks.unionByName(start_m)
    elif fold_mode != "expanding":
        raise ValueError(f"unknown fold mode {fold_mode!r}")
    mc = _marker_counts(ins, marks, key, order, horizon)
    te = mc.filter(F.col("tag") == "end").select(key, "k", F.col("n_before").alias("c_end"),
                                                 F.col("back_date").alias("train_hi"))
    numbered = ins.withColumn("_rn", F.row_number().over(w_rows))
    if fold_mode == "sliding":
        ts = mc.filter(F.col("tag") == "start").select(key, "k", F.col("n_before").alias("c_start"))
        tr = te.join(ts, [key, "k"])
        lo = numbered.select(key, F.col("_rn").alias("_lo_rn"), F.col(order).alias("train_lo"))
        tr = (tr.withColumn("_lo_rn", F.col("c_start") + 1)
              .join(lo, [key, "_lo_rn"], "left").drop("_lo_rn"))
    else:
        first = ranges.select(key, F.col("start").alias("train_lo"))
        tr = te.withColumn("c_start", F.lit(0).cast("bigint")).join(first, key)
    tr = tr.withColumn("n_train", F.col("c_end") - F.col("c_start") - F.lit(horizon))

    folds = (val.join(tr, [key, "k"])
             .filter((F.col("n_val") >= min_val) & (F.col("n_train") >= min_train)))
    wf = Window.partitionBy(key).orderBy("k")
    return folds.select(key, (F.row_number().over(wf) - 1).cast("int").alias("fold"),
                        "train_lo", "train_hi", "val_lo", "val_hi",
                        F.col("n_train").cast("bigint").alias("n_train"),
                        F.col("n_val").cast("bigint").alias("n_val"))


def trim_folds(bounds: DataFrame, key: str = KEY) -> DataFrame:
    """K9: keep tickers with folds, cut every ticker to the smallest fold count.

    The minimum is a scalar subquery evaluated by Spark (no driver round trip)."""
    per = bounds.groupBy(key).agg(F.count(F.lit(1)).alias("_nf"))
    min_folds = per.select(F.min("_nf")).scalar()
    return bounds.filter(F.col("fold") < min_folds)


def require_folds(bounds: DataFrame) -> DataFrame:
    """K9: ``bounds``, or an error when no ticker yields a fold (one short job)."""
    if bounds.isEmpty():
        raise RuntimeError("not one ticker has rows enough for a fold")
    return bounds


def skipped_tickers(df: DataFrame, bounds: DataFrame, key: str = KEY) -> DataFrame:
    """Tickers of the panel that produced no fold (reported, not silently lost)."""
    return df.select(key).distinct().join(bounds.select(key).distinct(), key, "left_anti")


# ------------------------------------------------------------------ G1-G5

def feature_columns(df: DataFrame, exclude=("__ticker__", "Date", "Target", "fold", "role")) -> list[str]:
    """Numeric model inputs = every column but the helper columns."""
    return [c for c in df.columns if c not in exclude]


def frame_with_target(df: DataFrame, key: str = KEY) -> DataFrame:
    """Features, Target, and the ticker as ``__ticker__`` (Date is already a column)."""
    return xy_projection(df).withColumnRenamed(key, "__ticker__")


def dropna_features(df: DataFrame, exclude=("__ticker__", "Date")) -> DataFrame:
    """Drop rows with a null in any feature column (the label is not checked)."""
    feats = [c for c in df.columns if c not in exclude and c not in ("Target", "fold", "role")]
    return df.na.drop("any", subset=feats) if feats else df


def global_fold_pairs(panel: DataFrame, bounds: DataFrame, dropna: bool = True, key: str = KEY,
                      order: str = ORDER) -> DataFrame:
    """G1: every fold's train and val rows of all tickers, tagged with ``fold`` and ``role``.

    One equi-join on ticker with a between predicate; a row can sit in several folds' train
    ranges (expanding windows), which is the output itself, not an intermediate blow-up."""
    d = panel[order]
    b = bounds.select(F.col(key).alias("_bk"), "fold", "train_lo", "train_hi", "val_lo", "val_hi")
    in_train = d.between(F.col("train_lo"), F.col("train_hi"))
    in_val = d.between(F.col("val_lo"), F.col("val_hi"))
    j = panel.join(b, (panel[key] == F.col("_bk")) & (in_train | in_val))
    out = j.withColumn("role", F.when(in_train, "train").otherwise("val")).drop(
        "_bk", "train_lo", "train_hi", "val_lo", "val_hi")
    out = frame_with_target(out.select(*panel.columns, "fold", "role"), key)
    return dropna_features(out) if dropna else out


def global_insample_and_test(panel: DataFrame, bounds: DataFrame, validate_cutoff: str, horizon: int,
                             dropna: bool = True, key: str = KEY, order: str = ORDER) -> DataFrame:
    """In-sample = rows inside any kept fold's train or val range (left semi join, so no
    duplicates arise); test = the purged final test of the tickers that have folds."""
    d = panel[order]
    b = bounds.select(F.col(key).alias("_bk"), "train_lo", "train_hi", "val_lo", "val_hi")
    cond = (panel[key] == F.col("_bk")) & (d.between(F.col("train_lo"), F.col("train_hi"))
                                           | d.between(F.col("val_lo"), F.col("val_hi")))
    ins = panel.join(b, cond, "left_semi").withColumn("role", F.lit("insample"))
    _, test = insample_test(panel, validate_cutoff, horizon, key, order)
    test = test.join(bounds.select(key).distinct(), key, "left_semi").withColumn("role", F.lit("test"))
    out = frame_with_target(ins.unionByName(test), key)
    return dropna_features(out) if dropna else out


def panel_integrity(df: DataFrame, key: str = "__ticker__", order: str = ORDER) -> DataFrame:
    """Row count, distinct keys and duplicated keys (must be 0), as one row."""
    per = df.groupBy(key, order).agg(F.count(F.lit(1)).alias("_n"))
    return per.agg(F.sum("_n").cast("bigint").alias("n_rows"),
                   F.count(F.lit(1)).alias("n_keys"),
                   F.count_if(F.col("_n") > 1).alias("n_dup_keys"))
