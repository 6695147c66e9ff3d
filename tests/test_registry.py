"""Registry contract and a subset of the DuckDB oracle comparisons at sf0.001."""

import math

import duckdb
import pytest

import __spark_entry__ as entry
from tests.conftest import SF001

FAST = ["bars_calm", "bars_wide", "events_load", "features_reference", "features_full", "macd", "rsi",
        "interactions_full", "dedupe", "outlier_qc", "clean_pipeline", "processed_panel",
        "folds_expanding", "folds_sliding", "calendar_blocks_quarter", "roc_auc", "sweep", "gains",
        "rolling_accuracy", "naive_global", "csv_normalise", "csv_header_groups", "csv_clean_pipeline", "report_curves",
        "report_box", "report_folds", "report_renamed", "best_fold", "proba_strategies", "metrics_roundtrip",
        "predictions_roundtrip", "skipped_tickers", "shuffled_split"]


def test_contract_keys():
    q, o = entry.queries(), entry.oracle_sql()
    assert set(o) <= set(q)
    assert len(q) >= 75


def test_entry_runs(spark):
    df = entry.entry(spark)
    assert df.count() > 1000
    assert "Target" in df.columns


def _norm(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else round(v, 6) + 0.0
    if hasattr(v, "isoformat"):
        return v.isoformat()
    return v


def _canon(rows, cols):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted((tuple(_norm(r[i]) for i in order) for r in rows), key=repr)


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in ("lineitem", "part"):
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF001}/{t}.parquet')")
    return c


@pytest.mark.parametrize("name", FAST)
def test_oracle_matches(spark, con, name):
    sdf = entry.queries()[name](spark, SF001)
    res = con.execute(entry.oracle_sql()[name])
    ocols = [d[0] for d in res.description]
    assert sorted(sdf.columns) == sorted(ocols)
    assert _canon([tuple(r) for r in sdf.collect()], sdf.columns) == _canon(res.fetchall(), ocols)
