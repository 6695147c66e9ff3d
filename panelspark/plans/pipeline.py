"""Entry points of the reference, as Spark plans.

A. data build: raw bars -> dedupe -> prune -> outliers -> features + label -> dropna ->
   interactions -> processed panel (one lazy plan; one exchange on ticker for the window
   stack, the event lookup reuses that partitioning).
B. walk-forward selection: processed panel -> fold bounds -> pooled pairs -> sweeps.
C. final test: in-sample fit -> eval frame -> metric tables.

The processed panel is written once (Parquet partitioned by ticker, as the reference writes
one processed file per ticker) and read by B and C, which also cuts the lineage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from panelspark.config import PanelConfig
from panelspark.operators import cleaning as cl
from panelspark.operators import features as fx
from panelspark.operators import folds as fo
from panelspark.sources import files as fs


def data_build(raw: DataFrame, events: DataFrame | None, conf: PanelConfig,
               ord_col: str | None = "ord") -> DataFrame:
    """Entry A as one lazy plan."""
    clean = cl.cleaning_pipeline(raw, events, ord_col=ord_col if ord_col in raw.columns else None)
    return fx.build_processed_panel(clean, conf.features, conf.horizon, conf.threshold, conf.profile,
                                    conf.add_int_features)


def write_processed(panel: DataFrame, path: str, fmt: str = "parquet") -> str:
    return fs.write_panel(panel, path, fmt)


def load_processed(spark: SparkSession, path: str, conf: PanelConfig | None = None) -> DataFrame:
    tickers = conf.ticker_list if conf is not None and conf.ticker_list else None
    return fs.read_panel(spark, path, tickers)


def fold_collection(panel: DataFrame, conf: PanelConfig) -> DataFrame:
    """Entry B stages 1-3: fold bounds per ticker, trimmed to the common fold count."""
    b = fo.fold_bounds(panel, conf.validate_cutoff, conf.horizon, conf.embargo_days, conf.fold_len,
                       conf.fold_mode, conf.sliding_train_years, align=conf.align)
    return fo.trim_folds(b)
