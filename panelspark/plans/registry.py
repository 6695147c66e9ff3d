"""Registry of named queries: a Spark builder and (where SQL can express it) a DuckDB oracle.

Each builder takes ``(spark, sf_dir)`` and reads the given tables (or panels Spark derives
from them) in full. Doubles are rounded to 6 places on both sides before comparison.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, FloatType

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn):
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")

        def run(spark, sf_dir, _fn=fn):
            tune_session(spark)
            return _fn(spark, sf_dir)

        run.__name__ = fn.__name__
        run.__doc__ = fn.__doc__
        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = sql
        return fn
    return deco


# Comparison rounding. Averages of 6-decimal prices often sit exactly on a 7th-decimal
# midpoint, where engines break the tie differently (decimal vs binary rounding). A fixed
# nudge far below the output precision moves such data-made midpoints off the boundary, so
# both engines emit identical doubles. The same expression is used in every oracle.
NUDGE = 3.1e-10


def round6(c):
    return F.round(c + F.lit(NUDGE), 6) + F.lit(0.0)


def tune_session(spark) -> None:
    """Apply the runtime SQL settings the plans are tuned for to any session (the caller may
    have built its own). Only settings that change plans, never results."""
    from panelspark.session import SESSION_DEFAULTS
    for k in ("spark.sql.adaptive.enabled", "spark.sql.adaptive.skewJoin.enabled",
              "spark.sql.requireAllClusterKeysForCoPartition", "spark.sql.constraintPropagation.enabled"):
        spark.conf.set(k, SESSION_DEFAULTS[k])
    if spark.conf.get("spark.checkpoint.dir", None) is None:
        from panelspark.session import ensure_checkpoint_dir
        ensure_checkpoint_dir(spark)


def rounded(df: DataFrame, places: int = 6) -> DataFrame:
    """Round every floating column; ``+ 0.0`` folds -0.0 into 0.0."""
    cols = []
    for f in df.schema.fields:
        if isinstance(f.dataType, (DoubleType, FloatType)):
            cols.append((F.round(F.col(f.name) + F.lit(NUDGE), places) + F.lit(0.0)).alias(f.name))
        else:
            cols.append(F.col(f.name))
    return df.select(*cols)


def load_all() -> None:
    """Import the modules that register queries."""
    from panelspark.plans import (  # noqa: F401
        queries_clean, queries_core, queries_folds, queries_metrics, queries_models, queries_results, queries_sources)
