"""panelspark: panel time-series features, walk-forward folds and evaluation on Spark.

Every operator is a ``DataFrame -> DataFrame`` transform over one panel table keyed by
``(ticker, Date)``. All per-ticker work runs as window functions partitioned by ``ticker``;
global orderings (ROC, PR, gains, rolling accuracy) use bucketed two-phase prefix sums
instead of single-partition windows.
"""

from panelspark.config import PanelConfig
from panelspark.session import get_spark

__all__ = ["PanelConfig", "get_spark"]
