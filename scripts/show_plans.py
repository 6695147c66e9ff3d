"""Print plan-shape counts (exchanges, sorts, windows, broadcasts) of the headline plans.

Usage: python scripts/show_plans.py [sf_dir] [--full NAME]
"""

from __future__ import annotations

import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from panelspark.config import PanelConfig  # noqa: E402
from panelspark.operators import cleaning as cl  # noqa: E402
from panelspark.operators import features as fx  # noqa: E402
from panelspark.plans.pipeline import data_build  # noqa: E402
from panelspark.session import get_spark  # noqa: E402
from panelspark.sources import testbeds as tb  # noqa: E402

FULL = ("r_1d", "lag", "sma", "vix", "rsi", "macd", "boll", "obv", "range", "gap")


def shape(df) -> dict:
    p = df._jdf.queryExecution().executedPlan().toString()
    return {"exchange": len(re.findall(r"\bExchange hashpartitioning", p)),
            "broadcast": len(re.findall(r"BroadcastExchange", p)),
            "sort": len(re.findall(r"\bSort \[", p)),
            "window": len(re.findall(r"\bWindow \[", p)),
            "scan_columns": sorted(set(re.findall(r"ReadSchema: struct<([^>]*)>", p)))}


def main():
    args = sys.argv[1:]
    sf = args[0] if args and args[0].startswith("/") else "/root/testdata/sf0.01"
    spark = get_spark("local[8]", 8)
    plans = {
        "bars_wide": tb.wide_bars(spark, sf),
        "features_full": fx.make_features(tb.wide_bars(spark, sf), FULL, profile="full"),
        "processed_full": fx.build_processed_panel(tb.wide_bars(spark, sf), FULL, profile="full"),
        "outlier_flags": cl.outlier_flags(tb.raw_bars(spark, sf), tb.corp_events(spark, sf)),
        "data_build": data_build(tb.dirty_bars(spark, sf), tb.corp_events(spark, sf), PanelConfig()),
    }
    for name, df in plans.items():
        print(name, shape(df))
    if "--full" in args:
        plans[args[args.index("--full") + 1]].explain("formatted")


if __name__ == "__main__":
    main()
