"""Time the headline queries; print one JSON line.

Env: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8),
BENCH_QUERIES (comma list, default: the headline set below), BENCH_REPEAT
(default 2).  Each query is executed in full with the ``noop`` sink (no
collect to the driver), ``BENCH_REPEAT`` times; a query's time is its best
run, and the value is the sum of those, after one warm-up query.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from tidemark.plans.catalog import QUERIES  # noqa: E402
from tidemark.session import build_session  # noqa: E402

HEADLINE = [
    "agg_5min", "agg_15min", "agg_30min", "lag_features", "rolling_avg", "rolling_std", "target_lead",
    "demand_features", "demand_features_chunked", "ml_features", "calendar_features", "forecast_errors", "forecast_metrics",
    "category_index", "time_split_counts", "calendar_feed", "sales_feed", "prices_feed", "source_monitor",
    "missing_dates", "quality_report", "describe_numeric", "feature_correlations", "holiday_impact",
    "stream_sales", "stream_prices", "train_metrics",
]


def driver_memory() -> str:
    """60 % of physical memory, between 2 and 8 GB (local mode: the driver is the executor)."""
    try:
        phys = os.sysconf("SC_PAGE_SIZE") * os.sysconf("SC_PHYS_PAGES")
    except (ValueError, OSError, AttributeError):
        return "4g"
    return f"{max(2, min(8, int(phys * 0.6 / 2**30)))}g"


def run(spark, name: str, sf: str) -> float:
    t0 = time.perf_counter()
    QUERIES[name](spark, sf).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - t0


def main() -> None:
    sf = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    names = [n for n in os.environ.get("BENCH_QUERIES", ",".join(HEADLINE)).split(",") if n]
    spark = build_session("tidemark-bench", master=f"local[{cpus}]", shuffle_partitions=max(2 * cpus, 8),
                          extra={"spark.driver.memory": driver_memory()})
    run(spark, "agg_15min", sf)  # warm-up: JVM, codegen caches, file listing
    repeat = max(1, int(os.environ.get("BENCH_REPEAT", "2")))
    times = {n: round(min(run(spark, n, sf) for _ in range(repeat)), 3) for n in names}
    sf_name = os.path.basename(os.path.normpath(sf)).replace("sf", "")
    print(json.dumps({
        "metric": "headline_queries_total_wall", "value": round(sum(times.values()), 3), "unit": "sec",
        "queries": times, "sf": float(sf_name) if sf_name.replace(".", "").isdigit() else sf,
        "cpus": cpus, "repeat": repeat,
    }))
    spark.stop()


if __name__ == "__main__":
    main()
