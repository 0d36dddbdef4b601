"""Benchmark: run the headline queries on $BENCH_SF_DIR and print one JSON line.

Each query is executed to completion with Spark's ``noop`` sink (every row is
computed, nothing is collected to the driver).  A warm-up pass on the smallest
scale primes the JVM; then every query runs ``BENCH_RUNS`` times (default 1)
and the median wall time is reported.  ``value`` is the sum of the medians.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from shelfcast.plans.catalog import QUERIES  # noqa: E402
from shelfcast.session import build_session  # noqa: E402

HEADLINE = [
    "bronze_rows",
    "silver_events",
    "current_transactions",
    "gold_daily_demand",
    "bronze_quality",
    "silver_quality",
    "constraint_report",
    "inventory_cap_violations",
    "demand_panel",
    "seasonal_naive",
    "forecast_metrics",
    "baseline_evaluation",
    "active_promotion",
    "expected_demand",
    "revenue_lines",
    "land_bronze_stream",
    "lakehouse_end_to_end",
]


def run_once(spark, name: str, sf_dir: str) -> float:
    t0 = time.perf_counter()
    QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - t0


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "1"))
    names = os.environ.get("BENCH_QUERIES", ",".join(HEADLINE)).split(",")
    spark = build_session(f"local[{cpus}]", app_name="shelfcast-bench", shuffle_partitions=int(cpus) * 2,
                          extra_conf={"spark.driver.memory": "8g"})
    warm_dir = os.path.join(os.path.dirname(sf_dir), "sf0.001")
    if os.path.isdir(warm_dir):
        for name in ("gold_daily_demand", "baseline_evaluation"):
            run_once(spark, name, warm_dir)
    timings: dict[str, float] = {}
    for name in names:
        samples = [run_once(spark, name, sf_dir) for _ in range(runs)]
        timings[name] = round(statistics.median(samples), 3)
    sf = os.path.basename(sf_dir).removeprefix("sf")
    print(json.dumps({
        "metric": "headline_queries_total_wall",
        "value": round(sum(timings.values()), 3),
        "unit": "sec",
        "queries": timings,
        "sf": float(sf) if sf.replace(".", "", 1).isdigit() else sf,
        "cpus": int(cpus),
        "runs": runs,
    }))
    spark.stop()


if __name__ == "__main__":
    main()
