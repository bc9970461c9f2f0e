"""Time the headline queries: prints one JSON line.

``BENCH_SF_DIR`` (default /root/testdata/sf0.1) and ``BENCH_CPUS`` (default 8) choose data and
cores, ``BENCH_RUNS`` (default 3) the timed runs after one warm-up; the median counts. Each run
builds the query anew and writes the whole result to the noop sink.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from lumbung import workload  # noqa: E402
from lumbung.session import get_session  # noqa: E402

HEADLINE = [
    "c3_event_dates",
    "d7_metric_merge",
    "d13_orphan_keys",
    "e1_sick_dead_sums",
    "e4_mean_price",
    "e5_group_median",
    "e16_monthly_gap",
    "f3_pareto",
    "g2_top_regions",
    "h7_risk_heatmap",
    "i1_price_median_fill",
    "j6_fact_build",
    "k2_lag_scan",
    "k7_box_of_lines",
    "l4_null_counts",
    "m6_roll_up_region",
]


def run(name: str, spark, folder: str) -> float:
    start = time.perf_counter()
    workload.QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    names = sys.argv[1:] or HEADLINE
    spark = get_session(
        "lumbung-bench",
        **{"spark.master": f"local[{cpus}]", "spark.driver.memory": "12g", "spark.sql.shuffle.partitions": cpus},
    )
    spark.sparkContext.setLogLevel("ERROR")
    seconds = {}
    for name in names:
        run(name, spark, folder)
        seconds[name] = round(statistics.median(run(name, spark, folder) for _ in range(runs)), 3)
    print(json.dumps({
        "metric": "headline queries, sum of median seconds", "value": round(sum(seconds.values()), 3), "unit": "sec",
        "queries": seconds, "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"), "cpus": int(cpus), "runs": runs,
    }))
    spark.stop()


if __name__ == "__main__":
    main()
