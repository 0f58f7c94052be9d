"""Time the headline queries; print one JSON line.

Env: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8),
BENCH_RUNS (timed runs per query after one warm-up, default 3; median kept).
Each query is run to completion with the ``noop`` sink, so every row is
computed and nothing is collected to the driver.
"""

from __future__ import annotations

import json
import os
import re
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = [
    "log_split_page", "unique_visit", "jump_detail", "visitor_stats", "order_wide",
    "payment_wide", "product_stats", "province_stats", "keyword_stats", "route_columns",
    "sink_dim_upsert", "cdc_current_image", "gmv_by_brand",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    from emberflow.plans.catalog import QUERIES
    from emberflow.session import build_session
    spark = build_session(f"local[{cpus}]", shuffle_partitions=cpus)
    times = {}
    for name in HEADLINE:
        fn = QUERIES[name]
        samples = []
        for i in range(runs + 1):
            t0 = time.perf_counter()
            fn(spark, sf_dir).write.format("noop").mode("overwrite").save()
            if i:  # first run warms the JVM and file listing caches
                samples.append(time.perf_counter() - t0)
        times[name] = round(statistics.median(samples), 3)
    m = re.search(r"sf([0-9.]+)", sf_dir)
    print(json.dumps({"metric": "total_sec_headline_queries", "value": round(sum(times.values()), 3),
                      "unit": "sec", "queries": times, "sf": float(m.group(1)) if m else None}))


if __name__ == "__main__":
    main()
