"""Benchmark: run the headline queries on the driver tables and print one JSON
line. Every query is executed in full through Spark's ``noop`` sink (nothing
is collected to the driver).

    BENCH_SF_DIR=/root/testdata/sf0.1 BENCH_CPUS=8 python bench.py
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from catchment.plans import queries as Q, roles  # noqa: E402
from catchment.session import local_session  # noqa: E402

HEADLINE = [
    "access_gap", "nearest_k_mean", "class_benchmark", "summary_table", "test_report",
    "points_in_zones", "per_capita", "figure_data", "od_by_population", "od_straight_line",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    names = sys.argv[1:] or HEADLINE
    spark = local_session(cpus, shuffle_partitions=cpus)
    # Warm-up, not timed: the same queries once on smaller driver tables
    # (JVM start, JIT and code generation), never on the benchmark's data.
    warm = os.environ.get("BENCH_WARMUP_DIR", "/root/testdata/sf0.01")
    if os.path.isdir(warm) and warm.rstrip("/") != sf_dir:
        for name in names:
            Q.QUERIES[name](spark, warm).write.format("noop").mode("overwrite").save()
    # table definitions (file listing, footer schema) of the benchmark data: metadata only
    for t in ("lineitem", "orders", "customer", "supplier", "nation", "region", "events"):
        roles.table(spark, sf_dir, t)
    times = {}
    for name in names:
        t0 = time.perf_counter()
        Q.QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - t0, 3)
    spark.stop()
    sf = os.path.basename(sf_dir).replace("sf", "")
    print(json.dumps({
        "metric": "headline_queries_total", "value": round(sum(times.values()), 3), "unit": "sec",
        "queries": times, "sf": float(sf) if sf.replace(".", "").isdigit() else sf, "cpus": cpus,
    }))


if __name__ == "__main__":
    main()
