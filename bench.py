"""Time the headline queries and print one JSON line.

env: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8),
     BENCH_QUERIES (comma list to override the headline set).

Every query is fully executed through the ``noop`` sink (all rows computed,
nothing collected).  Two untimed warm-up queries (a scan, a window) start the
JVM and warm the join/window code paths first.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = [
    "training_table", "training_table_sql", "refill_features", "label", "patient_profile",
    "controlled_profile", "demand_features", "demand_windows", "request_features", "lift_table",
    "recommendations", "psi", "roc_auc", "review_budget", "ts_folds", "refill_windows",
    "stream_history", "stream_labels", "isolation_scores",
]


def main():
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    names = [q for q in os.environ.get("BENCH_QUERIES", "").split(",") if q] or HEADLINE

    from dosewise.plans import load_all
    from dosewise.session import get_spark

    spark = get_spark(master=f"local[{cpus}]", shuffle_partitions=max(cpus * 2, 8))
    queries, _ = load_all()
    # untimed warm-up: JVM start, code generation paths for scans, joins and windows
    for w in ["scan_fills", "gaps"]:
        queries[w](spark, sf_dir).write.format("noop").mode("overwrite").save()

    times = {}
    for name in names:
        t0 = time.perf_counter()
        queries[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - t0, 3)
        print(f"{name}: {times[name]}s", file=sys.stderr)
    sf = os.path.basename(sf_dir.rstrip("/")).replace("sf", "")
    print(json.dumps({"metric": "headline_queries_total_wall", "value": round(sum(times.values()), 3),
                      "unit": "sec", "queries": times, "sf": sf, "cpus": cpus}))
    spark.stop()


if __name__ == "__main__":
    main()
