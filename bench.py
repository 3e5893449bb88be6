"""Benchmark the headline queries; prints ONE JSON line.

``local[$BENCH_CPUS]``; per query one warm-up run, then the median of five
runs, each on a freshly built plan (a reused DataFrame would reuse its
finished shuffle stages) and written to the ``noop`` sink so every row and
column is produced. Plan building is included in the time.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = (
    "trial_inventory",
    "trial_extract",
    "inventory_history",
    "flag_viable",
    "multi_trial_counts",
    "viability_by_site",
    "param_query",
    "sink_roundtrip",
)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    runs = int(os.environ.get("BENCH_RUNS", "5"))
    names = [n for n in os.environ.get("BENCH_QUERIES", ",".join(HEADLINE)).split(",") if n]

    from vialflow.queries import QUERIES
    from vialflow.session import local_session

    spark = local_session(cores=cpus, shuffle_partitions=max(cpus, 8), app="vialflow-bench")
    results: dict[str, float] = {}
    rows: dict[str, int] = {}
    for name in names:  # warm-up pass over every query (JIT, file metadata caches)
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
    for name in names:
        fn = QUERIES[name]
        times = []
        for _ in range(runs):
            t0 = time.perf_counter()
            fn(spark, sf_dir).write.format("noop").mode("overwrite").save()
            times.append(time.perf_counter() - t0)
        results[name] = round(statistics.median(times), 3)
        rows[name] = fn(spark, sf_dir).count()
    sf = os.path.basename(sf_dir.rstrip("/")).removeprefix("sf")
    print(json.dumps({
        "metric": "sum_of_median_query_seconds",
        "value": round(sum(results.values()), 3),
        "unit": "sec",
        "queries": results,
        "rows": rows,
        "sf": float(sf) if sf.replace(".", "", 1).isdigit() else sf,
        "cpus": cpus,
        "runs": runs,
        "spark": spark.version,
    }))
    spark.stop()


if __name__ == "__main__":
    main()
