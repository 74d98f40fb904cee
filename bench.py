"""Bench: run every registered query at $BENCH_SF_DIR on local[$BENCH_CPUS].

Each query is executed in full with the ``noop`` sink (the whole plan runs,
nothing is collected to the driver).  Prints one JSON line:
``{"metric": "total_query_seconds", "value": N, "unit": "sec", "queries": {...}, "sf": ...}``.
"""

from __future__ import annotations

import json
import os
import re
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    only = set(sys.argv[1:])

    from rivulet.plans.registry import all_queries
    from rivulet.session import build_session

    spark = build_session(master=f"local[{cpus}]", shuffle_partitions=int(cpus), app_name="rivulet-bench")
    queries = {n: q for n, q in sorted(all_queries().items()) if not only or n in only}

    # Warm-up pass on the smallest test tables: JIT and generated-code caches
    # (the same plan shapes), as on a long-running cluster.  Not timed.
    warm_dir = os.environ.get("BENCH_WARM_DIR", "/root/testdata/sf0.001")
    if os.path.isdir(warm_dir):
        for q in queries.values():
            q.fn(spark, warm_dir).write.format("noop").mode("overwrite").save()

    times: dict[str, float] = {}
    for name, q in queries.items():
        t0 = time.perf_counter()
        q.fn(spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - t0, 3)

    m = re.search(r"sf([0-9.]+)", sf_dir)
    print(json.dumps({
        "metric": "total_query_seconds",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "sf": float(m.group(1)) if m else sf_dir,
        "cpus": int(cpus),
    }))
    spark.stop()


if __name__ == "__main__":
    main()
