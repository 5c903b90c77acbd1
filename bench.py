"""Bench: run the registered analytics at $BENCH_SF_DIR on local[$BENCH_CPUS].

The streams of ``plans.streams`` run to their end at fixed costs of many small jobs; they are run by name only
(``BENCH_QUERIES``). Each query is fully computed into Spark's ``noop`` sink (no driver collect), after
one warm-up of the JVM. Prints one JSON line:
{"metric": "total_query_seconds", "value": N, "unit": "sec", "queries": {...}, "sf": ...}
"""

from __future__ import annotations

import json
import os
import re
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from eventflow.plans import QUERIES  # noqa: E402
from eventflow.session import local_session  # noqa: E402


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = os.environ.get("BENCH_CPUS", "8")
    only = [q for q in os.environ.get("BENCH_QUERIES", "").split(",") if q]
    spark = local_session(cpus, shuffle_partitions=int(cpus) if cpus.isdigit() else 8,
                          app="eventflow-bench")
    chosen = {q: b for q, b in QUERIES.items() if (q in only if only else b.__module__ != "eventflow.plans.streams")}
    # Warm-up (JIT, codegen caches): every query once on the smallest tables, untimed.
    warm_dir = os.environ.get("BENCH_WARM_DIR", "/root/testdata/sf0.001")
    if os.path.isdir(warm_dir):
        for build in chosen.values():
            build(spark, warm_dir).write.format("noop").mode("overwrite").save()
    times = {}
    for name, build in chosen.items():
        t0 = time.perf_counter()
        build(spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - t0, 3)
        print(f"# {name}: {times[name]}s", file=sys.stderr, flush=True)
    m = re.search(r"sf([0-9.]+)", sf_dir)
    out = {"metric": "total_query_seconds", "value": round(sum(times.values()), 3), "unit": "sec",
           "queries": times, "sf": float(m.group(1)) if m else sf_dir}
    print(json.dumps(out))
    spark.stop()


if __name__ == "__main__":
    main()
