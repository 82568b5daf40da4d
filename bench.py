"""Benchmark: every registered query on $BENCH_SF_DIR, local[$BENCH_CPUS].

Each query runs to completion through the ``noop`` sink (full execution, no
collect to the driver). Prints one JSON line.
"""

from __future__ import annotations

import json
import os
import sys
import time

ROOT = os.path.dirname(os.path.abspath(__file__))
sys.path.insert(0, ROOT)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    from newsarc.plans.queries import QUERIES
    from newsarc.session import build_session

    spark = build_session(f"local[{cpus}]", partitions=max(cpus, 8), app="newsarc-bench")
    # warm-up: JIT and parquet footer caches, not timed
    QUERIES["q_links"](spark, sf_dir).write.format("noop").mode("overwrite").save()

    times: dict[str, float] = {}
    for name, fn in QUERIES.items():
        t0 = time.perf_counter()
        fn(spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - t0, 3)
    spark.stop()
    sf = os.path.basename(sf_dir.rstrip("/")).replace("sf", "")
    print(json.dumps({"metric": "total_query_seconds", "value": round(sum(times.values()), 3),
                      "unit": "sec", "queries": times, "sf": sf}))


if __name__ == "__main__":
    main()
