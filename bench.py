"""Benchmark: run the catalog queries at $BENCH_SF_DIR on local[$BENCH_CPUS].

Each query is executed to completion through the ``noop`` sink (no driver
collect).  One warm-up pass over all queries, then $BENCH_RUNS timed passes;
the per-query figure is the median.  Prints ONE JSON line.

Shuffle partitions default to one per core (one wave per shuffle stage at
this size; AQE coalesces further).  On a cluster the count is sized from
the data instead: AQE splits and coalesces toward the advisory partition
size set in ``tillwise.session``.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from tillwise.plans.catalog import QUERIES  # noqa: E402
from tillwise.session import build_session  # noqa: E402

# Queries that land files as part of the operator: timed like the others.
SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = int(os.environ.get("BENCH_CPUS", "8"))
RUNS = int(os.environ.get("BENCH_RUNS", "3"))
ONLY = [q for q in os.environ.get("BENCH_QUERIES", "").split(",") if q]


def _sf_label(path: str) -> str:
    base = os.path.basename(path.rstrip("/"))
    return base[2:] if base.startswith("sf") else base


def run_once(spark, key: str) -> float:
    t0 = time.perf_counter()
    QUERIES[key](spark, SF_DIR).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - t0


def main() -> None:
    spark = build_session(
        f"local[{CPUS}]", app="tillwise-bench", shuffle_partitions=int(os.environ.get("BENCH_SHUFFLE_PARTITIONS", CPUS)),
        extra={"spark.driver.memory": os.environ.get("BENCH_DRIVER_MEMORY", "16g"),
               **({"spark.sql.autoBroadcastJoinThreshold": os.environ["BENCH_STATIC_BCAST"]}
                  if os.environ.get("BENCH_STATIC_BCAST") else {})})
    keys = ONLY or list(QUERIES)
    for k in keys:  # warm-up: JIT, file listing caches, class loading
        run_once(spark, k)
    times: dict[str, list[float]] = {k: [] for k in keys}
    for _ in range(RUNS):
        for k in keys:
            times[k].append(run_once(spark, k))
    per_query = {k: round(statistics.median(v), 4) for k, v in times.items()}
    total = round(sum(per_query.values()), 3)
    print(json.dumps({
        "metric": "total_median_query_seconds",
        "value": total,
        "unit": "sec",
        "queries": per_query,
        "sf": _sf_label(SF_DIR),
        "cpus": CPUS,
        "runs": RUNS,
        "n_queries": len(keys),
    }))
    spark.stop()


if __name__ == "__main__":
    main()
