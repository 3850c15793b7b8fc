"""Benchmark the headline queries; prints one JSON line.

env: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8),
     BENCH_REPEATS (default 3; the median is reported), BENCH_QUERIES (comma list).
Each run evaluates every output column through the ``noop`` sink (``count()``
could prune columns and skip work).
"""

from __future__ import annotations

import json
import os
import re
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from tessera.plans.catalog import REGISTRY  # noqa: E402
from tessera.session import local_session  # noqa: E402

HEADLINE = ["clean_corpus", "best_match", "best_match_closed", "similarity_search", "create_documents",
            "judge_metrics", "comparative_stats"]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    repeats = int(os.environ.get("BENCH_REPEATS", "3"))
    names = [q for q in os.environ.get("BENCH_QUERIES", ",".join(HEADLINE)).split(",") if q]
    spark = local_session(cpus, app="tessera-bench", shuffle_partitions=cpus)
    # warm the JVM and the Python workers once (not timed)
    REGISTRY["value_counts"](spark, sf_dir).write.format("noop").mode("overwrite").save()

    times: dict[str, float] = {}
    for name in names:
        runs = []
        for _ in range(repeats):
            t0 = time.perf_counter()
            REGISTRY[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            runs.append(time.perf_counter() - t0)
        times[name] = round(statistics.median(runs), 3)
    m = re.search(r"sf([0-9.]+)", sf_dir)
    print(json.dumps({"metric": "sum of median query seconds", "value": round(sum(times.values()), 3),
                      "unit": "sec", "queries": times, "sf": float(m.group(1)) if m else sf_dir,
                      "cpus": cpus, "repeats": repeats}))
    spark.stop()


if __name__ == "__main__":
    main()
