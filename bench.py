"""Benchmark the headline queries.

Runs on local[$BENCH_CPUS] over $BENCH_SF_DIR (default /root/testdata/sf0.1):
one warm-up, then the median of $BENCH_RUNS (default 3) timed runs per query;
a run covers planning plus full materialisation into the ``noop`` sink.
Prints one JSON line.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = ["category_pivot", "weighted_mode_heading", "closure_keys",
            "paper_delta_groups_owner", "full_row_delta", "keyword_dim", "full_load"]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    names = [n for n in os.environ.get("BENCH_QUERIES", ",".join(HEADLINE)).split(",") if n]

    from scriptorium.bindings import QUERIES
    from scriptorium.session import local_session
    spark = local_session(cpus, cpus)

    def once(name: str) -> float:
        t0 = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - t0

    results = {}
    for name in names:
        once(name)  # warm-up
        results[name] = round(statistics.median(once(name) for _ in range(runs)), 3)
    sf = os.path.basename(sf_dir.rstrip("/")).replace("sf", "")
    print(json.dumps({"metric": "sum_of_median_query_seconds", "value": round(sum(results.values()), 3),
                      "unit": "sec", "queries": results, "sf": float(sf) if sf else sf_dir,
                      "cpus": cpus, "runs": runs}))
    spark.stop()


if __name__ == "__main__":
    main()
