"""Bench: run the headline jobs on one scale factor and print one JSON line.

Env: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8), BENCH_RUNS (default 3),
BENCH_QUERIES (comma list, default the headline set). Each query is written to the ``noop`` sink
(full execution, no output I/O); the reported time per query is the median of the warm runs
after one warm-up run.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = ("item_cf", "price_rerank", "ctr_rerank", "extend_lists", "swing", "user_recommendations",
            "latest_behaviour", "offer_features", "json_features", "sequence_features", "item_sentences",
            "co_click_edges", "evaluate_many", "valid_items")


def main() -> None:
    from recsift.plans.queries import QUERIES
    from recsift.plans.session import build_session

    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    names = [n for n in os.environ.get("BENCH_QUERIES", ",".join(HEADLINE)).split(",") if n]
    spark = build_session(f"local[{cpus}]", shuffle_partitions=max(8, cpus * 2), app="recsift-bench")
    times: dict[str, float] = {}
    for n in names:
        fn = QUERIES[n]
        samples = []
        for i in range(runs + 1):
            t0 = time.perf_counter()
            fn(spark, sf_dir).write.format("noop").mode("overwrite").save()
            if i > 0 or runs == 0:
                samples.append(time.perf_counter() - t0)
        times[n] = round(statistics.median(samples), 3)
        # let the context cleaner drop this query's shuffle files before the next one starts
        spark.sparkContext._jvm.System.gc()
        time.sleep(1)
        print(f"# {n}: {times[n]}s", file=sys.stderr, flush=True)
    sf = os.path.basename(sf_dir.rstrip("/")).replace("sf", "")
    print(json.dumps({"metric": "total_warm_median_sec", "value": round(sum(times.values()), 3), "unit": "sec",
                      "queries": times, "sf": sf, "cpus": cpus, "runs": runs}))
    spark.stop()


if __name__ == "__main__":
    main()
