"""Benchmark: headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one JSON line.

Each query is run to completion (a full write to a no-op sink of every row, not
a count that Spark could shortcut). BENCH_WARMUP=1 adds an untimed warm-up run
per query; BENCH_RUNS sets the number of timed runs (median reported).

`queries` has the whole time of each query, with the raw files it makes first; `models` has the
time without making those files, which is what a model costs.
"""
from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from ledgerlake.queries.registry import QUERIES  # noqa: E402
from ledgerlake.session import local_session  # noqa: E402

HEADLINE = ["call_tree_fact", "tx_fact", "log_fact", "block_fact", "tree_flatten", "latest_ranked",
            "heal_late", "heal_logs", "explode_lines", "amounts", "check_gaps", "backlog_keys", "top_unread", "merge_keep"]


def run_once(spark, name: str, sf: str) -> tuple[float, float]:
    from ledgerlake.queries import registry
    registry._chains.clear()  # rebuild derived chain tables inside every timed run
    t0 = time.perf_counter()
    df = QUERIES[name](spark, sf)
    df.write.format("noop").mode("overwrite").save()
    took = time.perf_counter() - t0
    return took, took - sum(c.fixture_seconds for c in registry._chains.values())


def main():
    sf = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "1"))
    names = sys.argv[1:] or HEADLINE
    spark = local_session(cpus, shuffle_partitions=int(os.environ.get("BENCH_PARTITIONS", "16")))
    times, models = {}, {}
    for n in names:
        if os.environ.get("BENCH_WARMUP", "0") == "1":
            run_once(spark, n, sf)  # warm-up (JIT, file listing, python workers)
        took = [run_once(spark, n, sf) for _ in range(runs)]
        times[n], models[n] = (round(statistics.median(x), 3) for x in zip(*took))
    sf_name = os.path.basename(sf.rstrip("/")).replace("sf", "")
    print(json.dumps({"metric": "total_query_seconds", "value": round(sum(times.values()), 3), "unit": "sec",
                      "queries": times, "models": models, "sf": sf_name, "cpus": cpus}))


if __name__ == "__main__":
    main()
