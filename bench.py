"""Time the headline queries and print one JSON line.

Each query is planned and run to the end, without writing its rows anywhere; the better of two
runs counts.
"""

from __future__ import annotations

import json
import os
import time

from tidemark.plans.registered import QUERIES
from tidemark.session import build_session

HEADLINE = [
    "feature_vector",
    "backfill_history",
    "latest_asof",
    "pit_join",
    "pit_join_orders",
    "on_demand_batch",
    "dual_path_batch",
    "materialize_latest",
    "validation_violations",
    "feature_stats",
    "skew_report",
    "churn_labels",
    "pit_training_set",
    "leakage_audit",
    "stratified_split",
    "auc_rank",
    "latency_percentiles",
]
RUNS = 2


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session(
        "bench",
        f"local[{cpus}]",
        spark__sql__shuffle__partitions=cpus if cpus.isdigit() else "8",
        spark__driver__memory="12g",
        spark__ui__enabled="false",
        spark__ui__showConsoleProgress="false",
    )
    spark.sparkContext.setLogLevel("ERROR")
    seconds = {}
    for name in HEADLINE:
        runs = []
        for _ in range(RUNS):
            start = time.perf_counter()
            QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
            runs.append(time.perf_counter() - start)
        seconds[name] = round(min(runs), 3)
    print(json.dumps({
        "metric": "headline_queries_total",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"),
        "settings": f"local[{cpus}], better of {RUNS} runs",
    }))
    spark.stop()


if __name__ == "__main__":
    main()
