"""Times the headline queries: one warm-up, then the median of three runs, each result computed in full.

    BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default all cores), BENCH_RUNS (default 3)
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from assetpulse.plans.catalog import all_queries  # noqa: E402
from assetpulse.session import build_session  # noqa: E402

HEADLINES = [
    "daily_facts",
    "daily_spine_work",
    "failure_labels",
    "code_rolling_features",
    "error_log",
    "reason_matrix",
    "asset_error_codes",
    "technician_history_left",
    "orders_without_activity",
    "precision_curve",
    "daily_facts_valid",
    "ml_prepared",
    "row_change",
    "operational_age",
    "log_status_throughout",
    "baseline_score",
    "gain_curve",
    "roc_auc",
    "periodic_work_left",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", str(os.cpu_count()))
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    names = sys.argv[1:] or HEADLINES
    spark = build_session(
        "bench",
        f"local[{cpus}]",
        spark__sql__shuffle__partitions=cpus,
        spark__driver__memory="16g",
        spark__ui__enabled="false",
        spark__ui__showConsoleProgress="false",
    )
    spark.sparkContext.setLogLevel("ERROR")
    queries = all_queries()
    seconds = {}
    for name in names:
        spent = []
        for _ in range(runs + 1):
            started = time.perf_counter()
            queries[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            spent.append(time.perf_counter() - started)
        seconds[name] = round(statistics.median(spent[1:]), 3)
    print(
        json.dumps(
            {
                "metric": "headline queries, sum of medians",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
                "cpus": int(cpus),
                "runs": runs,
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
