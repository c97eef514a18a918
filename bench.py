"""Benchmark: median seconds per headline query, printed as one JSON line.

BENCH_SF_DIR, BENCH_CPUS and BENCH_REPEATS set the data folder, the cores and
the timed runs after one warm-up. Building the plan counts as part of a query.
"""

from __future__ import annotations

import json
import os
import statistics
import time

from featuremart.catalogue import all_queries
from featuremart.session import local_session

HEADLINE = (
    # month slots and matrices
    "pay_month_slots", "pay_block", "traffic_unit_slots", "equipment_matrix", "interest_matrix", "contact_pivot",
    # snapshots, latest rows, identities
    "snapshot_open_orders", "latest_order", "dual_identity", "contract_enrich", "home_work_moves",
    # requests and services
    "complaint_guard", "complaint_rollup", "fixed_services", "fixed_equipment",
    # labels, cohorts, samples, quality
    "churn_labels", "holdout_anti", "cohort_rank", "row_cap", "negative_sample", "lift_table", "column_profile",
    # sinks
    "partition_replace", "parquet_export",
    # whole marts
    "fixed_mart", "mobile_mart", "training_split",
)


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cores = int(os.environ.get("BENCH_CPUS", "8"))
    repeats = int(os.environ.get("BENCH_REPEATS", "3"))
    spark = local_session(cores)
    spark.sparkContext.setLogLevel("ERROR")
    queries = all_queries()
    seconds = {}
    for name in HEADLINE:
        runs = []
        for _ in range(repeats + 1):
            start = time.perf_counter()
            queries[name](spark, folder).write.format("noop").mode("overwrite").save()
            runs.append(time.perf_counter() - start)
        seconds[name] = round(statistics.median(runs[1:]), 3)
    spark.stop()
    scale = os.path.basename(folder.rstrip("/")).removeprefix("sf")
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": float(scale) if scale.replace(".", "", 1).isdigit() else scale,
            }
        )
    )


if __name__ == "__main__":
    main()
