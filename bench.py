"""Time the headline queries and print one JSON line.

Each query is written to the no-op sink, so all columns of all rows are computed. The
figure per query is the faster of two runs after one session-wide warm-up.
"""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time

from hourweave.plans import catalog
from hourweave.session import build_session

HEADLINE = (
    "scan_parquet_pruned", "hourly_mean", "constraint_hourly", "outer_join_three", "left_join_globals", "unified_features",
    "pivot_load", "load_zones_wide", "chrono_split", "chrono_split_2way", "hash_sample", "lag_features", "lag_features_calendar",
    "rolling_stats", "sequence_windows", "time_gaps", "duplicate_keys", "null_profile", "describe_numeric", "spread_quantiles",
    "validation_report", "target_encode_apply", "prepared_dataset", "batch_scores", "regression_metrics", "classification_metrics",
    "quantile_metrics", "ensemble_predict", "gbt_regression", "stream_hourly_mean",
)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "2"))
    chosen = sys.argv[1:] or HEADLINE
    spark = build_session(
        "bench", f"local[{cpus}]", spark__sql__shuffle__partitions=cpus, spark__ui__enabled="false",
        spark__ui__showConsoleProgress="false", spark__driver__memory=os.environ.get("BENCH_MEMORY", "8g"),
        spark__checkpoint__dir=os.environ.get("BENCH_SHARED_DIR") or tempfile.mkdtemp(prefix="bench-shared-"),
    )
    spark.sparkContext.setLogLevel("ERROR")
    queries = catalog.queries()
    queries["unified_features"](spark, sf_dir).write.format("noop").mode("overwrite").save()
    seconds = {}
    for name in chosen:
        best = float("inf")
        for _ in range(runs):
            start = time.perf_counter()
            queries[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            best = min(best, time.perf_counter() - start)
        seconds[name] = round(best, 3)
    spark.stop()
    print(json.dumps({
        "metric": "headline_queries_total", "value": round(sum(seconds.values()), 3), "unit": "sec", "queries": seconds,
        "sf": os.path.basename(os.path.normpath(sf_dir)).removeprefix("sf"),
    }))


if __name__ == "__main__":
    main()
