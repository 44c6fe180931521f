"""Times the headline queries and prints one JSON line."""

from __future__ import annotations

import json
import os
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from pyspark.sql import SparkSession  # noqa: E402

HEADLINE = (
    "build_features", "clean_meter", "grid_align", "resample_mean_last", "asof_join", "asof_join_merge", "rolling_std",
    "interpolate_time", "validate_meter", "gap_count", "drift_ks", "feature_drift", "chrono_split", "score_requests",
    "recommendations", "error_metrics", "adwin_events", "stream_tumbling", "pipeline_features", "rolling_default",
)


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    names = sys.argv[1:] or HEADLINE
    builder = (
        SparkSession.builder.master(f"local[{cpus}]").appName("bench")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", os.environ.get("BENCH_MEMORY", "16g"))
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    from slotwise.plans.queries import QUERIES

    QUERIES["build_features"](spark, folder).write.format("noop").mode("overwrite").save()
    seconds = {}
    for name in names:
        best = float("inf")
        for _ in range(2):
            start = time.perf_counter()
            QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
            best = min(best, time.perf_counter() - start)
        seconds[name] = round(best, 3)
    total = round(sum(seconds.values()), 3)
    print(json.dumps({
        "metric": "headline_queries_total", "value": total, "unit": "sec", "queries": seconds,
        "sf": Path(folder).name.removeprefix("sf"), "cpus": int(cpus),
    }))
    spark.stop()


if __name__ == "__main__":
    main()
