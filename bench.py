"""Benchmark of the headline queries.

Runs each query at $BENCH_SF_DIR (default /root/testdata/sf0.1) on
local[$BENCH_CPUS]: one query to warm the JVM, then per query one warm-up run (which also writes the raw-file and
change-log fixtures once), then the median of 3 timed runs, each result
materialized with a ``noop`` write. Prints one JSON line.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = [
    "daily_summary", "monthly_summary", "annual_summary", "temp_anomaly",
    "semi_join_stations", "month_distribution", "temp_trend", "precip_year_over_year",
    "src_observations_csv", "reject_report", "daily_job", "stream_ingest", "annual_refresh",
    "validate_messages", "message_batch_status",
    "asof_timestamp", "asof_latest", "version_diff", "expire_older_than",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    keys = [k for k in os.environ.get("BENCH_QUERIES", ",".join(HEADLINE)).split(",") if k]

    from stationlake.plans.registry import REGISTRY
    from stationlake.session import get_session

    spark = get_session(f"local[{cpus}]", shuffle_partitions=int(cpus) * 2)
    REGISTRY["annual_summary"](spark, sf_dir).write.format("noop").mode("overwrite").save()  # so that the first key is not the one that warms the JVM
    times: dict[str, float] = {}
    errors: dict[str, str] = {}
    for k in keys:
        fn = REGISTRY[k]
        try:
            fn(spark, sf_dir).write.format("noop").mode("overwrite").save()  # warm-up
            samples = []
            for _ in range(runs):
                t0 = time.perf_counter()
                fn(spark, sf_dir).write.format("noop").mode("overwrite").save()
                samples.append(time.perf_counter() - t0)
            times[k] = round(statistics.median(samples), 3)
        except Exception as e:  # noqa: BLE001 - report and keep measuring the rest
            errors[k] = str(e).splitlines()[0][:300]
    sf = os.path.basename(sf_dir).replace("sf", "")
    out = {"metric": "sum_of_median_query_seconds", "value": round(sum(times.values()), 3),
           "unit": "sec", "queries": times, "sf": float(sf) if sf else sf, "cpus": int(cpus)}
    if errors:
        out["errors"] = errors
    print(json.dumps(out))
    spark.stop()


if __name__ == "__main__":
    main()
