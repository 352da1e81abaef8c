"""Time the headline queries; prints one JSON line.

BENCH_SF_DIR, BENCH_CPUS, BENCH_RUNS (best of, default 2) and BENCH_QUERIES
(comma separated) change what is run.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINES = (
    "user_activity", "event_type_counts", "rfm", "user_profile",
    "iqr_bounds_exact", "iqr_bounds_approx", "dedup_rows", "clean_events",
    "scaled_features", "events_with_segment", "events_with_segment_split", "kmeans_segments",
    "active_users", "retention_survivors", "retention_report",
    "month_scan", "raw_copy_roundtrip", "incremental_ingest", "monthly_flow", "flagship",
)


def session(cpus: str):
    from pyspark.sql import SparkSession
    spark = (SparkSession.builder.master(f"local[{cpus}]").appName("bench")
             .config("spark.driver.memory", os.environ.get("BENCH_MEMORY", "8g"))
             .config("spark.sql.shuffle.partitions", cpus)
             .config("spark.sql.session.timeZone", "UTC")
             .config("spark.ui.enabled", "false")
             .config("spark.ui.showConsoleProgress", "false")
             .getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def seconds(query, spark, sf_dir: str) -> float:
    start = time.perf_counter()
    query(spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    runs = int(os.environ.get("BENCH_RUNS", "2"))
    names = [n for n in os.environ.get("BENCH_QUERIES", "").split(",") if n] or HEADLINES
    spark = session(os.environ.get("BENCH_CPUS", "8"))
    from shopmonth.plans.queries import QUERIES
    seconds(QUERIES["clean_events"], spark, sf_dir)
    times = {}
    for name in names:
        times[name] = round(min(seconds(QUERIES[name], spark, sf_dir) for _ in range(runs)), 3)
        print(f"{name}: {times[name]} s", file=sys.stderr)
    print(json.dumps({
        "metric": "headline_queries_total", "value": round(sum(times.values()), 3), "unit": "sec",
        "queries": times, "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
    }))
    spark.stop()


if __name__ == "__main__":
    main()
