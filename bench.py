"""Times the headline queries and prints one JSON line."""

from __future__ import annotations

import json
import os
import statistics
import sys
import tempfile
import time

from countlake.plans.catalog import QUERIES
from countlake.session import build_session

HEADLINE = [
    "daily_metrics",
    "rolling_metrics",
    "monthly_visitors",
    "clean_readings",
    "closest_match",
    "rejects",
    "agency_daily_rollup",
    "agency_hourly_total",
    "traffic_view",
    "band_breaches",
    "relative_alerts",
    "merge_daily",
    "merge_daily_table",
    "expected_traffic",
    "missing_hours",
    "stable_bucket",
    "footfall_with_branch",
    "ingest_json",
    "scan_raw_readings",
    "transform_run",
    "stream_ingest",
    "stream_daily",
    "stream_late_readings",
    "stream_rolling",
    "merge_daily_snapshot",
    "closest_match_large",
    "missing_spans",
    "reading_lookup_stored",
    "readings_with_agency_asof",
]


RUNS = 3
#: A query that takes longer is run once.
LONG = 4.0


def run(spark, name: str, sf_dir: str) -> float:
    start = time.perf_counter()
    QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def middle(spark, name: str, sf_dir: str) -> float:
    """The median of some runs, in seconds."""
    first = run(spark, name, sf_dir)
    if first > LONG:
        return first
    return statistics.median([first, *(run(spark, name, sf_dir) for _ in range(RUNS - 1))])


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session(
        "countlake-bench",
        master=f"local[{cpus}]",
        conf={
            "spark.sql.shuffle.partitions": cpus,
            "spark.driver.memory": os.environ.get("BENCH_MEMORY", "8g"),
            "spark.checkpoint.dir": tempfile.mkdtemp(prefix="countlake-bench-"),
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    run(spark, "daily_metrics", sf_dir)  # start executors and compile once
    names = sys.argv[1:] or HEADLINE
    seconds = {name: round(middle(spark, name, sf_dir), 3) for name in names}
    result = {
        "metric": "headline_queries_total",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "sf": os.path.basename(sf_dir.rstrip("/")),
    }
    print(json.dumps(result))
    spark.stop()


if __name__ == "__main__":
    main()
