"""Times the headline queries; prints one JSON line.

BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default: all cores),
BENCH_RUNS (default 2; the best run counts, so compiling code is left out).
Each query is run to completion into the no-op sink, so nothing is collected.
"""

from __future__ import annotations

import json
import os
import sys
import time

ROOT = os.path.dirname(os.path.abspath(__file__))
sys.path.insert(0, ROOT)

from pyspark.sql import SparkSession  # noqa: E402

from playqos.plans.queries import QUERIES  # noqa: E402

HEADLINE = [
    "dedup_reports",
    "buffering_metrics",
    "quality_metrics",
    "qos_summary",
    "viewers_by_buffering",
    "quality_consumption",
    "delivery_split",
    "session_vs_buffering",
    "upsert_replace_quality",
    "stalls",
    "quality_switches",
    "event_batches",
    "landing_accepted",
    "landing_rejected",
    "stream_ingest_both",
    "stream_recompute_quality",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", os.cpu_count() or 8))
    runs = int(os.environ.get("BENCH_RUNS", 2))
    names = [n for n in os.environ.get("BENCH_QUERIES", "").split(",") if n] or HEADLINE
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("playqos-bench")
        .config("spark.sql.shuffle.partitions", str(cpus))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    spark.read.parquet(f"{sf_dir}/events.parquet").write.format("noop").mode("overwrite").save()  # start-up
    seconds = {}
    for name in names:
        took = []
        for _ in range(runs):
            began = time.perf_counter()
            QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            took.append(time.perf_counter() - began)
        seconds[name] = round(min(took), 3)
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
            }
        )
    )


if __name__ == "__main__":
    main()
