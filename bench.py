"""Time the headline queries; prints one JSON line.

BENCH_SF_DIR and BENCH_CPUS choose input and cores. Jobs that write (batch, load, stream)
run once, as a user would run them; queries run once to warm up and then three times.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import SparkSession  # noqa: E402

from checks import catalog  # noqa: E402

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
REPEATS = int(os.environ.get("BENCH_REPEATS", "3"))

# label -> job that fills the shared folder; later queries read what it wrote
JOBS = {
    "job_write_jsonl": catalog.raw_folder,
    "job_batch": catalog.batch_events,
    "job_warehouse_load": catalog.loaded_warehouse,
    "job_stream": catalog.consumed_stream,
}

HEADLINE = [
    "validation_errors",
    "validation_error_counts",
    "enrich",
    "symbol_summary",
    "run_metrics",
    "stream_route",
    "typed_events",
    "flag_distribution",
    "option_type_summary",
    "top_unusual_contracts_report",
    "symbol_daily_summary",
    "unique_contracts",
    "unusual_activity_rows",
    "symbol_activity",
    "unusual_count_by_symbol",
    "flag_distribution_fact",
    "call_put_activity",
    "call_put_unusual",
    "avg_iv_by_symbol",
    "intraday_unusual",
    "top_unusual_contracts",
    "highest_ratio",
    "top_symbols_by_volume",
]


def timed(action) -> float:
    start = time.perf_counter()
    action()
    return time.perf_counter() - start


def main() -> None:
    spark = (
        SparkSession.builder.master(f"local[{CPUS}]")
        .appName("tapewatch-bench")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "16g")
        .config("spark.sql.shuffle.partitions", CPUS)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="bench-"))
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    seconds: dict[str, float] = {}
    for name, job in JOBS.items():
        seconds[name] = timed(lambda job=job: job(spark, SF_DIR))
    for name in HEADLINE:
        build = catalog.QUERIES[name]

        def run(build=build) -> None:
            build(spark, SF_DIR).write.format("noop").mode("overwrite").save()

        run()
        seconds[name] = statistics.median(timed(run) for _ in range(REPEATS))
    spark.stop()
    queries = {name: round(value, 4) for name, value in seconds.items()}
    result = {
        "metric": "total seconds over headline queries",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": queries,
        "sf": SF_DIR,
        "cpus": int(CPUS),
    }
    print(json.dumps(result))


if __name__ == "__main__":
    main()
