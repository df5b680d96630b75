"""Time the headline queries; prints one JSON line.

BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8), BENCH_RUNS (default 2) and BENCH_ONLY (a comma-
separated list of names) choose what is run. Each query runs once to warm up, then its median time counts. A query is
timed as a whole: building its plan, jobs it runs itself, and computing all of its rows, which go to the noop sink.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

from pyspark.sql import SparkSession

from skewloom.operators.event_log import stage_metrics, task_metrics
from skewloom.plans import mapping, rides
from skewloom.plans.queries import QUERIES
from skewloom.session import scratch_path
from skewloom.sources.readers import read_event_log

HEADLINE = (
    "rides_enriched",
    "rides_narrow",
    "rides_ordered_top",
    "route_totals",
    "route_totals_from_trips",
    "company_totals",
    "route_totals_dated",
    "company_totals_dated",
    "code_map_keep",
    "code_map_pandas",
    "code_map_udf",
    "reviews_business_plain",
    "reviews_business_broadcast",
    "reviews_business_users",
    "reviews_business_users_copartitioned",
    "skewed_table",
    "skew_report",
    "skew_filter_join",
    "salted_join",
    "salted_join_hot_business",
    "json_roundtrip",
    "partitioned_append",
    "clustered_write",
    "log_parse",
    "stage_diagnosis",
)


def _job(name: str, table: str):
    """One table of a ride job, to compare ways of coding the same result."""

    def query(spark, folder):
        job = rides.RIDE_JOBS[name]
        return job.tables(mapping.trips(spark, folder), mapping.zones(spark, folder))[table]

    return query


VARIANTS = {
    "company_totals_row_udf": _job("row_udf", "hvfhs_license_num"),
    "company_totals_vectorised_udf": _job("vectorised_udf", "hvfhs_license_num"),
    "company_totals_native": _job("native", "hvfhs_license_num"),
    "rides_sorted": _job("sorted_overwrite", "rides"),
}


def _from_log(metrics):
    """Metrics from event-log text that is written before the clock starts."""
    logs = {}

    def query(spark, folder):
        return metrics(read_event_log(spark, logs[folder]))

    def prepare(spark, folder):
        logs[folder] = scratch_path(spark, "event-log")
        lines = mapping.event_lines(spark, folder).select("value")
        lines.repartition(spark.sparkContext.defaultParallelism).write.text(logs[folder])

    query.prepare = prepare
    return query


FROM_LOG = {
    "event_log_stage_metrics": _from_log(stage_metrics),
    "event_log_task_metrics": _from_log(task_metrics),
}


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "2"))
    only = set(filter(None, os.environ.get("BENCH_ONLY", "").split(",")))
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("bench")
        .config("spark.driver.memory", "16g")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    queries = {**{name: QUERIES[name] for name in HEADLINE}, **VARIANTS, **FROM_LOG}
    times = {}
    for name, query in queries.items():
        if only and name not in only:
            continue
        getattr(query, "prepare", lambda *_: None)(spark, folder)
        laps = []
        for _ in range(runs + 1):
            start = time.perf_counter()
            query(spark, folder).write.format("noop").mode("overwrite").save()
            laps.append(time.perf_counter() - start)
        times[name] = round(statistics.median(laps[1:]), 3)
        print(f"{name}: {times[name]}", file=sys.stderr, flush=True)
    spark.stop()
    result = {
        "metric": "total median query time",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"),
    }
    print(json.dumps(result))


if __name__ == "__main__":
    main()
