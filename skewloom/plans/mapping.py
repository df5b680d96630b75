"""The given tables in the roles of trips, zones, reviews, log lines and metrics."""

from __future__ import annotations

import os
import sys
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext, cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.event_log import JOB_START, STAGE_COMPLETED, TASK_END
from ..sources.schemas import STAGE_COUNTS, STAGE_SIZES, STAGE_TIMES
from ..sources.tail import open_store

cloudpickle.register_pickle_by_value(sys.modules[__name__])

# Order priorities stand for license codes; two of the five are left out so that unlisted codes occur.
PRIORITY_NAMES = {"1-URGENT": "Urgent", "2-HIGH": "High", "3-MEDIUM": "Medium"}


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def trips(spark: SparkSession, folder: str) -> DataFrame:
    """Line items as trips from the supplier's nation to the customer's.

    Orders meet their customers before the line items do, so the largest table is shuffled as few times as possible.
    """
    orders = table(spark, folder, "orders").select("o_orderkey", "o_custkey", "o_orderdate", "o_orderpriority")
    customers = table(spark, folder, "customer").select("c_custkey", "c_nationkey")
    suppliers = table(spark, folder, "supplier").select("s_suppkey", "s_nationkey")
    requests = orders.join(customers, F.col("o_custkey") == F.col("c_custkey"))
    items = table(spark, folder, "lineitem").join(suppliers, F.col("l_suppkey") == F.col("s_suppkey"))
    return items.join(requests, F.col("l_orderkey") == F.col("o_orderkey")).select(
        F.col("o_orderpriority").alias("hvfhs_license_num"),
        F.col("s_nationkey").cast("bigint").alias("PULocationID"),
        F.col("c_nationkey").cast("bigint").alias("DOLocationID"),
        F.col("o_orderdate").alias("request_datetime"),
        F.col("o_orderdate").alias("pickup_datetime"),
        F.col("l_shipdate").alias("dropoff_datetime"),
        F.col("l_quantity").alias("trip_miles"),
        F.col("l_linenumber").cast("bigint").alias("trip_time"),
        F.col("l_extendedprice").alias("base_passenger_fare"),
        F.col("l_tax").alias("tolls"),
        F.col("l_discount").alias("bcf"),
        F.col("l_tax").alias("sales_tax"),
        F.col("l_discount").alias("congestion_surcharge"),
        (F.col("l_tax") + F.col("l_discount")).alias("tips"),
        (F.col("l_extendedprice") * (1 - F.col("l_discount"))).alias("driver_pay"),
        F.col("l_returnflag").alias("shared_request_flag"),
        F.col("l_linestatus").alias("shared_match_flag"),
    )


def zones(spark: SparkSession, folder: str) -> DataFrame:
    """Nations as zones; the key is text, as in a zone file read without a schema."""
    nations, regions = table(spark, folder, "nation"), table(spark, folder, "region")
    return nations.join(regions, F.col("n_regionkey") == F.col("r_regionkey")).select(
        F.col("n_nationkey").cast("string").alias("LocationID"),
        F.col("r_name").alias("Borough"),
        F.col("n_name").alias("Zone"),
    )


def reviews(spark: SparkSession, folder: str) -> DataFrame:
    """Line items as a customer's reviews of a part."""
    orders = table(spark, folder, "orders").select("o_orderkey", "o_custkey")
    items = table(spark, folder, "lineitem")
    return items.join(orders, F.col("l_orderkey") == F.col("o_orderkey")).select(
        F.concat_ws("-", "l_orderkey", "l_linenumber").alias("review_id"),
        F.col("o_custkey").alias("user_id"),
        F.col("l_partkey").alias("business_id"),
        F.col("l_shipdate").cast("date").alias("date"),
    )


def business(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "part").select(
        F.col("p_partkey").alias("business_id"), F.col("p_name").alias("name"), F.col("p_brand").alias("city")
    )


def users(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "customer").select(
        F.col("c_custkey").alias("user_id"), F.col("c_name").alias("name"), F.col("c_mktsegment").alias("segment")
    )


def log_lines(spark: SparkSession, folder: str) -> DataFrame:
    """Events written as log lines (value): purchases as launch messages, views as text without the layout."""
    level = (
        F.when(F.col("event_type") == "error", "ERROR")
        .when(F.col("event_type") == "click", "WARN ")
        .otherwise("INFO ")
    )
    launch = F.concat(
        F.lit("Asked to launch executor app-"), F.col("event_id"), F.lit("/"), F.col("user_id"),
        F.lit(" for job"), F.col("user_id"), F.lit("-nightly"),
    )
    message = F.when(F.col("event_type") == "purchase", launch).otherwise(F.col("props"))
    # Formatted by way of text, which unlike date_format does not pass through the session's time zone.
    clock = F.col("ts").cast("string")
    stamp = F.concat(F.translate(clock.substr(1, 19), " ", "T"), F.lit(","), F.rpad(clock.substr(21, 3), 3, "0"))
    line = F.concat(
        stamp, F.lit(" [task-"), F.col("user_id"), F.lit("] "), level,
        F.lit(" app."), F.col("event_type"), F.lit(".Handler ["),
        F.when(F.col("event_type") == "signup", "web").otherwise(""), F.lit("] - "), message,
    )
    noise = F.concat(F.lit("    at "), F.col("props"))
    return table(spark, folder, "events").select(F.when(F.col("event_type") == "view", noise).otherwise(line).alias("value"))


def write_log_files(lines: DataFrame, folder: str, share: float, parts: int = 8) -> int:
    """Write the first `share` of the lines of each of `parts` applications to a file of its own, and return their number.

    A larger share later adds lines to the files as they are, as applications do. A task that runs again cuts its file
    to what it held before. `folder` must be mounted on all executors.
    """
    _, path = open_store(folder)

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lines = [v for batch in batches for v in batch.column(0).to_pylist()]
        whole = [f"{line}\n".encode() for line in lines[: round(share * len(lines))]]
        os.makedirs(path, exist_ok=True)
        name = f"{path}/app-{TaskContext.get().partitionId()}.log"
        held = os.path.getsize(name) if os.path.exists(name) else 0
        size, kept = 0, 0
        while kept < len(whole) and size + len(whole[kept]) <= held:
            size += len(whole[kept])
            kept += 1
        if whole:
            with open(name, "r+b" if held else "wb") as file:
                file.seek(size)
                file.truncate()
                file.writelines(whole[kept:])
        yield pa.record_batch({"lines": [len(whole)]})

    dealt = lines.select("value").repartition(parts, "value").sortWithinPartitions("value")
    return dealt.mapInArrow(write, "lines long").agg(F.sum("lines")).first()[0] or 0


def stage_table(spark: SparkSession, folder: str) -> DataFrame:
    """Line items in the shape of a stage metric table, with zero denominators and missing values among them."""
    price = F.floor("l_extendedprice")
    quantity = F.floor("l_quantity")
    line = F.col("l_linenumber").cast("bigint")
    day = F.unix_date(F.col("l_shipdate").cast("date")).cast("bigint")
    measures = {
        "stageDuration": price * line,
        "executorRunTime": F.when(line == 1, F.lit(0).cast("bigint")).otherwise(price * quantity),
        "executorCpuTime": price * (quantity - 3),
        "executorDeserializeTime": price * (line - 1),
        "executorDeserializeCpuTime": price,
        "resultSerializationTime": quantity * quantity,
        "jvmGCTime": F.when(line == 7, None).otherwise(quantity * 110),
        "shuffleFetchWaitTime": day,
        "shuffleWriteTime": F.when(line == 2, None).otherwise(quantity * 21),
        "resultSize": price,
        "diskBytesSpilled": F.when(line > 4, price).otherwise(F.lit(0).cast("bigint")),
        "memoryBytesSpilled": F.when(line > 5, price).otherwise(F.lit(0).cast("bigint")),
        "peakExecutionMemory": price * 30_000,
        "bytesRead": price * 4096,
        "bytesWritten": price * 1024,
        "shuffleTotalBytesRead": price * 300,
        "shuffleLocalBytesRead": price * 100,
        "shuffleRemoteBytesRead": price * 200,
        "shuffleRemoteBytesReadToDisk": price * 50,
        "shuffleBytesWritten": price * 70,
        "recordsRead": quantity,
        "recordsWritten": line,
    }
    return table(spark, folder, "lineitem").select(
        F.col("l_orderkey").alias("jobId"),
        (F.col("l_orderkey") * 10 + line).alias("stageId"),
        *[measures[name].alias(name) for name in (*STAGE_TIMES, *STAGE_SIZES, *STAGE_COUNTS)],
    )


def event_lines(spark: SparkSession, folder: str, tags: bool = False) -> DataFrame:
    """Spark event-log lines (app_id, value): orders as jobs with their stages, line items as the stages' tasks.

    Sixteen applications. Each job names its own stage and the next one, as a job does that reuses shuffle output. With
    `tags`, every second job has one and every third another, all over the same time.
    """
    orders = table(spark, folder, "orders").select(F.col("o_orderkey").alias("key"), F.col("o_totalprice"), "o_orderdate")
    items = table(spark, folder, "lineitem")

    def app(key):
        return F.concat(F.lit("app-"), F.pmod(F.floor(key / 100), F.lit(16)))

    started = F.unix_timestamp("o_orderdate") * 1000
    marks = F.concat_ws(",", F.when(F.col("key") % 2 == 0, "extract"), F.when(F.col("key") % 3 == 0, "load"))
    properties = [F.struct(marks.alias("spark.job.tags")).alias("Properties")] if tags else []
    jobs = orders.select(
        app(F.col("key")).alias("app_id"),
        F.to_json(
            F.struct(
                F.lit(JOB_START).alias("Event"),
                F.col("key").alias("Job ID"),
                started.alias("Submission Time"),
                F.array(F.col("key"), F.col("key") + 1).alias("Stage IDs"),
                *properties,
            )
        ).alias("value"),
    )
    stages = orders.select(
        app(F.col("key")).alias("app_id"),
        F.to_json(
            F.struct(
                F.lit(STAGE_COMPLETED).alias("Event"),
                F.struct(
                    F.col("key").alias("Stage ID"),
                    F.lit(0).alias("Stage Attempt ID"),
                    started.alias("Submission Time"),
                    (started + F.floor("o_totalprice")).alias("Completion Time"),
                ).alias("Stage Info"),
            )
        ).alias("value"),
    )

    price, quantity = F.floor("l_extendedprice"), F.floor("l_quantity")
    line = F.col("l_linenumber").cast("bigint")
    launched = F.unix_timestamp("l_shipdate") * 1000
    tasks = items.select(
        app(F.col("l_orderkey")).alias("app_id"),
        F.to_json(
            F.struct(
                F.lit(TASK_END).alias("Event"),
                F.col("l_orderkey").alias("Stage ID"),
                F.lit(0).alias("Stage Attempt ID"),
                F.struct(
                    line.alias("Index"),
                    F.lit(0).alias("Attempt"),
                    launched.alias("Launch Time"),
                    (launched + quantity).alias("Finish Time"),
                ).alias("Task Info"),
                F.struct(
                    price.alias("Executor Run Time"),
                    (price * 700_001).alias("Executor CPU Time"),
                    line.alias("Executor Deserialize Time"),
                    (line * 900_000).alias("Executor Deserialize CPU Time"),
                    quantity.alias("Result Serialization Time"),
                    (line * 3).alias("JVM GC Time"),
                    (quantity * 11).alias("Result Size"),
                    (price * 13).alias("Memory Bytes Spilled"),
                    (price * 17).alias("Disk Bytes Spilled"),
                    (price * 19).alias("Peak Execution Memory"),
                    F.struct((price * 23).alias("Bytes Read"), quantity.alias("Records Read")).alias("Input Metrics"),
                    F.struct((price * 29).alias("Bytes Written"), line.alias("Records Written")).alias("Output Metrics"),
                    F.struct(
                        (line * 31).alias("Fetch Wait Time"),
                        (price * 37).alias("Local Bytes Read"),
                        (price * 41).alias("Remote Bytes Read"),
                        (price * 43).alias("Remote Bytes Read To Disk"),
                    ).alias("Shuffle Read Metrics"),
                    F.struct(
                        (price * 47).alias("Shuffle Bytes Written"), (price * 530_003).alias("Shuffle Write Time")
                    ).alias("Shuffle Write Metrics"),
                ).alias("Task Metrics"),
            )
        ).alias("value"),
    )
    lines = jobs.unionByName(stages).unionByName(tasks)
    # The generator keeps conditions on a line from being copied below it, where each would format the line again.
    return lines.select("app_id", F.explode(F.array("value")).alias("value"))


def app_table(spark: SparkSession, folder: str) -> DataFrame:
    """`stage_table` added up to sixteen applications."""
    total = {
        "numTasks": "recordsRead",
        "elapsedTime": "stageDuration",
        "executorRunTime": "executorRunTime",
        "executorCpuTime": "executorCpuTime",
        "jvmGCTime": "jvmGCTime",
        "shuffleTotalBytesRead": "shuffleTotalBytesRead",
        "shuffleBytesWritten": "shuffleBytesWritten",
        "recordsRead": "recordsRead",
        "bytesRead": "bytesRead",
        "recordsWritten": "recordsWritten",
        "bytesWritten": "bytesWritten",
    }
    app = F.concat(F.lit("app-"), F.pmod("jobId", F.lit(16)))
    return stage_table(spark, folder).groupBy(app.alias("app_id")).agg(
        F.count(F.lit(1)).alias("numStages"),
        F.max("peakExecutionMemory").alias("peakExecutionMemory"),
        *[F.sum(source).alias(name) for name, source in total.items()],
    )
