"""The log parser as a stream: log lines in, daily partitions out."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators.logs import parse_logs
from ..sources.sinks import replace_partitions
from ..sources.tail import tail_lines

DAILY, UNMATCHED, LATE, NEWEST = "daily", "unmatched", "late", "newest"


def stream_lines(spark: SparkSession, folder: str, files_per_batch: int | None = None) -> DataFrame:
    """Lines of the files in `folder`, oldest first. New files are picked up; `tail_lines` also sees lines added to old ones."""
    reader = spark.readStream
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.text(folder)


def _trigger(writer, interval: str | None):
    return writer.trigger(processingTime=interval) if interval else writer.trigger(availableNow=True)


def write_daily(parsed: DataFrame, target: str, checkpoint: str, interval: str | None = None) -> StreamingQuery:
    """Start the daily sink: at each `interval`, or once over all that is there."""
    writer = parsed.writeStream.format("parquet").partitionBy("day").option("checkpointLocation", checkpoint)
    return _trigger(writer, interval).outputMode("append").start(target)


def stream_logs(
    spark: SparkSession,
    folder: str,
    target: str,
    checkpoint: str,
    interval: str | None = None,
    files_per_batch: int | None = None,
    follow: bool = False,
) -> StreamingQuery:
    """Parse the log files in `folder` into daily partitions. `follow`: also lines added to files, with `file` and `offset`."""
    lines = tail_lines(spark, folder) if follow else stream_lines(spark, folder, files_per_batch)
    return write_daily(parse_logs(lines), target, checkpoint, interval)


def write_once(
    lines: DataFrame,
    target: str,
    checkpoint: str,
    keys: tuple[str, ...] = ("value",),
    again_within: str = "1 day",
    late_after: str = "1 hour",
    interval: str | None = None,
) -> StreamingQuery:
    """Start three sinks below `target` for lines that may be delivered more than once.

    A line whose `keys` came before, less than `again_within` ago, is dropped: Spark keeps the keys of that time as state,
    with a watermark on the time of arrival, against which no line is ever late, so nothing is lost there. What is left goes
    to `daily`, by day; to `late`, if its own time lies more than `late_after` before the newest time of all earlier
    batches; or to `unmatched`, if it has no time. Tables are partitioned by batch too, and a batch that runs again replaces
    its own partitions.
    """
    arrived = lines.withColumn("arrived", F.current_timestamp()).withWatermark("arrived", again_within)
    parsed = parse_logs(arrived.dropDuplicatesWithinWatermark(list(keys)))
    target = target.rstrip("/")

    def write(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        batch = batch.withColumn("batch", F.lit(number)).persist()
        try:
            newest = batch.agg(F.max("event_time").alias("newest")).withColumn("batch", F.lit(number).cast("long"))
            replace_partitions(newest, f"{target}/{NEWEST}", ["batch"], rebalance=False)
            earlier = spark.read.schema("newest timestamp_ntz, batch long").parquet(f"{target}/{NEWEST}").filter(F.col("batch") < number)
            since = earlier.agg((F.max("newest") - F.expr(f"INTERVAL '{late_after}'")).alias("since")).scalar()
            late = F.coalesce(F.col("event_time") < since, F.lit(False))
            timed = F.col("event_time").isNotNull()
            for name, chosen, by in (
                (DAILY, timed & ~late, ["day", "batch"]),
                (LATE, timed & late, ["day", "batch"]),
                (UNMATCHED, ~timed, ["batch"]),
            ):
                replace_partitions(batch.filter(chosen), f"{target}/{name}", by)
        finally:
            batch.unpersist()

    writer = parsed.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
    return _trigger(writer, interval).start()


def read_once(spark: SparkSession, target: str, sink: str, columns: str = "value string") -> DataFrame:
    """One of the tables of `write_once`, DAILY, LATE or UNMATCHED, also while it has no rows. `columns`: those of the lines."""
    lines = spark.createDataFrame([], f"{columns}, arrived timestamp, batch int")
    return spark.read.schema(parse_logs(lines).schema).parquet(f"{target.rstrip('/')}/{sink}")
