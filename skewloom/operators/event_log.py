"""Task, stage and application metrics from Spark event logs.

Input everywhere: lines (app_id, value) as `sources.read_event_log` gives them, for one application or for many.
Times are in milliseconds, sizes in bytes.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..sources.schemas import EVENT_LOG

TASK_END = "SparkListenerTaskEnd"
STAGE_COMPLETED = "SparkListenerStageCompleted"
JOB_START = "SparkListenerJobStart"

# Where each measure of a task stands in its event. Nanoseconds become milliseconds.
TASK_FIELDS = {
    "executorRunTime": "Executor Run Time",
    "executorCpuTime": "Executor CPU Time",
    "executorDeserializeTime": "Executor Deserialize Time",
    "executorDeserializeCpuTime": "Executor Deserialize CPU Time",
    "resultSerializationTime": "Result Serialization Time",
    "jvmGCTime": "JVM GC Time",
    "resultSize": "Result Size",
    "memoryBytesSpilled": "Memory Bytes Spilled",
    "diskBytesSpilled": "Disk Bytes Spilled",
    "peakExecutionMemory": "Peak Execution Memory",
    "recordsRead": "Input Metrics.Records Read",
    "bytesRead": "Input Metrics.Bytes Read",
    "recordsWritten": "Output Metrics.Records Written",
    "bytesWritten": "Output Metrics.Bytes Written",
    "shuffleFetchWaitTime": "Shuffle Read Metrics.Fetch Wait Time",
    "shuffleLocalBytesRead": "Shuffle Read Metrics.Local Bytes Read",
    "shuffleRemoteBytesRead": "Shuffle Read Metrics.Remote Bytes Read",
    "shuffleRemoteBytesReadToDisk": "Shuffle Read Metrics.Remote Bytes Read To Disk",
    "shuffleBytesWritten": "Shuffle Write Metrics.Shuffle Bytes Written",
    "shuffleWriteTime": "Shuffle Write Metrics.Shuffle Write Time",
}
NANOSECONDS = ("executorCpuTime", "executorDeserializeCpuTime", "shuffleWriteTime")
PEAK = "peakExecutionMemory"
SKETCH_SIZE = 4096
TOTAL_READ = "shuffleTotalBytesRead"
MEASURES = (*TASK_FIELDS, TOTAL_READ)


def parse_events(lines: DataFrame, *kinds: str) -> DataFrame:
    """Events of some kinds.

    A line that does not hold the kind's name anywhere is dropped before any JSON is parsed; the parsed kind then
    decides. `inline` keeps later conditions above the parser; pushed below it they would parse each line a second time.
    A line that was cut off while being written gives no event.
    """
    wanted = reduce(or_, [F.col("value").contains(f'"{kind}"') for kind in kinds])
    parsed = lines.filter(wanted).select("app_id", F.inline(F.array(F.from_json("value", EVENT_LOG))))
    return parsed.filter(F.col("Event").isin(*kinds))


def _measures() -> dict[str, Column]:
    columns = {}
    for name, place in TASK_FIELDS.items():
        field = F.col("`Task Metrics`." + ".".join(f"`{part}`" for part in place.split(".")))
        columns[name] = F.floor(field / 1_000_000) if name in NANOSECONDS else field
    columns[TOTAL_READ] = columns["shuffleLocalBytesRead"] + columns["shuffleRemoteBytesRead"]
    return columns


def task_metrics(lines: DataFrame, since: int | None = None, until: int | None = None) -> DataFrame:
    """One row per finished task attempt, with the job of its stage.

    `since` and `until` (epoch milliseconds) keep the tasks launched in between. Nothing is stored: the text is scanned once for
    the tasks and once more for the few job starts, and only those lines are parsed. Later jobs name a stage again when they
    reuse its output, so the first job counts. A sum of two columns is not carried through the join but made after it.
    """
    tasks = parse_events(lines, TASK_END).select(
        "app_id",
        F.col("Stage ID").alias("stageId"),
        F.col("Stage Attempt ID").alias("stageAttempt"),
        F.col("Task Info.Index").alias("index"),
        F.col("Task Info.Attempt").alias("attempt"),
        F.col("Task Info.Launch Time").alias("launchTime"),
        (F.col("Task Info.Finish Time") - F.col("Task Info.Launch Time")).alias("duration"),
        *[value.alias(name) for name, value in _measures().items() if name != TOTAL_READ],
    )
    starts = parse_events(lines, JOB_START).select("app_id", F.col("Job ID").alias("jobId"), F.explode("Stage IDs").alias("stageId"))
    jobs = starts.groupBy("app_id", "stageId").agg(F.min("jobId").alias("jobId"))
    joined = _between(tasks, "launchTime", since, until).join(jobs, ["app_id", "stageId"], "left")
    total = F.col("shuffleLocalBytesRead") + F.col("shuffleRemoteBytesRead")
    return joined.select(*tasks.columns, total.alias(TOTAL_READ), "jobId")


def task_sketches(lines: DataFrame, size: int = SKETCH_SIZE) -> DataFrame:
    """(app_id, stageId, tasks, times, bytes): of each stage the quantile sketches of its tasks' times and shuffle bytes read.

    A sketch takes a few kilobytes however many tasks it has seen, and is exact up to `size` of them. Sketches can be stored,
    and those of many applications merged later; see `merge_sketches`.
    """
    tasks = parse_events(lines, TASK_END).select(
        "app_id",
        F.col("Stage ID").alias("stageId"),
        (F.col("Task Info.Finish Time") - F.col("Task Info.Launch Time")).alias("duration"),
        F.coalesce(_measures()[TOTAL_READ], F.lit(0)).alias("bytes"),
    )
    return tasks.groupBy("app_id", "stageId").agg(
        F.count("duration").alias("tasks"),
        F.kll_sketch_agg_bigint("duration", F.lit(size)).alias("times"),
        F.kll_sketch_agg_bigint("bytes", F.lit(size)).alias("bytes"),
    )


def merge_sketches(sketches: DataFrame, *by: str, size: int = SKETCH_SIZE) -> DataFrame:
    """`task_sketches` merged per `by`, such as the stage alone over all applications that ran it."""
    return sketches.groupBy(*by).agg(
        F.sum("tasks").alias("tasks"),
        F.kll_merge_agg_bigint("times", size).alias("times"),
        F.kll_merge_agg_bigint("bytes", size).alias("bytes"),
    )


def _between(rows: DataFrame, time: str, since: int | None, until: int | None) -> DataFrame:
    if since is not None:
        rows = rows.filter(F.col(time) >= since)
    if until is not None:
        rows = rows.filter(F.col(time) <= until)
    return rows


def stage_metrics(lines: DataFrame, since: int | None = None, until: int | None = None, tags: bool = False) -> DataFrame:
    """One row per completed stage attempt, with its tasks' sums and the highest peak memory of a task.

    `since` and `until` (epoch milliseconds) keep the stages submitted in between, to measure one part of a program. With
    `tags`, `tags` is an array of the tags of the job that ran the stage; see `session.measured`.
    """
    events = parse_events(lines, TASK_END, STAGE_COMPLETED, JOB_START)
    # Tasks, stage ends and job starts meet in one grouping, so the log is read and parsed once. A job start stands for the
    # first attempt of each stage it names; tags are grouped by. The least job of a stage as a struct with its tags would make
    # Spark sort all events instead of hashing them.
    starts = F.col("Event") == JOB_START
    by = ["app_id", "stageId", "stageAttempt", *(["tags"] if tags else [])]
    rows = events.select(
        "app_id",
        F.when(F.col("Event") == TASK_END, 1).alias("task"),
        F.col("Job ID").alias("job"),
        *([F.when(starts, F.coalesce("Properties.`spark.job.tags`", F.lit(""))).alias("tags")] if tags else []),
        F.col("Stage Info.Submission Time").alias("submitted"),
        F.col("Stage Info.Completion Time").alias("completed"),
        F.coalesce("Stage Attempt ID", "Stage Info.Stage Attempt ID", F.when(starts, 0)).alias("stageAttempt"),
        *[value.alias(name) for name, value in _measures().items()],
        F.explode(F.coalesce("Stage IDs", F.array(F.coalesce("Stage ID", "Stage Info.Stage ID")))).alias("stageId"),
    )
    stages = rows.groupBy(*by).agg(
        F.min("job").alias("job"),
        F.max("submitted").alias("submissionTime"),
        F.max("completed").alias("completionTime"),
        F.count("task").alias("numTasks"),
        *[(F.max(name) if name == PEAK else F.sum(name)).alias(name) for name in MEASURES],
    )
    # The few rows of one stage: its attempts and its jobs, of which the first ran it.
    same_stage = Window.partitionBy("app_id", "stageId")
    ran = F.when(F.col("job").isNotNull(), F.struct("job", "tags")) if tags else F.col("job")
    stages = stages.withColumn("job", F.min(ran).over(same_stage)).filter(F.col("completionTime").isNotNull())
    named = F.filter(F.split(F.coalesce("job.tags", F.lit("")), ","), lambda tag: tag != "") if tags else None
    stages = stages.select(
        "app_id",
        "stageId",
        "stageAttempt",
        "submissionTime",
        "completionTime",
        (F.col("completionTime") - F.col("submissionTime")).alias("stageDuration"),
        "numTasks",
        *MEASURES,
        F.col("job.job" if tags else "job").alias("jobId"),
        *([F.array_distinct(named).alias("tags")] if tags else []),
    )
    return _between(stages, "submissionTime", since, until)


def app_metrics(stages: DataFrame, by: Sequence[str] = ("app_id",)) -> DataFrame:
    """One row per application: counts, first submission to last completion, sums, highest peak memory."""
    return stages.groupBy(*by).agg(
        F.count(F.lit(1)).alias("numStages"),
        F.sum("numTasks").alias("numTasks"),
        (F.max("completionTime") - F.min("submissionTime")).alias("elapsedTime"),
        F.sum("stageDuration").alias("stageDuration"),
        *[(F.max(name) if name == PEAK else F.sum(name)).alias(name) for name in MEASURES],
    )


def tag_metrics(lines: DataFrame, since: int | None = None, until: int | None = None) -> DataFrame:
    """`app_metrics` per application and tag: what a part of a program took, whatever else ran at the same time.

    A stage counts for each tag of the job that ran it; stages of jobs without a tag are left out.
    """
    stages = stage_metrics(lines, since, until, tags=True)
    return app_metrics(stages.withColumn("tag", F.explode("tags")), ("app_id", "tag"))


def app_task_metrics(tasks: DataFrame) -> DataFrame:
    """One row per application from its tasks."""
    return tasks.groupBy("app_id").agg(
        F.count(F.lit(1)).alias("numTasks"),
        (F.max(F.col("launchTime") + F.col("duration")) - F.min("launchTime")).alias("elapsedTime"),
        F.sum("duration").alias("duration"),
        *[(F.max(name) if name == PEAK else F.sum(name)).alias(name) for name in MEASURES],
    )


def app_report(apps: DataFrame) -> DataFrame:
    """Application metrics in long form: (app_id, metric, value)."""
    names = [c for c in apps.columns if c != "app_id"]
    return apps.unpivot("app_id", names, "metric", "value")


def memory_report(stages: DataFrame) -> DataFrame:
    """Peak execution memory per stage, largest first."""
    return stages.select("app_id", "jobId", "stageId", PEAK).orderBy(F.col(PEAK).desc(), "app_id", "stageId")
