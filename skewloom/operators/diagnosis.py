"""Bottleneck diagnosis on stage and application metric tables."""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..sources.schemas import STAGE_SIZES, STAGE_TIMES

# Limits above which a stage is slow (milliseconds), by cause.
SLOW_LIMITS = {
    "executor_run_time": {"executorRunTime": 100_000},
    "gc_time": {"jvmGCTime": 5_000},
    "shuffle_time": {"shuffleFetchWaitTime": 1_000, "shuffleWriteTime": 1_000},
}

# Flags by name, each (measures that are added, limit, measure or constant the limit is a share of).
FLAGS = {
    "is_cpu_bound": (("executorCpuTime",), 0.8, "executorRunTime"),
    "is_memory_bound": (("jvmGCTime",), 0.1, "executorRunTime"),
    "is_network_bound": (("shuffleFetchWaitTime", "shuffleWriteTime"), 0.5, "stageDuration"),
    "is_spill": (("diskBytesSpilled", "memoryBytesSpilled"), 0, None),
    "is_skew": (("executorDeserializeTime",), 0.2, "executorRunTime"),
    "is_shuffle": (("shuffleFetchWaitTime", "shuffleWriteTime"), 1_000, None),
    "is_serialization": (("resultSerializationTime",), 0.1, "stageDuration"),
    "is_storage": (("peakExecutionMemory",), 1024 * 1024 * 1024, None),
}

# Severity order of stages, and the columns of the stage report by heading.
SEVERITY = ("executorRunTime", "jvmGCTime", "shuffleFetchWaitTime", "shuffleWriteTime")
REPORT_COLUMNS = {
    "Stage ID": "stageId",
    "Stage Duration (ms)": "stageDuration",
    "Executor Run Time (ms)": "executorRunTime",
    "Executor CPU Time (ms)": "executorCpuTime",
    "JVM GC Time (ms)": "jvmGCTime",
    "Shuffle Fetch Wait Time (ms)": "shuffleFetchWaitTime",
    "Shuffle Write Time (ms)": "shuffleWriteTime",
    "Peak Execution Memory (bytes)": "peakExecutionMemory",
    "Records Read": "recordsRead",
    "Bytes Read (bytes)": "bytesRead",
    "Records Written": "recordsWritten",
    "Bytes Written (bytes)": "bytesWritten",
    "CPU Bound": "is_cpu_bound",
    "Memory Bound": "is_memory_bound",
    "Network Bound": "is_network_bound",
    "Spill": "is_spill",
    "Skew": "is_skew",
    "Shuffle": "is_shuffle",
    "Serialization": "is_serialization",
    "Storage": "is_storage",
}

# The summary of an application by heading, each (measure, divisor).
SUMMARY = {
    "numStages": ("numStages", None),
    "numTasks": ("numTasks", None),
    "elapsedTime (seconds)": ("elapsedTime", 1_000),
    "elapsedTime (minutes)": ("elapsedTime", 60_000),
    "executorRunTime (seconds)": ("executorRunTime", 1_000),
    "executorRunTime (minutes)": ("executorRunTime", 60_000),
    "executorCpuTime (seconds)": ("executorCpuTime", 1_000),
    "executorCpuTime (minutes)": ("executorCpuTime", 60_000),
    "jvmGCTime (seconds)": ("jvmGCTime", 1_000),
    "jvmGCTime (minutes)": ("jvmGCTime", 60_000),
    "peakExecutionMemory (MBs)": ("peakExecutionMemory", 1024 * 1024),
    "shuffleTotalBytesRead (MBs)": ("shuffleTotalBytesRead", 1024 * 1024),
    "shuffleBytesWritten (MBs)": ("shuffleBytesWritten", 1024 * 1024),
    "recordsRead": ("recordsRead", None),
    "bytesRead (MBs)": ("bytesRead", 1024 * 1024),
    "recordsWritten": ("recordsWritten", None),
    "bytesWritten (MBs)": ("bytesWritten", 1024 * 1024),
}


def skewed_stages(
    sketches: DataFrame, share: float = 0.95, limit: float = 3.0, least_time: int = 1_000, least_bytes: int = 16 * 1024 * 1024
) -> DataFrame:
    """Which stages are skewed, from the sketches of `event_log.task_sketches` or `merge_sketches`.

    A stage is skewed in time or in bytes if the quantile `share` of its tasks is more than `limit` times their median, and
    reaches `least_time` milliseconds or `least_bytes`. This is the spread of the tasks themselves; the flag `is_skew` of
    `diagnose_stages` compares two sums.
    """
    names = {"times": ("median_time", "high_time", "is_time_skew", least_time), "bytes": ("median_bytes", "high_bytes", "is_byte_skew", least_bytes)}
    found = sketches
    for sketch, (median, high, flag, least) in names.items():
        found = found.withColumn(median, F.kll_sketch_get_quantile_bigint(sketch, F.lit(0.5)))
        found = found.withColumn(high, F.kll_sketch_get_quantile_bigint(sketch, F.lit(share)))
        found = found.withColumn(flag, (F.col(high) > limit * F.col(median)) & (F.col(high) >= least))
    return found.drop(*names)


def _flag(measures: tuple[str, ...], limit: float, of: str | None) -> Column:
    """measures / of > limit, written as a product: of = 0 counts as exceeded unless the measures are 0 too."""
    amount = sum((F.col(m) for m in measures[1:]), F.col(measures[0]))
    bound = F.lit(limit) if of is None else F.col(of) * limit
    return F.coalesce(amount > bound, F.lit(False))


def diagnose_stages(stages: DataFrame) -> DataFrame:
    """Add the flags, the times in minutes and the sizes in megabytes. A flag over a missing measure is false.

    `is_skew` compares deserialization time with run time; the name is kept for its users.
    """
    return stages.select(
        "*",
        *[_flag(*rule).alias(name) for name, rule in FLAGS.items()],
        *[(F.col(c) / 60_000).alias(f"{c}_minutes") for c in STAGE_TIMES],
        *[(F.col(c) / (1024 * 1024)).alias(f"{c}_MBs") for c in STAGE_SIZES],
    )


def worst_first(stages: DataFrame, *ties: str) -> DataFrame:
    """Most severe stages first, missing measures last."""
    return stages.orderBy(*[F.col(c).desc_nulls_last() for c in SEVERITY], *ties)


def slow_stages(stages: DataFrame, *keys: str) -> DataFrame:
    """One row (keys, stageId, cause) for each limit group a stage exceeds; a missing measure counts as 0."""
    causes = []
    for cause, limits in SLOW_LIMITS.items():
        tests = [F.coalesce(F.col(c), F.lit(0)) > limit for c, limit in limits.items()]
        causes.append(F.when(reduce(or_, tests), F.lit(cause)))
    return stages.select(*keys, "stageId", F.explode(F.array_compact(F.array(*causes))).alias("cause"))


def summarize_app(apps: DataFrame, *keys: str) -> DataFrame:
    """Counts as they are, times in seconds and minutes, sizes in megabytes; a missing measure counts as 0."""
    columns = []
    for heading, (measure, divisor) in SUMMARY.items():
        value = F.coalesce(F.col(measure), F.lit(0))
        columns.append((value if divisor is None else value / divisor).alias(heading))
    return apps.select(*keys, *columns)


def stage_report(diagnosed: DataFrame, *keys: str) -> DataFrame:
    """The twenty report columns under their headings, most severe stage first."""
    ordered = worst_first(diagnosed, *keys, "stageId")
    return ordered.select(*keys, *[F.col(c).alias(heading) for heading, c in REPORT_COLUMNS.items()])


def summary_report(summary: DataFrame, *keys: str) -> DataFrame:
    """The summary as rows (keys, metric, value)."""
    values = [F.col(f"`{c}`").cast("double").alias(c) for c in summary.columns if c not in keys]
    wide = summary.select(*keys, *values)
    return wide.unpivot(list(keys), [f"`{c}`" for c in wide.columns if c not in keys], "metric", "value")
