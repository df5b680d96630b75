"""Declared schemas of the text inputs, so that no reader needs an inference pass."""

ZONES = "LocationID string, Borough string, Zone string"
REVIEW = "review_id string, user_id string, business_id string, date date"
BUSINESS = "business_id string, name string, city string"
USER = "user_id string"

# Measures of one stage; times in milliseconds, sizes in bytes.
STAGE_TIMES = (
    "stageDuration",
    "executorRunTime",
    "executorCpuTime",
    "executorDeserializeTime",
    "executorDeserializeCpuTime",
    "resultSerializationTime",
    "jvmGCTime",
    "shuffleFetchWaitTime",
    "shuffleWriteTime",
)
STAGE_SIZES = (
    "resultSize",
    "diskBytesSpilled",
    "memoryBytesSpilled",
    "peakExecutionMemory",
    "bytesRead",
    "bytesWritten",
    "shuffleTotalBytesRead",
    "shuffleLocalBytesRead",
    "shuffleRemoteBytesRead",
    "shuffleRemoteBytesReadToDisk",
    "shuffleBytesWritten",
)
STAGE_COUNTS = ("recordsRead", "recordsWritten")

STAGE_METRICS = ", ".join(f"{name} bigint" for name in ("jobId", "stageId", *STAGE_TIMES, *STAGE_SIZES, *STAGE_COUNTS))
APP_METRICS = ", ".join(
    f"{name} bigint"
    for name in (
        "numStages",
        "numTasks",
        "elapsedTime",
        "executorRunTime",
        "executorCpuTime",
        "jvmGCTime",
        "peakExecutionMemory",
        "shuffleTotalBytesRead",
        "shuffleBytesWritten",
        "recordsRead",
        "bytesRead",
        "recordsWritten",
        "bytesWritten",
    )
)

# The parts of Spark's public event-log JSON that the metric jobs read; everything else is skipped while parsing.
EVENT_LOG = """
    `Event` string,
    `Job ID` bigint,
    `Stage IDs` array<bigint>,
    `Properties` struct<`spark.job.tags`: string>,
    `Stage ID` bigint,
    `Stage Attempt ID` bigint,
    `Stage Info` struct<
        `Stage ID`: bigint, `Stage Attempt ID`: bigint, `Submission Time`: bigint, `Completion Time`: bigint>,
    `Task Info` struct<`Index`: bigint, `Attempt`: bigint, `Launch Time`: bigint, `Finish Time`: bigint>,
    `Task Metrics` struct<
        `Executor Run Time`: bigint, `Executor CPU Time`: bigint,
        `Executor Deserialize Time`: bigint, `Executor Deserialize CPU Time`: bigint,
        `Result Serialization Time`: bigint, `JVM GC Time`: bigint, `Result Size`: bigint,
        `Memory Bytes Spilled`: bigint, `Disk Bytes Spilled`: bigint, `Peak Execution Memory`: bigint,
        `Input Metrics`: struct<`Bytes Read`: bigint, `Records Read`: bigint>,
        `Output Metrics`: struct<`Bytes Written`: bigint, `Records Written`: bigint>,
        `Shuffle Read Metrics`: struct<
            `Fetch Wait Time`: bigint, `Local Bytes Read`: bigint, `Remote Bytes Read`: bigint,
            `Remote Bytes Read To Disk`: bigint>,
        `Shuffle Write Metrics`: struct<`Shuffle Bytes Written`: bigint, `Shuffle Write Time`: bigint>>
"""
