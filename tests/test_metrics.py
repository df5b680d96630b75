import json
import subprocess
import sys
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from skewloom.operators.diagnosis import diagnose_stages, slow_stages, stage_report, summarize_app, worst_first
from skewloom.operators.event_log import (
    app_metrics,
    app_report,
    app_task_metrics,
    memory_report,
    parse_events,
    stage_metrics,
    task_metrics,
)
from skewloom.plans import mapping
from skewloom.plans.measured import write_metrics, write_report
from skewloom.sources import schemas
from skewloom.sources.readers import read_event_log

GIB = 1024 * 1024 * 1024


@pytest.fixture
def stage(spark):
    """A frame of stages from dicts; measures default to zero, None is missing."""

    names = [part.split()[0] for part in schemas.STAGE_METRICS.split(", ")]

    def make(*rows):
        full = [tuple({**dict.fromkeys(names, 0), "stageId": n, **row}[c] for c in names) for n, row in enumerate(rows)]
        return spark.createDataFrame(full, schemas.STAGE_METRICS).coalesce(1)

    return make


@pytest.mark.parametrize(
    "flag, row, expected",
    [
        ("is_cpu_bound", {"executorCpuTime": 80, "executorRunTime": 100}, False),
        ("is_cpu_bound", {"executorCpuTime": 81, "executorRunTime": 100}, True),
        ("is_cpu_bound", {"executorCpuTime": 1, "executorRunTime": 0}, True),
        ("is_cpu_bound", {"executorCpuTime": 0, "executorRunTime": 0}, False),
        ("is_cpu_bound", {"executorCpuTime": None, "executorRunTime": 1}, False),
        ("is_memory_bound", {"jvmGCTime": 10, "executorRunTime": 100}, False),
        ("is_memory_bound", {"jvmGCTime": 11, "executorRunTime": 100}, True),
        ("is_memory_bound", {"jvmGCTime": 5, "executorRunTime": 0}, True),
        ("is_network_bound", {"shuffleFetchWaitTime": 30, "shuffleWriteTime": 20, "stageDuration": 100}, False),
        ("is_network_bound", {"shuffleFetchWaitTime": 30, "shuffleWriteTime": 21, "stageDuration": 100}, True),
        ("is_spill", {}, False),
        ("is_spill", {"memoryBytesSpilled": 1}, True),
        ("is_spill", {"diskBytesSpilled": 1, "memoryBytesSpilled": None}, False),
        ("is_skew", {"executorDeserializeTime": 20, "executorRunTime": 100}, False),
        ("is_skew", {"executorDeserializeTime": 21, "executorRunTime": 100}, True),
        ("is_shuffle", {"shuffleFetchWaitTime": 400, "shuffleWriteTime": 600}, False),
        ("is_shuffle", {"shuffleFetchWaitTime": 401, "shuffleWriteTime": 600}, True),
        ("is_serialization", {"resultSerializationTime": 10, "stageDuration": 100}, False),
        ("is_serialization", {"resultSerializationTime": 11, "stageDuration": 100}, True),
        ("is_storage", {"peakExecutionMemory": GIB}, False),
        ("is_storage", {"peakExecutionMemory": GIB + 1}, True),
    ],
)
def test_flags(stage, flag, row, expected):
    assert diagnose_stages(stage(row)).first()[flag] is expected


def test_units(stage):
    row = diagnose_stages(stage({"stageDuration": 90_000, "bytesRead": 3 * 1024 * 512, "jvmGCTime": None})).first()
    assert row.stageDuration_minutes == 1.5 and row.bytesRead_MBs == 1.5 and row.jvmGCTime_minutes is None


def test_slow_stages(stage):
    rows = slow_stages(
        stage(
            {"executorRunTime": 100_000, "jvmGCTime": 5_000, "shuffleFetchWaitTime": 1_000, "shuffleWriteTime": 1_000},
            {"executorRunTime": 100_001},
            {"jvmGCTime": 5_001, "executorRunTime": None},
            {"shuffleFetchWaitTime": 1_001},
            {"shuffleWriteTime": 1_001, "shuffleFetchWaitTime": None, "executorRunTime": 200_000},
        )
    ).collect()
    assert [tuple(r) for r in rows] == [
        (1, "executor_run_time"),
        (2, "gc_time"),
        (3, "shuffle_time"),
        (4, "executor_run_time"),
        (4, "shuffle_time"),
    ]


def test_worst_first_and_report(stage):
    stages = stage({"executorRunTime": None}, {"executorRunTime": 5}, {"executorRunTime": 9}, {"executorRunTime": 5, "jvmGCTime": 1})
    assert [r.stageId for r in worst_first(stages).collect()] == [2, 3, 1, 0]
    report = stage_report(diagnose_stages(stages))
    assert report.columns[:2] == ["Stage ID", "Stage Duration (ms)"] and len(report.columns) == 20
    assert [r["Stage ID"] for r in report.collect()] == [2, 3, 1, 0]


def test_summary(spark):
    apps = spark.createDataFrame([(3, 90_000, None, 1024 * 1024)], "numStages bigint, elapsedTime bigint, jvmGCTime bigint, bytesRead bigint")
    missing = [c.split()[0] for c in schemas.APP_METRICS.split(", ") if c.split()[0] not in apps.columns]
    row = summarize_app(apps.select("*", *[F.lit(None).cast("bigint").alias(c) for c in missing])).first()
    assert len(row) == 17
    assert (row["numStages"], row["numTasks"]) == (3, 0)
    assert (row["elapsedTime (seconds)"], row["elapsedTime (minutes)"]) == (90.0, 1.5)
    assert (row["jvmGCTime (seconds)"], row["bytesRead (MBs)"]) == (0.0, 1.0)


def line(**event):
    return json.dumps({key.replace("_", " "): value for key, value in event.items()}, separators=(",", ":"))


def task(stage, attempt=0, index=0, **metrics):
    return line(
        Event="SparkListenerTaskEnd",
        Stage_ID=stage,
        Stage_Attempt_ID=attempt,
        Task_Info={"Index": index, "Attempt": 0, "Launch Time": 1_000, "Finish Time": 1_500},
        Task_Metrics={"Executor Run Time": 100, "Peak Execution Memory": 10 * index, **metrics},
    )


def stage_end(stage, attempt=0, start=1_000, end=3_000):
    info = {"Stage ID": stage, "Stage Attempt ID": attempt, "Submission Time": start, "Completion Time": end}
    return line(Event="SparkListenerStageCompleted", Stage_Info=info)


@pytest.fixture
def event_lines(spark):
    lines = [
        line(Event="SparkListenerJobStart", Job_ID=4, Stage_IDs=[7, 8]),
        line(Event="SparkListenerJobStart", Job_ID=5, Stage_IDs=[8, 9]),
        task(7, index=1),
        task(7, index=3, **{"Executor CPU Time": 2_999_999}),
        stage_end(7),
        task(8, attempt=0),
        stage_end(8, attempt=0, start=2_000, end=2_500),
        task(8, attempt=1, index=2),
        task(8, attempt=1, index=1),
        stage_end(8, attempt=1, start=4_000, end=9_000),
        task(9),
        line(Event="SparkListenerLogStart", Note='{"Event":"SparkListenerTaskEnd"'),
        task(7, index=9)[:-20],
    ]
    return spark.createDataFrame([("app-1", text) for text in lines], "app_id string, value string").coalesce(1)


def test_stage_metrics(event_lines):
    rows = {(r.stageId, r.stageAttempt): r for r in stage_metrics(event_lines).collect()}
    assert set(rows) == {(7, 0), (8, 0), (8, 1)}
    first = rows[7, 0]
    assert (first.jobId, first.numTasks, first.executorRunTime, first.stageDuration) == (4, 2, 200, 2_000)
    assert (first.peakExecutionMemory, first.executorCpuTime) == (30, 2)
    assert rows[8, 0].numTasks == 1 and rows[8, 1].numTasks == 2
    assert {r.jobId for r in rows.values()} == {4}


def test_part_of_a_program(event_lines):
    assert [r.stageId for r in stage_metrics(event_lines, since=1_500, until=3_000).collect()] == [8]
    assert stage_metrics(event_lines, since=4_001).count() == 0


def test_task_metrics(event_lines):
    rows = task_metrics(event_lines).collect()
    assert sorted((r.jobId, r.stageId, r.stageAttempt, r["index"]) for r in rows) == [
        (4, 7, 0, 1), (4, 7, 0, 3), (4, 8, 0, 0), (4, 8, 1, 1), (4, 8, 1, 2), (5, 9, 0, 0),
    ]
    assert {r.duration for r in rows} == {500}


def test_tasks_are_joined_without_the_sum(spark):
    """The sum of local and remote bytes is no column of the rows that are shuffled; it is there afterwards, null with either."""
    read = [{"Local Bytes Read": 3, "Remote Bytes Read": 4}, {"Local Bytes Read": 3}, {}]
    lines = [task(7, index=n, **{"Shuffle Read Metrics": metrics}) for n, metrics in enumerate(read)]
    lines.append(line(Event="SparkListenerJobStart", Job_ID=4, Stage_IDs=[7]))
    tasks = task_metrics(spark.createDataFrame([("app-1", text) for text in lines], "app_id string, value string"))
    assert tasks.columns[-2:] == ["shuffleTotalBytesRead", "jobId"]
    rows = sorted(tasks.select("index", "shuffleTotalBytesRead", "jobId").collect())
    assert [tuple(r) for r in rows] == [(0, 7, 4), (1, None, 4), (2, None, 4)]
    above, join, below = tasks.select("shuffleTotalBytesRead", "jobId")._jdf.queryExecution().optimizedPlan().toString().partition("Join LeftOuter")
    assert join and "AS shuffleTotalBytesRead" in above and "shuffleTotalBytesRead" not in below


def test_app_metrics(event_lines):
    stages = stage_metrics(event_lines)
    app = app_metrics(stages).first()
    assert (app.numStages, app.numTasks, app.elapsedTime, app.executorRunTime) == (3, 5, 8_000, 500)
    assert app.peakExecutionMemory == 30
    assert app_task_metrics(task_metrics(event_lines)).first().numTasks == 6
    report = {r.metric: r.value for r in app_report(app_metrics(stages)).collect()}
    assert report["numStages"] == 3 and report["jvmGCTime"] is None
    assert memory_report(stages).first().peakExecutionMemory == 30


def test_log_is_read_once_and_each_line_parsed_once(spark, event_lines, tmp_path, plan):
    event_lines.write.parquet(str(tmp_path / "lines"))
    text = plan(stage_metrics(spark.read.parquet(str(tmp_path / "lines"))))
    assert text.count("FileScan") == 1
    assert text.count("from_json(") == 1
    assert "StringContains" in text


def test_events_are_hashed_with_and_without_tags(spark, event_lines, plan):
    for tags in (False, True):
        text = plan(stage_metrics(event_lines, tags=tags))
        assert "SortAggregate" not in text and "HashAggregate" in text
    named = spark.createDataFrame(
        [("a", line(Event="SparkListenerJobStart", Job_ID=2, Stage_IDs=[1, 3])), ("a", task(1, attempt=1)), ("a", stage_end(1, attempt=1)),
         ("a", line(Event="SparkListenerJobStart", Job_ID=5, Stage_IDs=[1]))],
        "app_id string, value string",
    )
    for tags in (False, True):
        assert [(r.stageId, r.stageAttempt, r.jobId, r.numTasks) for r in stage_metrics(named, tags=tags).collect()] == [(1, 1, 2, 1)]


def test_real_event_log(spark, log_dir, tmp_path):
    spark.range(0, 1_000, 1, 4).groupBy(F.col("id") % 10).count().collect()
    lines = read_event_log(spark, f"{log_dir}/*")
    assert lines.select("app_id").distinct().collect() == [(spark.sparkContext.applicationId,)]
    stages = stage_metrics(lines)
    assert stages.filter("jobId IS NULL").count() == 0
    total = app_metrics(stages).first()
    assert total.numStages > 1 and total.executorRunTime > 0 and total.elapsedTime > 0
    assert stages.agg(F.sum("numTasks")).first()[0] <= task_metrics(lines).count()

    paths = write_metrics(spark, f"{log_dir}/*", str(tmp_path), tasks=True)
    assert all(list(Path(p).glob("part-*")) for p in paths)
    (single,) = Path(tmp_path / "stagemetrics").glob("part-*.json")
    written = [json.loads(text) for text in single.read_text().splitlines()]
    assert [(r["jobId"], r["stageId"]) for r in written] == sorted((r["jobId"], r["stageId"]) for r in written)
    (tasks,) = Path(tmp_path / "taskmetrics").glob("part-*.json")
    order = [(r["jobId"], r["stageId"], r["index"]) for r in map(json.loads, tasks.read_text().splitlines())]
    assert order == sorted(order)


def test_report_files(spark, event_lines, tmp_path):
    stages = stage_metrics(event_lines)
    paths = write_report(stages, app_metrics(stages), str(tmp_path))
    summary = spark.read.option("sep", "\t").option("header", True).csv(paths["summary"])
    assert {r.metric: r.value for r in summary.collect()}["numStages"] == "3.0"
    text = spark.read.option("sep", "\t").option("header", True).csv(paths["stages"])
    assert text.count() == 3 and text.columns[:2] == ["app_id", "Stage ID"]


def test_other_events_are_not_parsed(event_lines):
    assert parse_events(event_lines, "SparkListenerLogStart").count() == 1
    assert parse_events(event_lines, "SparkListenerTaskEnd").count() == 6


def test_parts_of_a_rolled_log_are_one_application(spark, tmp_path):
    """A log that Spark itself has rolled: jobs start in one part, their tasks end in others."""
    program = (
        "import sys; from pyspark.sql import SparkSession as S\n"
        "b = S.builder.master('local[2]').config('spark.ui.enabled', 'false').config('spark.eventLog.enabled', 'true')\n"
        "b = b.config('spark.eventLog.dir', 'file:' + sys.argv[1]).config('spark.eventLog.compress', 'false')\n"
        "b = b.config('spark.eventLog.rolling.enabled', 'true').config('spark.eventLog.rolling.maxFileSize', '10m')\n"
        "b = b.config('spark.eventLog.buffer.kb', '1k')\n"
        "s = b.getOrCreate()\n"
        "for i in range(3): s.range(0, 9000, 1, 900).selectExpr('id % 7 k').groupBy('k').count().collect()\n"
        "s.stop()"
    )
    subprocess.run([sys.executable, "-c", program, str(tmp_path)], check=True, capture_output=True, timeout=300)
    (folder,) = tmp_path.glob("eventlog_v2_*")
    parts = sorted(p.name for p in folder.glob("events_*"))
    lines = read_event_log(spark, f"{tmp_path}/*/*")
    apps = {r.app_id for r in lines.select("app_id").distinct().collect()}
    assert len(parts) > 1 and len(apps) == 1 and next(iter(apps)).startswith("local-")
    tasks = task_metrics(lines)
    assert tasks.count() > 2700 and tasks.filter("jobId IS NULL").count() == 0


def test_windows_of_time(spark, folder):
    lines = mapping.event_lines(spark, folder)
    tasks, stages = task_metrics(lines), stage_metrics(lines)
    cut = tasks.agg(F.percentile_approx("launchTime", 0.5)).first()[0]
    before, after = task_metrics(lines, until=cut).count(), task_metrics(lines, since=cut + 1).count()
    assert before and after and before + after == tasks.count()
    assert stage_metrics(lines, since=cut).filter(F.col("submissionTime") < cut).count() == 0 < stages.count()


def test_events_are_found_whatever_the_order_of_fields(spark):
    line = '{"Timestamp": 1, "Job ID": 3, "Stage IDs": [1],  "Event" : "SparkListenerJobStart"}'
    other = '{"Event":"SparkListenerOther","note":"SparkListenerJobStart"}'
    frame = spark.createDataFrame([("a", line), ("a", other), ("a", line[:-9])], "app_id string, value string")
    assert [r["Job ID"] for r in parse_events(frame, "SparkListenerJobStart").collect()] == [3]
