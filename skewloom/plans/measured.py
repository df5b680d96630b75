"""The metric job: event logs -> task, stage and application tables -> diagnosis and report files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..operators.diagnosis import diagnose_stages, skewed_stages, stage_report, summarize_app, summary_report
from ..operators.event_log import app_metrics, app_task_metrics, stage_metrics, tag_metrics, task_metrics, task_sketches
from ..sources.readers import read_event_log
from ..sources.sinks import write_json, write_sorted, write_tsv

# Order of the written metric tables.
STAGE_ORDER = ("jobId", "stageId")
TASK_ORDER = ("jobId", "stageId", "index")


def write_report(stages: DataFrame, apps: DataFrame, target: str) -> dict[str, str]:
    """The two parts of the report as tab-separated tables: summary rows, then stages from the most severe on."""
    paths = {"summary": f"{target.rstrip('/')}/summary", "stages": f"{target.rstrip('/')}/stages"}
    write_tsv(summary_report(summarize_app(apps, "app_id"), "app_id"), paths["summary"])
    write_tsv(stage_report(diagnose_stages(stages), "app_id"), paths["stages"])
    return paths


def write_metrics(
    spark: SparkSession,
    log: str,
    target: str,
    tasks: bool = False,
    since: int | None = None,
    until: int | None = None,
    parts: bool = False,
) -> list[str]:
    """Everything the metric job writes for the applications whose logs match `log`; returns the paths.

    `since` and `until` (epoch milliseconds) measure one part of a program: stages submitted and tasks launched in between.
    `parts` adds the totals of each part that `session.measured` marked, and which stages are skewed by their tasks.
    """
    target = target.rstrip("/")
    lines = read_event_log(spark, log)
    raw = f"{target}/stages"
    # Stage rows feed three outputs, so they are made once and read back.
    stage_metrics(lines, since, until).write.mode("overwrite").parquet(raw)
    stages = spark.read.parquet(raw)
    write_sorted(stages, f"{target}/stagemetrics", ("app_id", *STAGE_ORDER), "json")
    write_json(app_metrics(stages), f"{target}/stagemetrics_agg")
    report = write_report(stages, app_metrics(stages), f"{target}/report")
    paths = [raw, f"{target}/stagemetrics", f"{target}/stagemetrics_agg", *report.values()]
    if tasks:
        raw_tasks = f"{target}/tasks"
        task_metrics(lines, since, until).write.mode("overwrite").parquet(raw_tasks)
        stored = spark.read.parquet(raw_tasks)
        write_sorted(stored, f"{target}/taskmetrics", ("app_id", *TASK_ORDER), "json")
        write_json(app_task_metrics(stored), f"{target}/taskmetrics_agg")
        paths += [raw_tasks, f"{target}/taskmetrics", f"{target}/taskmetrics_agg"]
    if parts:
        write_json(tag_metrics(lines, since, until), f"{target}/parts")
        write_json(skewed_stages(task_sketches(lines)), f"{target}/skewed_stages")
        paths += [f"{target}/parts", f"{target}/skewed_stages"]
    return paths
