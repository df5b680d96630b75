"""Session factory, tuning profiles and the shared scratch folder."""

from __future__ import annotations

import contextlib
import uuid
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession

# The tuning settings offered to users, by profile name.
PROFILES: dict[str, dict[str, str]] = {
    "adaptive": {
        "spark.sql.adaptive.enabled": "true",
        "spark.executor.memory": "3g",
    },
    "fixed_partitions": {
        "spark.sql.adaptive.enabled": "true",
        "spark.executor.memory": "3g",
        "spark.sql.shuffle.partitions": "50",
        "spark.default.parallelism": "50",
        "spark.sql.files.maxPartitionBytes": "67108864",
    },
    "tight_memory": {
        "spark.sql.adaptive.enabled": "false",
        "spark.executor.memory": "2g",
        "spark.executor.memoryOverhead": "512m",
        "spark.sql.shuffle.partitions": "200",
        "spark.memory.fraction": "0.6",
    },
}

# What Delta tables need.
DELTA_CONF = {
    "spark.sql.extensions": "io.delta.sql.DeltaSparkSessionExtension",
    "spark.sql.catalog.spark_catalog": "org.apache.spark.sql.delta.catalog.DeltaCatalog",
}


def event_log_conf(folder: str) -> dict[str, str]:
    """Settings for an event log that `sources.read_event_log` can read: one plain JSON file per application."""
    return {
        "spark.eventLog.enabled": "true",
        "spark.eventLog.dir": folder,
        "spark.eventLog.compress": "false",
        "spark.eventLog.rolling.enabled": "false",
    }


def build_session(
    app_name: str,
    profile: str = "adaptive",
    conf: dict[str, str] | None = None,
    delta: bool = False,
    hive: bool = False,
    event_log: str | None = None,
) -> SparkSession:
    """A session with one tuning profile; `conf` wins over the profile.

    `delta` needs the Delta jars on the class path. Object-store credentials belong in `conf` or spark-defaults.
    """
    settings = {
        "spark.sql.session.timeZone": "UTC",
        **PROFILES[profile],
        **(DELTA_CONF if delta else {}),
        **(event_log_conf(event_log) if event_log else {}),
        **(conf or {}),
    }
    builder = SparkSession.builder.appName(app_name)
    for key, value in settings.items():
        builder = builder.config(key, value)
    if hive:
        builder = builder.enableHiveSupport()
    return builder.getOrCreate()


@contextlib.contextmanager
def measured(spark: SparkSession, tag: str) -> Iterator[None]:
    """Mark a part of a program: the jobs that this thread starts inside carry `tag` in the event log.

    Parts may nest, and parts of several threads may overlap in time; `event_log.tag_metrics` tells them apart. A tag holds
    no comma.
    """
    context = spark.sparkContext
    outer = tag in context.getJobTags()
    context.addJobTag(tag)
    try:
        yield
    finally:
        if not outer:
            context.removeJobTag(tag)


@contextlib.contextmanager
def setting(spark: SparkSession, key: str, value: str) -> Iterator[None]:
    """A session option for what runs inside."""
    before = spark.conf.get(key, None)
    spark.conf.set(key, value)
    try:
        yield
    finally:
        spark.conf.unset(key) if before is None else spark.conf.set(key, before)


def scratch_path(spark: SparkSession, label: str) -> str:
    """A new path for a written table, in the shared folder named by spark.checkpoint.dir.

    Only a local master may do without that setting, and then uses a folder in its warehouse; executors on other
    machines would not see it.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.conf.get("spark.master", "").startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        root = f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/scratch"
    return f"{root.rstrip('/')}/{label}-{uuid.uuid4().hex}"


def store(df: DataFrame, label: str) -> DataFrame:
    """Run `df` once into a scratch table and read it back: later uses cost a scan and see the same rows."""
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def small_frame(df: DataFrame, limit: int) -> DataFrame:
    """`df` computed once and held in the plan. For frames that cannot have more than `limit` rows; more is an error."""
    rows = df.limit(limit + 1).collect()
    if len(rows) > limit:
        raise ValueError(f"more than {limit} rows")
    return df.sparkSession.createDataFrame(rows, df.schema)
