from __future__ import annotations

import contextlib
import io
import os

import pytest
from pyspark.sql import SparkSession

from skewloom.session import event_log_conf

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def log_dir(tmp_path_factory):
    return tmp_path_factory.mktemp("event-log")


@pytest.fixture(scope="session")
def spark(tmp_path_factory, log_dir):
    shared = tmp_path_factory.mktemp("shared")
    builder = (
        SparkSession.builder.master("local[8]")
        .appName("tests")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.checkpoint.dir", str(shared))
        .config("spark.sql.warehouse.dir", str(shared / "warehouse"))
    )
    for key, value in event_log_conf(f"file:{log_dir}").items():
        builder = builder.config(key, value)
    session = builder.getOrCreate()
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def folder():
    return SF_DIR


@pytest.fixture
def settings(spark):
    """Set session options for one test."""
    changed = {}

    def change(key, value):
        changed.setdefault(key, spark.conf.get(key, None))
        spark.conf.set(key, value)

    yield change
    for key, value in changed.items():
        spark.conf.unset(key) if value is None else spark.conf.set(key, value)


@pytest.fixture
def plan():
    """The physical plan as text; after an action on the same frame it is the plan that ran."""

    def text(df):
        out = io.StringIO()
        with contextlib.redirect_stdout(out):
            df.explain()
        return out.getvalue()

    return text


@pytest.fixture
def same_rows():
    def check(left, right):
        assert sorted(left.columns) == sorted(right.columns)
        columns = sorted(left.columns)
        assert sorted(map(str, left.select(*columns).collect())) == sorted(map(str, right.select(*columns).collect()))

    return check
