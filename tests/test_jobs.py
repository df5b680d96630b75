import datetime as dt

import pytest
from pyspark.sql import functions as F

from skewloom.jobs import parser, run_job
from skewloom.plans import mapping


@pytest.fixture
def run(spark):
    def call(*argv):
        args = parser().parse_args([str(a) for a in argv])
        args.run(spark, args)

    return call


@pytest.fixture(scope="module")
def data(spark, folder, tmp_path_factory):
    root = tmp_path_factory.mktemp("data")
    mapping.trips(spark, folder).write.parquet(f"{root}/trips")
    mapping.zones(spark, folder).coalesce(1).write.option("header", True).csv(f"{root}/zones")
    mapping.reviews(spark, folder).write.parquet(f"{root}/reviews")
    mapping.business(spark, folder).write.parquet(f"{root}/business")
    mapping.users(spark, folder).write.parquet(f"{root}/users")
    return root


def test_rides(run, data, tmp_path, spark):
    run("rides", "--trips", data / "trips", "--zones", data / "zones", "--out", tmp_path, "--day", "2024-06-06")
    assert spark.read.parquet(f"{tmp_path}/rides").count() == spark.read.parquet(f"{data}/trips").count()


def test_rides_shown(run, data, capsys):
    run("rides", "--trips", data / "trips", "--zones", data / "zones", "--job", "row_udf", "--count")
    assert capsys.readouterr().out.count("rows: ") == 2


@pytest.mark.parametrize("extra", [[], ["--copartitioned"], ["--copartitioned", "--partitions", "4"]])
def test_reviews(run, data, spark, capsys, extra):
    sides = ["--reviews", data / "reviews", "--business", data / "business", "--users", data / "users"]
    run("reviews", *sides, "--count", *extra)
    assert f"rows: {spark.read.parquet(f'{data}/reviews').count()}" in capsys.readouterr().out


def test_skew(run, data, tmp_path, spark, capsys):
    rows = spark.read.parquet(f"{data}/reviews").count()
    skewed = tmp_path / "skewed"
    run("make-skew", "--reviews", data / "reviews", "--out", skewed, "--day", "2024-06-06")
    assert f"rows: {6 * rows}" in capsys.readouterr().out
    for extra in ([], ["--salted"], ["--salted", "--partitions", "2"]):
        sides = ["--reviews", skewed, "--business", data / "business", "--day", "2024-06-06"]
        run("skew", *sides, "--count", *extra)
        assert f"rows: {5 * rows}" in capsys.readouterr().out
    run("skew", "--reviews", skewed, "--report")
    assert str(5 * rows) in capsys.readouterr().out


def test_skew_day_defaults_to_today(run, data, tmp_path, spark):
    run("make-skew", "--reviews", data / "reviews", "--out", tmp_path / "s", "--factor", "1")
    days = spark.read.parquet(f"{tmp_path}/s").filter(F.col("date") >= dt.date(2020, 1, 1))
    assert days.select("date").distinct().count() == 1


def test_convert_metrics_logs_files(run, data, tmp_path, spark, log_dir, capsys):
    spark.read.parquet(f"{data}/users").write.json(f"{tmp_path}/json/user")
    run("convert", "--source", tmp_path / "json", "--out", tmp_path / "parquet", "--entities", "user")
    assert spark.read.parquet(f"{tmp_path}/parquet/user").count() == spark.read.parquet(f"{data}/users").count()
    run("metrics", "--log", f"{log_dir}/*", "--out", tmp_path / "metrics", "--tasks")
    assert "taskmetrics_agg" in capsys.readouterr().out
    logs = tmp_path / "log"
    logs.mkdir()
    (logs / "a.log").write_text("2024-06-06T12:00:00,123 [main] INFO  a.B [] - hello\n")
    run("logs", "--source", logs, "--out", tmp_path / "batch")
    run("logs", "--source", logs, "--out", tmp_path / "stream", "--progress", tmp_path / "progress")
    assert spark.read.parquet(f"{tmp_path}/batch").count() == spark.read.parquet(f"{tmp_path}/stream").count() == 1
    run("files", "--source", f"{logs}/*.log")
    assert "a.log" in capsys.readouterr().out


def test_followed_logs_each_line_once(run, tmp_path, spark):
    logs = tmp_path / "log"
    logs.mkdir()
    for text in ("2024-06-06T12:00:00,123 [main] INFO  a.B [] - hello\n", "2024-06-06T12:00:01,000 [main] INFO  a.B [] - again\nnoise\n"):
        with open(logs / "a.log", "a") as file:
            file.write(text)
        run("logs", "--source", logs, "--out", tmp_path / "out", "--progress", tmp_path / "progress", "--follow")
        run("logs", "--source", logs, "--out", tmp_path / "once", "--progress", tmp_path / "once-progress", "--follow", "--once")
    assert spark.read.parquet(f"{tmp_path}/out").count() == 3
    assert spark.read.parquet(f"{tmp_path}/once/daily").count() == 2
    assert spark.read.parquet(f"{tmp_path}/once/unmatched").count() == 1


def test_totals_kept_up_to_date(run, data, tmp_path, capsys):
    options = ("--trips", f"{data}/trips/*.parquet", "--zones", data / "zones", "--state", tmp_path / "state", "--count")
    run("totals", *options)
    first = capsys.readouterr().out
    run("totals", *options, "--daily")
    second = capsys.readouterr().out
    assert "files: 0" not in first and "files: 0" in second and "rows: " in second


def test_tagged_run_in_the_metrics(run, data, tmp_path, spark, log_dir):
    run_job(spark, parser().parse_args(["--tag", "nightly", "skew", "--reviews", str(data / "reviews"), "--report", "--count"]))
    spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty(30_000)
    run("metrics", "--log", f"{log_dir}/*", "--out", tmp_path / "metrics", "--parts")
    assert {r.tag for r in spark.read.json(f"{tmp_path}/metrics/parts").collect()} >= {"nightly"}
    assert "is_time_skew" in spark.read.json(f"{tmp_path}/metrics/skewed_stages").columns
