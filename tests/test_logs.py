import datetime as dt
import time

import pytest
from pyspark.sql import functions as F

from skewloom.operators.logs import parse_logs
from skewloom.sources.readers import read_lines
from skewloom.streaming.logs import DAILY, LATE, UNMATCHED, read_once, stream_lines, stream_logs, write_once

LAUNCH = "2024-06-06T12:00:00,123 [main] INFO  a.b.C [] - Asked to launch executor app-1/0 for elt-rides"
ERROR = "2024-06-06T12:00:01,000 [main] ERROR a.b.C [] - boom"
NOISE = "noise"


def parse(spark, *lines, **options):
    df = spark.createDataFrame([(line,) for line in lines], "value string").coalesce(1)
    return parse_logs(df, **options).collect()


def test_fields(spark):
    launch, error, noise = parse(spark, LAUNCH, ERROR, NOISE)
    assert launch.asDict() == {
        "value": LAUNCH,
        "matched": True,
        "timestamp": "2024-06-06T12:00:00,123",
        "thread": "main",
        "loglevel": "INFO",
        "class": "a.b.C",
        "component": "",
        "log_message": "Asked to launch executor app-1/0 for elt-rides",
        "event_time": dt.datetime(2024, 6, 6, 12, 0, 0, 123000),
        "spark_app_name": "elt",
        "day": "2024.06.06",
    }
    assert (error.loglevel, error.log_message, error.spark_app_name) == ("ERROR", "boom", None)
    assert noise.value == NOISE and not noise.matched
    assert all(noise[c] is None for c in noise.asDict() if c not in ("value", "matched"))


def test_brackets_end_thread_and_component(spark):
    rows = parse(spark, "2024-06-06T12:00:00,000 [a] b] INFO  C [] - x", "2024-06-06T12:00:00,000 [a] INFO  C [b]] - x")
    assert not any(r.matched for r in rows)


def test_long_lines_of_repeated_headers_take_linear_time(spark):
    head = "2024-06-06T12:00:00,123 [x] INFO  a.b [y "
    lines = spark.createDataFrame([(head * 2500,), (LAUNCH,)], "value string").coalesce(1)
    parse_logs(lines).collect()
    start = time.perf_counter()
    assert sorted(r.matched for r in parse_logs(lines).collect()) == [False, True]
    assert time.perf_counter() - start < 5  # with Spark's own time; the old pattern took minutes


def test_exactly_two_spaces_take_only_short_levels(spark):
    assert [r.matched for r in parse(spark, LAUNCH, ERROR, spaces="  ")] == [True, False]


def test_odd_lines(spark):
    rows = parse(
        spark,
        "2024-06-06 12:00:00.5 [a [b] WARN  C [x [y] - - [z] - end",
        "prefix 2024-06-06T12:00:00,000 [t] DEBUG a$b.C [] - ",
        "2024-06-06T12:00:00,000+02:00 [t] INFO  a.C [] - zoned",
        "2024-06-06T12:00:00Z [t] INFO  a.C [] - zulu",
        "2024-13-06T12:00:00,000 [t] INFO  a.C [] - no such month",
        "2024-06-06T12:00:00,000 [t] LOUD  a.C [] - no such level",
        "2024-06-06T12:00:00,000 [t] INFO  a.C [] - line break",
        "2024-06-06T12:00:00,000 [t\x01u] INFO  a.C [] - separator inside",
        "2024-06-06T12:00:00,000 [t] INFO  a.C [] - separator \x01 in message",
        "\x01\x01\x01\x01\x01",
        "",
    )
    assert [r.matched for r in rows] == [True, False, True, True, True, False, True, False, True, False, False]
    assert (rows[0].thread, rows[0].component, rows[0].log_message) == ("a [b", "x [y", "- [z] - end")
    assert rows[0].event_time == dt.datetime(2024, 6, 6, 12, 0, 0, 500000)
    (debug,) = parse(spark, rows[1].value.removeprefix("prefix "))
    assert (debug.loglevel, debug["class"], debug.log_message) == ("DEBUG", "a$b.C", "")
    assert rows[2].event_time == dt.datetime(2024, 6, 6, 10) and rows[3].event_time == dt.datetime(2024, 6, 6, 12)
    assert rows[4].event_time is None and rows[4].day is None
    assert rows[6].log_message == "line break"
    assert rows[8].log_message == "separator \x01 in message"


def test_time_does_not_depend_on_the_session_zone(spark, settings):
    settings("spark.sql.session.timeZone", "America/New_York")
    gap = "2024-03-10T02:30:00,000 [t] INFO  a.C [] - an hour that New York skipped"
    (local,) = parse(spark, gap)
    (zoned,) = parse(spark, gap.replace(",000 ", ",000Z "))
    assert local.event_time == zoned.event_time == dt.datetime(2024, 3, 10, 2, 30)
    assert local.day == "2024.03.10"


def test_launch_message_without_a_name(spark):
    rows = parse(
        spark,
        "2024-06-06T12:00:00,000 [t] INFO  a.C [] - Asked to launch executor",
        "2024-06-06T12:00:00,000 [t] INFO  a.C [] - He Asked to launch executor a/b/12 for my_app now",
    )
    assert [r.spark_app_name for r in rows] == [None, "my_app"]


def test_expression_runs_once(spark, plan):
    text = plan(parse_logs(spark.createDataFrame([(LAUNCH,)], "value string")))
    assert text.count("Asked") and text.count(r"\A(") == 1


def test_stream_equals_batch(spark, tmp_path, same_rows):
    source, target = tmp_path / "in", tmp_path / "out"
    source.mkdir()
    (source / "a.log").write_text(f"{LAUNCH}\n{NOISE}\n")
    (source / "b.log").write_text(f"{ERROR}\n{ERROR.replace('06-06', '06-07')}\n")

    def run():
        stream_logs(spark, str(source), str(target), str(tmp_path / "progress"), files_per_batch=1).awaitTermination()
        return spark.read.parquet(str(target)).withColumn("day", F.col("day").cast("string"))

    same_rows(run(), parse_logs(read_lines(spark, str(source))))
    assert {p.name for p in target.glob("day=*")} == {
        "day=2024.06.06",
        "day=2024.06.07",
        "day=__HIVE_DEFAULT_PARTITION__",
    }
    (source / "c.log").write_text(f"{LAUNCH}\n")
    same_rows(run(), parse_logs(read_lines(spark, str(source))))


def line(hour, message, second=0):
    return f"2024-06-06T{hour:02}:00:{second:02},000 [main] INFO  a.b.C [] - {message}"


@pytest.fixture
def deliver(spark, tmp_path):
    """Write lines as a new file, run the stream once, and return the messages of each sink so far."""
    source, target = tmp_path / "in", tmp_path / "out"
    source.mkdir()

    def run(*lines, name=None):
        (source / f"{name or len(list(source.iterdir()))}.log").write_text("".join(f"{x}\n" for x in lines))
        write_once(stream_lines(spark, str(source)), str(target), str(tmp_path / "progress")).awaitTermination()
        found = {}
        for sink in (DAILY, LATE, UNMATCHED):
            rows = read_once(spark, str(target), sink).collect()
            found[sink] = sorted(r.value if sink == UNMATCHED else r.log_message for r in rows)
        return found

    return run


def test_lines_delivered_again_late_and_unmatched(deliver):
    assert deliver(line(12, "a"), line(12, "a"), line(9, "b"), NOISE) == {DAILY: ["a", "b"], LATE: [], UNMATCHED: [NOISE]}
    # Again; within the hour before the newest time; earlier than that.
    found = deliver(line(12, "a"), line(11, "c", 1), line(10, "d"), line(13, "e"), NOISE, "other")
    assert found == {DAILY: ["a", "b", "c", "e"], LATE: ["d"], UNMATCHED: [NOISE, "other"]}
    assert deliver(line(11, "f"), line(10, "d"))[LATE] == ["d", "f"]


def test_a_batch_that_runs_again_replaces_its_rows(spark, tmp_path, deliver):
    deliver(line(12, "a"), NOISE)
    newest = max((tmp_path / "progress" / "commits").glob("[0-9]*"), key=lambda p: int(p.name))
    for path in (newest, newest.with_name(f".{newest.name}.crc")):
        path.unlink(missing_ok=True)  # as if the driver had died before the batch was marked as done
    found = deliver(line(14, "b"))
    assert found == {DAILY: ["a", "b"], LATE: [], UNMATCHED: [NOISE]}


def test_followed_log_equals_batch(spark, tmp_path, same_rows):
    source, target = tmp_path / "in", tmp_path / "out"
    source.mkdir()
    live = source / "live.log"
    for text in (f"{LAUNCH}\n{NOISE}\n{ERROR}", "\n", f"{ERROR}\n{LAUNCH}\n"):
        with open(live, "a") as file:
            file.write(text)
        stream_logs(spark, str(source), str(target), str(tmp_path / "progress"), follow=True).awaitTermination()
    stored = spark.read.parquet(str(target)).withColumn("day", F.col("day").cast("string")).drop("file", "offset")
    same_rows(stored, parse_logs(read_lines(spark, str(source))))
