"""Tags that tell concurrent work apart, and skew from sketches."""

import threading

import pytest
from pyspark.sql import functions as F

from skewloom.operators.diagnosis import skewed_stages
from skewloom.operators.event_log import merge_sketches, stage_metrics, tag_metrics, task_sketches
from skewloom.plans import mapping
from skewloom.session import measured
from skewloom.sources.readers import read_event_log


def work(spark, rows, tasks):
    spark.range(0, rows, 1, tasks).groupBy(F.col("id") % 3).count().collect()


def test_two_threads_at_the_same_time_are_told_apart(spark, log_dir):
    barrier = threading.Barrier(2)

    def part(tag, tasks):
        with measured(spark, tag):
            for _ in range(3):
                barrier.wait()
                work(spark, 200_000, tasks)

    threads = [threading.Thread(target=part, args=x) for x in (("part-a", 2), ("part-b", 5))]
    for thread in threads:
        thread.start()
    for thread in threads:
        thread.join()
    work(spark, 10, 1)  # without a tag
    spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty(30_000)
    lines = read_event_log(spark, f"{log_dir}/*")
    found = {r.tag: r for r in tag_metrics(lines).filter("tag LIKE 'part-_'").collect()}
    assert set(found) == {"part-a", "part-b"}
    tagged = stage_metrics(lines, tags=True).withColumn("tag", F.explode("tags")).filter("tag LIKE 'part-_'")
    spans = {r.tag: (r.first, r.last) for r in tagged.groupBy("tag").agg(F.min("submissionTime").alias("first"), F.max("completionTime").alias("last")).collect()}
    assert spans["part-a"][0] < spans["part-b"][1] and spans["part-b"][0] < spans["part-a"][1]  # the clock cannot tell them apart
    most = {r.tag: r.n for r in tagged.groupBy("tag").agg(F.max("numTasks").alias("n")).collect()}
    assert most == {"part-a": 2, "part-b": 5}
    assert all(r.numStages >= 6 and r.executorRunTime >= 0 for r in found.values())


def test_tags_nest_and_end_with_their_part(spark):
    context = spark.sparkContext
    before = context.getJobTags()
    with pytest.raises(ValueError), measured(spark, "outer"):
        with measured(spark, "inner"), measured(spark, "outer"):
            assert context.getJobTags() >= {"outer", "inner"}
        assert "inner" not in context.getJobTags() and "outer" in context.getJobTags()
        raise ValueError
    assert context.getJobTags() == before


def test_a_stage_counts_for_the_job_that_ran_it(spark):
    """A later job that names the stage again does not give it its tag."""
    lines = [
        '{"Event":"SparkListenerJobStart","Job ID":1,"Stage IDs":[1],"Properties":{"spark.job.tags":"a,b"}}',
        '{"Event":"SparkListenerJobStart","Job ID":2,"Stage IDs":[1,2],"Properties":{"spark.job.tags":"c","other":"x"}}',
        '{"Event":"SparkListenerJobStart","Job ID":3,"Stage IDs":[3],"Properties":{}}',
        '{"Event":"SparkListenerJobStart","Job ID":4,"Stage IDs":[4]}',
    ]
    lines += [
        f'{{"Event":"SparkListenerStageCompleted","Stage Info":{{"Stage ID":{n},"Stage Attempt ID":0,"Submission Time":{n},"Completion Time":{n + 10}}}}}'
        for n in (1, 2, 3, 4)
    ]
    frame = spark.createDataFrame([("app", line) for line in lines], "app_id string, value string")
    assert {r.stageId: r.tags for r in stage_metrics(frame, tags=True).collect()} == {1: ["a", "b"], 2: ["c"], 3: [], 4: []}
    assert sorted((r.tag, r.numStages) for r in tag_metrics(frame).collect()) == [("a", 1), ("b", 1), ("c", 1)]
    assert tag_metrics(frame, since=2).count() == 1


def tasks(spark, times):
    """Event lines of tasks (app, stage, milliseconds)."""
    line = (
        "concat('{\"Event\":\"SparkListenerTaskEnd\",\"Stage ID\":', stage, ',\"Stage Attempt ID\":0,\"Task Info\":{\"Launch Time\":0,"
        "\"Finish Time\":', time, '},\"Task Metrics\":{\"Shuffle Read Metrics\":{\"Local Bytes Read\":', time * 100, ',\"Remote Bytes Read\":0}}}')"
    )
    return times.selectExpr("app AS app_id", f"{line} AS value")


def test_merged_sketches_are_close_to_exact_quantiles(spark):
    times = spark.range(0, 60_000, 1, 8).selectExpr("concat('app-', id % 5) AS app", "1 AS stage", "CAST(pow(id % 10007, 1.5) AS BIGINT) AS time")
    merged = merge_sketches(task_sketches(tasks(spark, times), size=512), "stageId", size=512)
    ranks = [0.01, 0.25, 0.5, 0.9, 0.99]
    row = merged.select(F.kll_sketch_get_quantile_bigint("times", F.array(*map(F.lit, ranks))).alias("q"), "tasks").first()
    exact = sorted(r.time for r in times.collect())
    assert row.tasks == len(exact)
    for rank, value in zip(ranks, row.q):
        below = sum(t <= value for t in exact) / len(exact)
        assert abs(below - rank) < 0.02


def test_flags_of_skewed_stages(spark):
    rows = [("a", 1, 1_000)] * 19 + [("a", 1, 9_000)] * 2  # skewed
    rows += [("a", 2, 5_000 + n) for n in range(40)]  # even
    rows += [("b", 3, 10)] * 19 + [("b", 3, 900)] * 2  # too short to matter
    frame = spark.createDataFrame(rows, "app string, stage long, time long")
    found = {r.stageId: r for r in skewed_stages(task_sketches(tasks(spark, frame)), least_bytes=500_000).collect()}
    assert {k: (r.is_time_skew, r.is_byte_skew) for k, r in found.items()} == {1: (True, True), 2: (False, False), 3: (False, False)}
    assert (found[1].median_time, found[1].high_time, found[1].tasks) == (1_000, 9_000, 21)


def test_one_pass_for_tags(spark, folder, plan):
    text = plan(tag_metrics(mapping.event_lines(spark, folder, tags=True)))
    assert text.count("from_json") == plan(stage_metrics(mapping.event_lines(spark, folder))).count("from_json")
