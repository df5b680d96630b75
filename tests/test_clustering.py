"""Layouts along a curve, and pruning of partitions."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from skewloom.operators.layout import curve_position, range_ranks
from skewloom.plans import mapping, rides
from skewloom.sources.sinks import create_clustered_table, files_to_open, fill_clustered_table, write_clustered, write_table


def test_ranks_rise_with_the_values_and_share_the_rows(spark):
    draw = random.Random(3)
    words = ["Brand#%02d" % n for n in range(40)]
    rows = [
        (draw.choice(words), dt.date(2024, 1, 1) + dt.timedelta(draw.randrange(300)), draw.choice([None, float("nan"), draw.random()]), draw.random() ** 9, draw.random() < 0.5)
        for _ in range(4_000)
    ]
    frame = spark.createDataFrame(rows, "word string, day date, gaps double, bent double, flag boolean").repartition(3)
    by = ("word", "day", "gaps", "bent", "flag")
    ranks = range_ranks(frame, by, 4)
    found = frame.select(*by, *[r.alias(f"{c}_rank") for c, r in ranks.items()]).collect()
    for c in by:
        pairs = sorted((row[c], row[f"{c}_rank"]) for row in found if row[c] is not None and row[c] == row[c])
        assert [r for _, r in pairs] == sorted(r for _, r in pairs)
        assert all(row[f"{c}_rank"] == 0 for row in found if row[c] is None)
    counts = [sum(row.bent_rank == n for row in found) for n in range(16)]
    assert max(counts) < 3 * len(found) / 16 and min(counts) > 0


def test_curve_interleaves_the_ranks(spark):
    frame = spark.range(256).selectExpr("id % 16 AS a", "id DIV 16 AS b")
    ranks = range_ranks(frame, ["a", "b"], 3)
    for row in frame.select(curve_position(frame, ["a", "b"], 3).alias("p"), ranks["a"].alias("a"), ranks["b"].alias("b")).collect():
        assert row.p == sum((row.a >> k & 1) << 2 * k | (row.b >> k & 1) << 2 * k + 1 for k in range(3))
    with pytest.raises(ValueError):
        curve_position(frame, ["a"] * 9, 8)


@pytest.fixture
def points(spark, tmp_path):
    path = str(tmp_path / "points")
    spark.range(0, 40_000, 1, 4).selectExpr("hash(id) % 1000 AS a", "hash(id, 1) % 1000 AS b", "hash(id, 2) % 1000 AS c").write.parquet(path)
    return spark.read.parquet(path)


def opened(spark, path, column, low=100, high=130):
    row = files_to_open(spark.read.parquet(path), column, low, high).first()
    return row.opened / row.files


def test_a_filter_on_any_column_opens_few_files(spark, points, tmp_path, same_rows):
    path, line = str(tmp_path / "curve"), str(tmp_path / "line")
    write_clustered(points, path, ["a", "b", "c"], files=64)
    points.repartitionByRange(64, "a", "b", "c").write.parquet(line)
    same_rows(spark.read.parquet(path), points)
    assert all(opened(spark, path, c) <= 0.55 for c in "abc")
    assert opened(spark, line, "a") < 0.1 and opened(spark, line, "b") > 0.9 and opened(spark, line, "c") > 0.9


def test_a_hot_combination_is_cut(spark, tmp_path):
    hot = spark.range(0, 30_000, 1, 4).selectExpr("IF(id % 3 > 0, 5, id) AS a", "IF(id % 3 > 0, 5, id * 7 % 1000) AS b", "id")
    write_clustered(hot, str(tmp_path / "hot"), ["a", "b"], files=16)
    sizes = [r["count"] for r in spark.read.parquet(str(tmp_path / "hot")).groupBy(F.col("_metadata.file_name")).count().collect()]
    assert sum(sizes) == 30_000 and max(sizes) < 4_000


def test_empty_and_null_columns(spark, tmp_path):
    frame = spark.range(10).selectExpr("CAST(null AS INT) AS a", "id AS b")
    for n, df in enumerate((frame, frame.limit(0))):
        write_clustered(df, str(tmp_path / f"{n}"), ["a", "b"])
        assert spark.read.parquet(str(tmp_path / f"{n}")).count() == df.count()


def test_clustered_table_of_two_columns(spark, points, tmp_path, same_rows):
    name = "clustered_points"
    create_clustered_table(spark, name, "a int, b int, c int", ["a", "b"], str(tmp_path / "t"))
    fill_clustered_table(points, name, ["a", "b"])
    same_rows(spark.table(name), points)
    spark.sql(f"DROP TABLE {name}")


def test_pruning_reads_the_boroughs_of_the_filter_only(spark, folder, tmp_path, plan, settings):
    path = str(tmp_path / "rides")
    named = rides.name_companies(mapping.trips(spark, folder), "native")
    zones = mapping.zones(spark, folder)
    write_table(rides.rides(named, zones, wide=False), path, by=["PU_Borough"])
    stored = spark.read.parquet(path)
    wanted = rides.rides_of_boroughs(stored, zones, F.col("Zone").endswith("3"))
    assert "dynamicpruning" in plan(wanted)
    boroughs = {r[0] for r in zones.filter("Zone LIKE '%3'").select("Borough").collect()}
    assert 0 < len(boroughs) < stored.select("PU_Borough").distinct().count()
    assert {r[0] for r in wanted.select("PU_Borough").distinct().collect()} <= boroughs
    assert wanted.count() == stored.filter(F.col("PU_Borough").isin(*boroughs)).count()
