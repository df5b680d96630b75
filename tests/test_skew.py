import datetime as dt
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from skewloom.operators.layout import fewer_partitions, newest_first, partition_profile
from skewloom.operators.skew import hot_keys, make_skew, skew_report
from skewloom.plans.reviews import on_date, salted_skew_query, skew_query

DAY = dt.date(2024, 6, 6)


@pytest.fixture
def reviews(spark):
    """Nine in ten reviews on one business and one date."""
    hot = F.col("id") % 10 != 0
    return spark.range(0, 2_000, 1, 4).select(
        F.concat(F.lit("r"), F.col("id")).alias("review_id"),
        F.concat(F.lit("u"), F.col("id") % 50).alias("user_id"),
        F.when(hot, F.lit("b0")).otherwise(F.concat(F.lit("b"), F.col("id") % 70)).alias("business_id"),
        F.when(hot, F.lit(DAY)).otherwise(F.date_add(F.lit(DAY), -(F.col("id") % 9).cast("int"))).alias("date"),
    )


@pytest.fixture
def business(spark):
    return spark.range(60).select(
        F.concat(F.lit("b"), F.col("id")).alias("business_id"), F.lit("n").alias("name"), F.lit("c").alias("city")
    )


def test_make_skew(spark, reviews):
    skewed = make_skew(reviews, "date", F.lit("2024-06-06"), factor=5)
    assert skewed.schema["date"].dataType.simpleString() == "date"
    assert skewed.count() == 6 * reviews.count()
    assert on_date(skewed, DAY).count() == 5 * reviews.count() + on_date(reviews, DAY).count()
    assert skewed.columns == reviews.columns


def test_make_skew_reads_its_input_once(spark, folder, plan):
    items = spark.read.parquet(f"{folder}/lineitem.parquet")
    assert plan(make_skew(items, "l_shipdate", F.lit(DAY))).count("FileScan") == 1


def test_skew_report(reviews):
    rows = skew_report(reviews, "date").collect()
    assert rows[0].date == DAY and rows[0].qtd >= 1_800
    assert [r.qtd for r in rows] == sorted((r.qtd for r in rows), reverse=True)
    assert sum(r.qtd for r in rows) == 2_000


def test_hot_keys_are_few_and_sized_by_their_share(spark, reviews):
    rows = {r.business_id: r._salts for r in hot_keys(reviews, "business_id", 10).collect()}
    count = reviews.filter("business_id = 'b0'").count()
    assert rows == {"b0": -(-count * 10 // 2_000)}
    even = spark.range(1000)
    assert hot_keys(even, "id", 1000).count() == 0
    assert hot_keys(even, "id", 1001).count() <= 1001
    nulls = even.select(F.when(F.col("id") < 10, F.col("id")).alias("key"))
    assert hot_keys(nulls, "key", 5).count() == 0


def test_hot_keys_of_several_columns_or_other_types(spark):
    df = spark.range(0, 1_000, 1, 4).select(
        F.when(F.col("id") % 2 == 0, F.lit("a")).otherwise(F.col("id").cast("string")).alias("k"),
        F.lit(1.5).alias("d"),
    )
    assert hot_keys(df, ["k", "d"], 10).collect() == [("a", 1.5, 5)]
    assert hot_keys(df, "d", 10).collect() == [(1.5, 10)]


def test_every_hot_key_is_found(spark):
    """A hundred keys just above the limit among many rare ones, spread over partitions."""
    df = spark.range(0, 400_000, 1, 8).select(
        F.when(F.col("id") % 2 == 0, F.pmod(F.xxhash64("id"), F.lit(100))).otherwise(F.col("id") + 1_000).alias("k")
    )
    found = {r.k for r in hot_keys(df, "k", 400).collect()}
    expected = {r.k for r in df.groupBy("k").count().filter("count * 400 > 400000").collect()}
    assert len(expected) > 90 and found >= expected
    assert len(found) <= 400


def test_hot_keys_shuffle_no_keys(spark, folder, plan):
    text = plan(hot_keys(spark.read.parquet(f"{folder}/lineitem.parquet"), "l_partkey", 100))
    assert "hashpartitioning(l_partkey" not in text and text.count("FileScan") == 1
    assert "ReadSchema: struct<l_partkey:bigint>" in text


@pytest.mark.parametrize("adaptive", ["true", "false"])
def test_no_rows_no_hot_keys(spark, reviews, business, settings, adaptive):
    settings("spark.sql.adaptive.enabled", adaptive)
    assert hot_keys(reviews.filter("business_id = 'none'"), "business_id").collect() == []
    assert salted_skew_query(reviews, business, dt.date(1999, 1, 1)).count() == 0


def test_salting_loses_nothing(reviews, business, same_rows, settings):
    expected = skew_query(reviews, business, DAY)
    assert expected.count() > 1_700
    for threshold in ("-1", "10485760"):
        settings("spark.sql.autoBroadcastJoinThreshold", threshold)
        same_rows(salted_skew_query(reviews, business, DAY), expected)
        same_rows(salted_skew_query(reviews, business, DAY, salt_factor=7, partitions=3), expected)


def test_many_copies_of_one_row(spark, business, same_rows, settings):
    settings("spark.sql.autoBroadcastJoinThreshold", "-1")
    copies = spark.range(0, 5_000, 1, 6).select(
        F.lit("r").alias("review_id"), F.lit("u").alias("user_id"), F.lit("b1").alias("business_id"), F.lit(DAY).alias("date")
    )
    same_rows(salted_skew_query(copies, business, DAY, salt_factor=8), skew_query(copies, business, DAY))


def test_date_filter_reaches_the_scan(spark, reviews, business, tmp_path, plan):
    path = str(tmp_path / "reviews")
    reviews.write.parquet(path)
    stored = spark.read.parquet(path)
    for query in (skew_query, salted_skew_query):
        assert "EqualTo(date,2024-06-06)" in plan(query(stored, business, DAY))


def test_partition_profile(spark):
    rows = partition_profile(spark.range(0, 100, 1, 4)).collect()
    assert sorted((r.partition, r.rows) for r in rows) == [(n, 25) for n in range(4)]


def test_fewer_partitions_without_shuffle(spark, plan):
    df = fewer_partitions(spark.range(0, 100, 1, 8), 3)
    assert "Exchange" not in plan(df) and partition_profile(df).count() == 3


def test_a_join_does_not_run_in_the_few_tasks_of_its_result(spark, reviews, business, plan):
    few = salted_skew_query(reviews, business, DAY, salt_factor=7, partitions=3)
    assert "Coalesce" in plan(few) and "Join" not in plan(few) and partition_profile(few).count() <= 3


def test_newest_first(spark):
    df = spark.createDataFrame([(1, 5), (2, 9), (3, 5)], "id int, at int")
    assert [r.id for r in newest_first(df, "at", ("id",)).collect()] == [2, 1, 3]
    assert [r.id for r in newest_first(df, "at", ("id",)).limit(2).collect()] == [2, 1]


def test_salted_joins_leave_no_files(spark, reviews, business):
    folder = Path(spark.conf.get("spark.checkpoint.dir").removeprefix("file:"))
    before = sorted(folder.iterdir())
    for _ in range(2):
        salted_skew_query(reviews, business, DAY).count()
    assert sorted(folder.iterdir()) == before


def test_salt_factor_beyond_the_sketch_is_refused(spark):
    with pytest.raises(ValueError, match="salt_factor"):
        hot_keys(spark.range(3), "id", 40_001)
