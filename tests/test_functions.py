import datetime as dt

import pytest
from pyspark.sql import functions as F

from skewloom.functions.code_map import COMPANIES, UNKNOWN, register_names, row_names, vectorised_names, with_names
from skewloom.functions.measures import key_number, row_sum, with_day, with_elapsed
from skewloom.functions.salt import row_salt, salted_text
from skewloom.session import scratch_path, store

CODES = ["HV0002", "HV0003", "HV0004", "HV0005", "HV9999", None]


@pytest.fixture
def codes(spark):
    return spark.createDataFrame([(c,) for c in CODES], "code string").coalesce(1)


def values(df, column):
    return [row[column] for row in df.collect()]


def test_all_forms_agree(spark, codes):
    expected = ["Juno", "Uber", "Via", "Lyft", UNKNOWN, UNKNOWN]
    assert values(with_names(codes, "code", COMPANIES, UNKNOWN), "code") == expected
    assert values(codes.withColumn("code", row_names(COMPANIES, UNKNOWN)("code")), "code") == expected
    assert values(codes.withColumn("code", vectorised_names(COMPANIES, UNKNOWN)("code")), "code") == expected
    register_names(spark, "company_name", COMPANIES, UNKNOWN)
    assert values(codes.selectExpr("company_name(code) AS code"), "code") == expected


def test_unlisted_codes_can_stay(codes):
    assert values(with_names(codes, "code", COMPANIES), "code") == ["Juno", "Uber", "Via", "Lyft", "HV9999", None]


def test_native_form_stays_out_of_python(codes, plan):
    assert "Python" not in plan(with_names(codes, "code", COMPANIES))
    assert "BatchEvalPython" in plan(codes.select(row_names(COMPANIES, UNKNOWN)("code")))
    assert "ArrowEvalPython" in plan(codes.select(vectorised_names(COMPANIES, UNKNOWN)("code")))


@pytest.mark.parametrize("kind", ["timestamp", "timestamp_ntz"])
def test_elapsed(spark, kind):
    rows = [
        ("2024-06-06 12:00:00", "2024-06-06 12:30:30"),
        ("2024-06-06 12:00:00", "2024-06-06 12:00:00"),
        ("2024-06-06 12:00:00", "2024-06-06 11:00:00"),
        ("2024-06-06 12:00:00", None),
    ]
    df = spark.createDataFrame(rows, "a string, b string").select(F.col("a").cast(kind), F.col("b").cast(kind))
    timed = with_elapsed(df.coalesce(1), "a", "b")
    assert values(timed, "time_taken_seconds") == [1830, 0, -3600, None]
    assert values(timed, "time_taken_minutes") == [30.5, 0.0, -60.0, None]
    assert values(timed, "time_taken_hours") == [1830 / 3600, 0.0, -1.0, None]
    assert dict(timed.dtypes)["time_taken_seconds"] == "bigint"


def test_day(spark):
    one = spark.range(1)
    assert values(with_day(one, "day", dt.date(2024, 6, 6)), "day") == [dt.date(2024, 6, 6)]
    assert dict(with_day(one, "day").dtypes)["day"] == "date"


def test_row_sum(spark):
    df = spark.createDataFrame([(1.0, 2.0), (1.0, None)], "a double, b double")
    assert df.agg(F.sum(row_sum(["a", "b"]))).first()[0] == 3.0
    assert df.agg(F.sum(row_sum(["a", "b"], null_as_zero=True))).first()[0] == 4.0


def test_keys_that_are_no_numbers_become_null(spark):
    df = spark.createDataFrame([("7",), ("N/A",), (None,)], "key string").coalesce(1)
    assert values(df.select(key_number(F.col("key")).alias("key")), "key") == [7, None, None]


def test_salts_are_stable_in_range_and_spread_copies(spark):
    df = spark.range(0, 10_000, 1, 8).select(F.lit("same").alias("key"))
    salted = df.select(row_salt(16, ["key"]).alias("salt"))
    first, second = salted.groupBy("salt").count().collect(), salted.groupBy("salt").count().collect()
    assert sorted(first) == sorted(second)
    assert all(0 <= row.salt < 16 for row in first)
    assert len(first) > 1


def test_salted_text(spark):
    df = spark.createDataFrame([("k", 3), (None, 3)], "key string, salt int").coalesce(1)
    assert values(df.select(salted_text(F.col("key"), F.col("salt")).alias("s")), "s") == ["k_3", None]


def test_scratch_is_in_the_shared_folder(spark):
    shared = spark.conf.get("spark.checkpoint.dir")
    assert scratch_path(spark, "x").startswith(f"{shared}/x-")
    assert scratch_path(spark, "x") != scratch_path(spark, "x")


def test_cluster_without_shared_folder_is_refused():
    class Conf:
        def get(self, key, default=None):
            return "spark://host:7077" if key == "spark.master" else default

    class Session:
        conf = Conf()

    with pytest.raises(ValueError):
        scratch_path(Session(), "x")


def test_store(spark, same_rows):
    df = spark.range(5).withColumn("name", F.lit("n"))
    same_rows(store(df, "kept"), df)
