"""One query per operator on the given tables."""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.code_map import UNKNOWN, register_names, row_names, vectorised_names, with_names
from ..functions.salt import row_salt, salted_text
from ..operators.bloom import selective_join
from ..operators.diagnosis import diagnose_stages, skewed_stages, slow_stages, summarize_app
from ..operators.event_log import (
    app_metrics,
    app_report,
    app_task_metrics,
    memory_report,
    merge_sketches,
    stage_metrics,
    tag_metrics,
    task_metrics,
    task_sketches,
)
from ..operators.layout import newest_first, partition_profile
from ..operators.logs import parse_logs
from ..operators.skew import SALT_FACTOR, bucketed_join, bucketed_sides, grid_join, make_skew, skew_report
from ..operators.totals import row_counts, totals
from ..session import scratch_path, store
from ..sources.readers import list_files, read_csv, read_json, read_parquet, register_views
from ..sources.schemas import STAGE_METRICS
from ..sources.sinks import convert, files_to_open, replace_partitions, write_clustered, write_json, write_sorted, write_table
from ..streaming.logs import DAILY, LATE, UNMATCHED, read_once, stream_lines, stream_logs, write_once
from . import incremental, mapping, rides
from .measured import STAGE_ORDER, write_report
from .reviews import salted_skew_query, skew_query, with_business, with_users, with_users_copartitioned

DAY = dt.date(2024, 6, 6)
NAMES = mapping.PRIORITY_NAMES
Query = Callable[[SparkSession, str], DataFrame]


def _cents(df: DataFrame) -> DataFrame:
    """Sums of doubles to two places, so that the order of addition does not show."""
    return df.select(*[F.round(c, 2).alias(c) if t == "double" else F.col(c) for c, t in df.dtypes])


def _named_trips(spark: SparkSession, folder: str) -> DataFrame:
    return rides.name_companies(mapping.trips(spark, folder), "native", NAMES)


def _rides(spark: SparkSession, folder: str, wide: bool = True) -> DataFrame:
    return rides.rides(_named_trips(spark, folder), mapping.zones(spark, folder), wide)


def _timed(spark: SparkSession, folder: str) -> DataFrame:
    return rides.timed_rides(_rides(spark, folder, wide=False), DAY)


def rides_enriched(spark, folder):
    return _rides(spark, folder)


def rides_narrow(spark, folder):
    return _timed(spark, folder)


def rides_hinted(spark, folder):
    return rides.rides(_named_trips(spark, folder), mapping.zones(spark, folder), wide=False, hinted=("PU",))


def rides_ordered_top(spark, folder):
    every = _rides(spark, folder)
    ties = tuple(c for c in every.columns if c != "request_datetime")
    return newest_first(every, "request_datetime", ties).limit(100)


def route_totals(spark, folder):
    return _cents(rides.route_totals(_rides(spark, folder)))


def route_totals_from_trips(spark, folder):
    return _cents(rides.route_totals_from_trips(mapping.trips(spark, folder), mapping.zones(spark, folder)))


def route_totals_dated_from_trips(spark, folder):
    return _cents(rides.route_totals_from_trips(mapping.trips(spark, folder), mapping.zones(spark, folder), True, DAY))


def route_totals_sql(spark, folder):
    register_views(skewloom_rides=_rides(spark, folder))
    return spark.sql(
        """
        SELECT PU_Borough, PU_Zone, DO_Borough, DO_Zone,
               round(sum(base_passenger_fare + tolls + bcf + sales_tax + congestion_surcharge + tips), 2) AS total_fare,
               sum(trip_miles) AS total_trip_miles,
               sum(trip_time) AS total_trip_time
        FROM skewloom_rides
        GROUP BY ALL
        """
    )


def _company_totals(spark, folder, timed: bool = False) -> DataFrame:
    trips, zones = mapping.trips(spark, folder), mapping.zones(spark, folder)
    return _cents(rides.company_totals_from_trips(trips, zones, timed, DAY, "native", NAMES))


def company_totals(spark, folder):
    return _company_totals(spark, folder)


def company_totals_of_rides(spark, folder):
    return _cents(rides.company_totals(_rides(spark, folder)))


def route_totals_dated(spark, folder):
    return _cents(rides.route_totals(_timed(spark, folder), timed=True))


def company_totals_dated(spark, folder):
    return _company_totals(spark, folder, timed=True)


def fare_sum_null_as_zero(spark, folder):
    late = F.col("dropoff_datetime") < F.col("pickup_datetime")
    trips = mapping.trips(spark, folder).withColumn("tolls", F.when(late, None).otherwise(F.col("tolls")))
    sums = {
        "total_fare": rides.ride_sums()["total_fare"],
        "total_fare_null_as_zero": rides.ride_sums(null_as_zero=True)["total_fare"],
    }
    return _cents(totals(trips, [rides.COMPANY], sums))


def counts(spark, folder):
    names = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events")
    return row_counts({name: mapping.table(spark, folder, name) for name in names})


def _coded(spark, folder):
    return mapping.table(spark, folder, "orders").select("o_orderkey", "o_orderpriority")


def code_map_unknown(spark, folder):
    return with_names(_coded(spark, folder), "o_orderpriority", NAMES, UNKNOWN)


def code_map_keep(spark, folder):
    return with_names(_coded(spark, folder), "o_orderpriority", NAMES)


def code_map_udf(spark, folder):
    look_up = row_names(NAMES, UNKNOWN)
    return _coded(spark, folder).withColumn("o_orderpriority", look_up("o_orderpriority"))


def code_map_udf_sql(spark, folder):
    register_names(spark, "skewloom_name", NAMES, UNKNOWN)
    return _coded(spark, folder).selectExpr("o_orderkey", "skewloom_name(o_orderpriority) AS o_orderpriority")


def code_map_pandas(spark, folder):
    look_up = vectorised_names(NAMES, UNKNOWN)
    return _coded(spark, folder).withColumn("o_orderpriority", look_up("o_orderpriority"))


def _reviews_business(strategy: str) -> Query:
    def query(spark, folder):
        return with_business(mapping.reviews(spark, folder), mapping.business(spark, folder), strategy)

    return query


def reviews_business_users(spark, folder):
    joined = with_business(mapping.reviews(spark, folder), mapping.business(spark, folder))
    return with_users(joined, mapping.users(spark, folder))


def reviews_business_users_copartitioned(spark, folder):
    reviews = mapping.reviews(spark, folder)
    joined = with_business(reviews, mapping.business(spark, folder))
    return with_users_copartitioned(joined, reviews, mapping.users(spark, folder))


def _skewed(spark, folder):
    return make_skew(mapping.reviews(spark, folder), "date", F.lit(DAY))


def skewed_table(spark, folder):
    return _skewed(spark, folder)


def skewed_counts(spark, folder):
    return skew_report(_skewed(spark, folder), "date")


def skew_filter_join(spark, folder):
    return skew_query(_skewed(spark, folder), mapping.business(spark, folder), DAY)


def salted_join(spark, folder):
    return salted_skew_query(_skewed(spark, folder), mapping.business(spark, folder), DAY)


def salted_join_coalesced(spark, folder):
    return salted_skew_query(_skewed(spark, folder), mapping.business(spark, folder), DAY, partitions=4)


def salted_join_month(spark, folder):
    """The days of one month, chosen by the start of the date's text before anything is salted."""
    return salted_skew_query(_skewed(spark, folder), mapping.business(spark, folder), "1995-03")


def salted_join_hot_business(spark, folder):
    """A third of the reviews on one business, which is salted; joined with two listings of each business."""
    reviews = mapping.reviews(spark, folder)
    hot = F.when(F.pmod("user_id", F.lit(3)) == 0, F.lit(0)).otherwise(F.col("business_id"))
    reviews = reviews.withColumn("business_id", hot.cast("bigint")).withColumn("date", F.lit(DAY))
    listed = mapping.business(spark, folder)
    listed = listed.withColumn("city", F.explode(F.array(F.col("city"), F.lit("online"))))
    return salted_skew_query(reviews, listed, DAY, salt_factor=64)


def grid_join_both_hot(spark, folder):
    """Reviews and offers that both have a third of their rows on one business: pairs per business.

    The pairs of that business are as many as the product of its rows, so each cell's offers are added up before they are joined.
    """
    hot = lambda key, of: F.when(F.pmod(of, F.lit(3)) == 0, F.lit(0)).otherwise(key).cast("bigint")
    reviews = mapping.reviews(spark, folder).withColumn("business_id", hot(F.col("business_id"), F.col("user_id")))
    offers = mapping.table(spark, folder, "supplier").select("s_suppkey", hot(F.col("s_suppkey"), F.col("s_suppkey")).alias("business"))
    of_cell = {"pairs": F.count(F.lit(1)), "offers": F.sum("s_suppkey")}
    met = grid_join(reviews, offers, {"business_id": "business"}, edge=4, salt_factor=64, totals=of_cell)
    return met.groupBy("business_id").agg(
        F.sum("pairs").alias("pairs"),
        F.countDistinct("review_id").alias("reviews"),
        F.sum("offers").alias("offers"),
    )


def selective_join_filtered(spark, folder):
    """Reviews of the businesses of one city, which thin out the reviews before these are shuffled."""
    chosen = mapping.business(spark, folder).filter("city = 'Brand#12'")
    return selective_join(mapping.reviews(spark, folder), chosen, {"business_id": "business_id"})


def bucketed_join_users(spark, folder):
    tables = tuple(f"skewloom_{name}_{uuid.uuid4().hex}" for name in ("reviews", "users"))
    paths = tuple(scratch_path(spark, name) for name in ("bucketed-reviews", "bucketed-users"))
    reviews = mapping.reviews(spark, folder)
    third = F.when(F.pmod("business_id", F.lit(3)) == 0, F.lit(1)).otherwise(F.col("user_id"))
    reviews = reviews.withColumn("user_id", third.cast("bigint"))
    bucketed_sides(reviews, mapping.users(spark, folder), {"user_id": "user_id"}, tables, 16, salt_factor=64, paths=paths)
    return bucketed_join(spark, tables, ["user_id"])


def salt_columns(spark, folder):
    """Per return flag: rows, rows whose salted key is `key_salt` with a salt in range, and whether salts differ."""
    items = mapping.table(spark, folder, "lineitem").select("l_returnflag", "l_partkey", "l_shipdate", "l_orderkey")
    salt = row_salt(SALT_FACTOR, items.columns)
    salted = items.select(
        "l_returnflag",
        "l_partkey",
        salted_text(F.col("l_partkey"), salt).alias("salt_business_id"),
    )
    parts = F.split("salt_business_id", "_")
    number = parts[1].try_cast("int")
    sound = (parts[0] == F.col("l_partkey").cast("string")) & number.between(0, SALT_FACTOR - 1)
    return salted.groupBy("l_returnflag").agg(
        F.count(F.lit(1)).alias("rows"),
        F.count_if(sound).alias("sound"),
        (F.max(number) > F.min(number)).alias("spread"),
    )


def json_roundtrip(spark, folder):
    orders = mapping.table(spark, folder, "orders")
    path = scratch_path(spark, "json")
    write_json(orders, path)
    return read_json(spark, path, ", ".join(f"{name} {kind}" for name, kind in orders.dtypes))


def json_to_parquet(spark, folder):
    entities = {
        "review": mapping.reviews(spark, folder),
        "business": mapping.business(spark, folder),
        "user": mapping.users(spark, folder),
    }
    source = scratch_path(spark, "entities")
    for name, frame in entities.items():
        write_json(frame, f"{source}/{name}")
    target = scratch_path(spark, "converted")
    schemas = {name: ", ".join(f"{c} {kind}" for c, kind in frame.dtypes) for name, frame in entities.items()}
    convert(spark, {name: f"{source}/{name}/*.json" for name in entities}, target, schemas)
    read = {name: read_parquet(spark, f"{target}/{name}") for name in entities}
    return with_users(with_business(read["review"], read["business"]), read["user"])


def csv_roundtrip(spark, folder):
    orders = mapping.table(spark, folder, "orders")
    path = scratch_path(spark, "csv")
    orders.write.mode("overwrite").option("header", True).csv(path)
    text = read_csv(spark, path)
    return text.select(*[F.col(name).cast(kind).alias(name) for name, kind in orders.dtypes])


def route_totals_csv_zones(spark, folder):
    path = scratch_path(spark, "zones")
    mapping.zones(spark, folder).write.mode("overwrite").option("header", True).csv(path)
    return _cents(rides.route_totals(rides.rides(mapping.trips(spark, folder), read_csv(spark, path))))


def partitioned_append(spark, folder):
    path = scratch_path(spark, "appended")
    for _ in range(2):
        write_table(_timed(spark, folder), path, mode="append", by=[rides.DAY], rebalance=False)
    return spark.read.parquet(path)


def partitioned_overwrite(spark, folder):
    path = scratch_path(spark, "overwritten")
    for _ in range(2):
        write_table(rides.route_totals(_rides(spark, folder)), path, by=["PU_Borough"])
    return _cents(spark.read.parquet(path))


def partition_refresh(spark, folder):
    path = scratch_path(spark, "refreshed")
    for _ in range(2):
        replace_partitions(rides.company_totals(_timed(spark, folder), timed=True), path, by=[rides.COMPANY])
    return _cents(spark.read.parquet(path))


def _ride_job(name: str, table: str, runs: int = 1) -> Query:
    """One table of a whole ride job, read back after `runs` runs."""

    def query(spark, folder):
        target = scratch_path(spark, "ride-job")
        for _ in range(runs):
            rides.RIDE_JOBS[name].write(spark, mapping.trips(spark, folder), mapping.zones(spark, folder), target, DAY)
        stored = spark.read.parquet(f"{target}/{table}")
        return stored if table == "rides" else _cents(stored)

    return query


def _job_companies(name: str) -> Query:
    """Company totals of a ride job that writes no table."""

    def query(spark, folder):
        tables = rides.RIDE_JOBS[name].tables(mapping.trips(spark, folder), mapping.zones(spark, folder), DAY)
        return _cents(tables["hvfhs_license_num"])

    return query


def sorted_overwrite(spark, folder):
    target = scratch_path(spark, "sorted")
    job = rides.RIDE_JOBS["sorted_overwrite"]
    job.write(spark, mapping.trips(spark, folder), mapping.zones(spark, folder), target)
    return spark.read.parquet(f"{target}/rides")


def clustered_write(spark, folder):
    table = f"skewloom_clustered_{uuid.uuid4().hex}"
    job = rides.RIDE_JOBS["clustered_table"]
    trips, zones = mapping.trips(spark, folder), mapping.zones(spark, folder)
    target = scratch_path(spark, "clustered")
    for _ in range(2):
        job.write(spark, trips, zones, target, table=table)
    return _cents(spark.table(table))


def clustered_by_several(spark, folder):
    """Line items clustered by part and supplier along a curve, and sorted by part alone, in 64 files each.

    Per column: the rows of a range, whether the curve opens half of the files or fewer for it, and whether the sort does.
    """
    columns = ("l_partkey", "l_suppkey")
    items = store(mapping.table(spark, folder, "lineitem").select("l_orderkey", "l_linenumber", *columns), "items")
    curve, line = scratch_path(spark, "curve"), scratch_path(spark, "line")
    write_clustered(items, curve, columns, files=64)
    write_sorted(items, line, ("l_partkey", "l_orderkey", "l_linenumber"), files=64)
    results = []
    for column in columns:
        most = items.agg(F.max(column)).first()[0]
        low, high = most // 2, most // 2 + most // 64
        rows = spark.read.parquet(curve).filter(F.col(column).between(low, high)).agg(F.count(F.lit(1)).alias("rows"))
        few = [
            files_to_open(spark.read.parquet(path), column, low, high).select((2 * F.col("opened") <= F.col("files")).alias(name))
            for path, name in ((curve, "curve_skips"), (line, "line_skips"))
        ]
        results.append(rows.join(few[0]).join(few[1]).select(F.lit(column).alias("column"), "rows", "curve_skips", "line_skips"))
    return results[0].unionByName(results[1])


def incremental_route_totals(spark, folder):
    """Trips in three files, taken in one after the other, one of them twice: totals from the stored sums."""
    source, state = scratch_path(spark, "trip-files"), scratch_path(spark, "ride-state")
    trips = mapping.trips(spark, folder).withColumn("part", F.pmod(F.xxhash64("PULocationID", "DOLocationID", "trip_time"), F.lit(3)))
    write_table(trips, source, by=["part"])
    for part in (0, 1, 1, 2):
        incremental.take_in(spark, f"{source}/part={part}/*.parquet", state)
    return _cents(incremental.route_totals(spark, state, mapping.zones(spark, folder)))


def incremental_daily_totals(spark, folder):
    """The same by day and company, all files offered at each step, and the state compacted in between."""
    source, state, anew = (scratch_path(spark, name) for name in ("trip-files", "ride-state", "ride-state"))
    trips = mapping.trips(spark, folder).withColumn("part", F.pmod("PULocationID", F.lit(2)))
    for part in (0, 1):
        write_table(trips.filter(F.col("part") == part), source, mode="append", by=["part"])
        incremental.take_in(spark, f"{source}/part=*/*.parquet", state)
        incremental.compact(spark, state, anew)
        state, anew = anew, scratch_path(spark, "ride-state")
    return _cents(incremental.daily_company_totals(spark, state, mapping.zones(spark, folder)))


def rides_pruned(spark, folder):
    path = scratch_path(spark, "rides-by-borough")
    write_table(_rides(spark, folder, wide=False), path, by=["PU_Borough"])
    zones = mapping.zones(spark, folder)
    return rides.rides_of_boroughs(spark.read.parquet(path), zones, F.col("Zone").endswith("3"))


def single_file_sorted(spark, folder):
    path = scratch_path(spark, "stagemetrics")
    write_sorted(mapping.stage_table(spark, folder), path, STAGE_ORDER, "json", compression="gzip")
    return read_json(spark, path, STAGE_METRICS)


def sorted_files(spark, folder):
    """Three sorted files: their rows, and how many files begin before the one before them ends."""
    path = scratch_path(spark, "sorted-files")
    # Three tasks compress all rows: level 3 takes some half of the default's time, and a sixth more space.
    level = {"zlib.compress.level": "THREE"}
    write_sorted(mapping.stage_table(spark, folder), path, STAGE_ORDER, "json", files=3, compression="gzip", options=level)
    key = F.struct(*STAGE_ORDER)
    # Each file on its own: grouped by file, the rows would be sorted by file for the sake of the structs.
    bounds = [
        read_json(spark, file.path, STAGE_METRICS)
        .agg(F.min(key).alias("least"), F.max(key).alias("most"), F.count(F.lit(1)).alias("rows"))
        .withColumn("file", F.lit(file.path))
        for file in list_files(spark, f"{path}/part-*").collect()
    ]
    files = reduce(DataFrame.unionByName, bounds).filter("rows > 0")
    before = F.lag("most").over(Window.orderBy("file"))  # three rows
    overlaps = F.coalesce(before > F.col("least"), F.lit(False))
    return files.select("rows", overlaps.alias("overlaps")).agg(
        F.sum("rows").alias("rows"), F.count_if("overlaps").alias("overlaps")
    )


def profile(spark, folder):
    """Rows in all partitions of a table, and whether each partition is listed once."""
    rows = partition_profile(mapping.table(spark, folder, "lineitem"))
    once = F.count(F.lit(1)) == F.countDistinct("partition")
    return rows.agg(F.sum("rows").alias("rows"), once.alias("listed_once"))


def log_parse(spark, folder):
    return parse_logs(mapping.log_lines(spark, folder))


def log_parse_stream(spark, folder):
    source, target = scratch_path(spark, "log"), scratch_path(spark, "daily")
    mapping.log_lines(spark, folder).write.mode("overwrite").text(source)
    stream_logs(spark, source, target, scratch_path(spark, "log-progress")).awaitTermination()
    return spark.read.option("mergeSchema", False).parquet(target).withColumn("day", F.col("day").cast("string"))


def log_tail_stream(spark, folder):
    """Log files that grow between two runs of one stream, and a third run that finds nothing new."""
    source, target, progress = scratch_path(spark, "live"), scratch_path(spark, "daily"), scratch_path(spark, "log-progress")
    lines = mapping.log_lines(spark, folder)
    for share in (0.4, 1.0, 1.0):
        mapping.write_log_files(lines, source, share)
        stream_logs(spark, source, target, progress, follow=True).awaitTermination()
    return spark.read.parquet(target).drop("file", "offset").withColumn("day", F.col("day").cast("string"))


def log_delivered_twice(spark, folder):
    """Two deliveries that overlap: each line once, from the daily, the late and the unmatched table."""
    source, target, progress = scratch_path(spark, "delivered"), scratch_path(spark, "sorted-out"), scratch_path(spark, "log-progress")
    lines = mapping.log_lines(spark, folder).withColumn("part", F.pmod(F.xxhash64("value"), F.lit(10)))
    for part in ("part < 7", "part >= 4"):
        lines.filter(part).select("value").write.mode("append").text(source)
        write_once(stream_lines(spark, source), target, progress).awaitTermination()
    daily, late, unmatched = (read_once(spark, target, sink) for sink in (DAILY, LATE, UNMATCHED))
    return daily.unionByName(late).unionByName(unmatched).drop("batch", "arrived")


def stage_diagnosis(spark, folder):
    return diagnose_stages(mapping.stage_table(spark, folder))


def slow_stage_causes(spark, folder):
    return slow_stages(mapping.stage_table(spark, folder), "jobId")


def app_summary(spark, folder):
    return summarize_app(mapping.app_table(spark, folder), "app_id")


def event_log_task_metrics(spark, folder):
    return task_metrics(mapping.event_lines(spark, folder))


def event_log_stage_metrics(spark, folder):
    return stage_metrics(mapping.event_lines(spark, folder))


# 1995 in epoch milliseconds.
YEAR = (788_918_400_000, 820_454_399_999)


def event_log_task_metrics_window(spark, folder):
    return task_metrics(mapping.event_lines(spark, folder), *YEAR)


def event_log_stage_metrics_window(spark, folder):
    return stage_metrics(mapping.event_lines(spark, folder), *YEAR)


def event_log_app_metrics(spark, folder):
    return app_metrics(stage_metrics(mapping.event_lines(spark, folder)))


def event_log_app_task_metrics(spark, folder):
    return app_task_metrics(task_metrics(mapping.event_lines(spark, folder)))


def event_log_task_skew(spark, folder):
    """Sketches of each application's stages, merged over all applications into a hundred kinds of stages."""
    sketches = store(task_sketches(mapping.event_lines(spark, folder)), "task-sketches")
    kinds = sketches.withColumn("kind", F.pmod("stageId", F.lit(100)))
    return skewed_stages(merge_sketches(kinds, "kind", size=16384), limit=1.9, least_time=40, least_bytes=4_000_000)


def event_log_tag_metrics(spark, folder):
    return tag_metrics(mapping.event_lines(spark, folder, tags=True))


def event_log_app_report(spark, folder):
    return app_report(app_metrics(stage_metrics(mapping.event_lines(spark, folder))))


def event_log_memory_report(spark, folder):
    return memory_report(stage_metrics(mapping.event_lines(spark, folder)))


def _report(spark, folder) -> dict[str, str]:
    stages = mapping.stage_table(spark, folder).withColumn("app_id", F.concat(F.lit("app-"), F.pmod("jobId", F.lit(16))))
    return write_report(stages, mapping.app_table(spark, folder), scratch_path(spark, "report"))


def metrics_report_summary(spark, folder):
    path = _report(spark, folder)["summary"]
    return spark.read.option("sep", "\t").option("header", True).schema("app_id string, metric string, value double").csv(path)


def metrics_report_stages(spark, folder):
    path = _report(spark, folder)["stages"]
    text = spark.read.option("sep", "\t").option("header", True).csv(path)
    flags = ("CPU Bound", "Memory Bound", "Network Bound", "Spill", "Skew", "Shuffle", "Serialization", "Storage")
    kinds = {"app_id": "string", **dict.fromkeys(flags, "boolean")}
    return text.select(*[F.col(f"`{c}`").cast(kinds.get(c, "bigint")).alias(c) for c in text.columns])


QUERIES: dict[str, Query] = {
    "rides_enriched": rides_enriched,
    "rides_narrow": rides_narrow,
    "rides_hinted": rides_hinted,
    "rides_ordered_top": rides_ordered_top,
    "route_totals": route_totals,
    "route_totals_from_trips": route_totals_from_trips,
    "route_totals_dated_from_trips": route_totals_dated_from_trips,
    "route_totals_sql": route_totals_sql,
    "route_totals_csv_zones": route_totals_csv_zones,
    "company_totals": company_totals,
    "company_totals_of_rides": company_totals_of_rides,
    "route_totals_dated": route_totals_dated,
    "company_totals_dated": company_totals_dated,
    "fare_sum_null_as_zero": fare_sum_null_as_zero,
    "row_counts": counts,
    "code_map_unknown": code_map_unknown,
    "code_map_keep": code_map_keep,
    "code_map_udf": code_map_udf,
    "code_map_udf_sql": code_map_udf_sql,
    "code_map_pandas": code_map_pandas,
    "reviews_business_plain": _reviews_business("planner"),
    "reviews_business_broadcast": _reviews_business("broadcast"),
    "reviews_business_hint": _reviews_business("hint"),
    "reviews_business_users": reviews_business_users,
    "reviews_business_users_copartitioned": reviews_business_users_copartitioned,
    "skewed_table": skewed_table,
    "skew_report": skewed_counts,
    "skew_filter_join": skew_filter_join,
    "salted_join": salted_join,
    "salted_join_coalesced": salted_join_coalesced,
    "salted_join_month": salted_join_month,
    "salted_join_hot_business": salted_join_hot_business,
    "grid_join_both_hot": grid_join_both_hot,
    "selective_join_filtered": selective_join_filtered,
    "bucketed_join_users": bucketed_join_users,
    "salt_columns": salt_columns,
    "json_roundtrip": json_roundtrip,
    "json_to_parquet": json_to_parquet,
    "csv_roundtrip": csv_roundtrip,
    "partitioned_append": partitioned_append,
    "partitioned_overwrite": partitioned_overwrite,
    "partition_refresh": partition_refresh,
    "ride_job_append": _ride_job("narrow_append", "hvfhs_license_num"),
    "ride_job_rides": _ride_job("narrow_append", "rides"),
    "ride_job_routes": _ride_job("narrow_append", "total_trip_time"),
    "ride_job_hinted": _ride_job("hinted_append", "rides"),
    "ride_job_refresh": _ride_job("narrow_refresh", "rides", runs=2),
    "ride_job_refresh_companies": _ride_job("narrow_refresh", "hvfhs_license_num", runs=2),
    "ride_job_partitioned": _ride_job("partitioned_overwrite", "total_trip_time", runs=2),
    "ride_job_row_udf_append": _ride_job("row_udf_append", "hvfhs_license_num"),
    "ride_job_row_udf": _job_companies("row_udf"),
    "ride_job_vectorised_udf": _job_companies("vectorised_udf"),
    "ride_job_native": _job_companies("native"),
    "sorted_overwrite": sorted_overwrite,
    "clustered_write": clustered_write,
    "clustered_by_several": clustered_by_several,
    "incremental_route_totals": incremental_route_totals,
    "incremental_daily_totals": incremental_daily_totals,
    "rides_pruned": rides_pruned,
    "single_file_sorted": single_file_sorted,
    "sorted_files": sorted_files,
    "partition_profile": profile,
    "log_parse": log_parse,
    "log_parse_stream": log_parse_stream,
    "log_tail_stream": log_tail_stream,
    "log_delivered_twice": log_delivered_twice,
    "stage_diagnosis": stage_diagnosis,
    "slow_stages": slow_stage_causes,
    "app_summary": app_summary,
    "event_log_task_metrics": event_log_task_metrics,
    "event_log_stage_metrics": event_log_stage_metrics,
    "event_log_task_metrics_window": event_log_task_metrics_window,
    "event_log_stage_metrics_window": event_log_stage_metrics_window,
    "event_log_app_metrics": event_log_app_metrics,
    "event_log_app_task_metrics": event_log_app_task_metrics,
    "event_log_task_skew": event_log_task_skew,
    "event_log_tag_metrics": event_log_tag_metrics,
    "event_log_app_report": event_log_app_report,
    "event_log_memory_report": event_log_memory_report,
    "metrics_report_summary": metrics_report_summary,
    "metrics_report_stages": metrics_report_stages,
}
