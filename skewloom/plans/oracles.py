"""SQL that must give the same result as each query, for an independent engine over the same tables."""

from __future__ import annotations

from ..sources.schemas import STAGE_SIZES, STAGE_TIMES

TRIPS = """
trips AS (
    SELECT o_orderpriority AS hvfhs_license_num,
           s_nationkey AS PULocationID,
           c_nationkey AS DOLocationID,
           o_orderdate AS request_datetime,
           o_orderdate AS pickup_datetime,
           l_shipdate AS dropoff_datetime,
           l_quantity AS trip_miles,
           CAST(l_linenumber AS BIGINT) AS trip_time,
           l_extendedprice AS base_passenger_fare,
           l_tax AS tolls,
           l_discount AS bcf,
           l_tax AS sales_tax,
           l_discount AS congestion_surcharge,
           l_tax + l_discount AS tips,
           l_extendedprice * (1 - l_discount) AS driver_pay,
           l_returnflag AS shared_request_flag,
           l_linestatus AS shared_match_flag
    FROM lineitem
    JOIN orders ON l_orderkey = o_orderkey
    JOIN customer ON o_custkey = c_custkey
    JOIN supplier ON l_suppkey = s_suppkey
)"""
ZONES = """
zones AS (
    SELECT n_nationkey AS LocationID, r_name AS Borough, n_name AS Zone
    FROM nation JOIN region ON n_regionkey = r_regionkey
)"""
KEEP = """CASE hvfhs_license_num WHEN '1-URGENT' THEN 'Urgent' WHEN '2-HIGH' THEN 'High'
             WHEN '3-MEDIUM' THEN 'Medium' ELSE hvfhs_license_num END"""
NARROW = """request_datetime, pickup_datetime, dropoff_datetime, trip_miles, trip_time,
           base_passenger_fare, tolls, bcf, sales_tax, congestion_surcharge, tips"""
WIDE = f"{NARROW}, driver_pay, shared_request_flag, shared_match_flag"


def _rides(columns: str, company: str = KEEP) -> str:
    return f"""WITH {TRIPS}, {ZONES}, rides AS (
    SELECT {company} AS hvfhs_license_num,
           pu.Borough AS PU_Borough, pu.Zone AS PU_Zone, dz.Borough AS DO_Borough, dz.Zone AS DO_Zone,
           {columns}
    FROM trips
    JOIN zones pu ON PULocationID = pu.LocationID
    JOIN zones dz ON DOLocationID = dz.LocationID
)"""


SECONDS = "CAST(epoch(dropoff_datetime) - epoch(pickup_datetime) AS BIGINT)"
TIMED = f"""{_rides(NARROW)}, timed AS (
    SELECT *, DATE '2024-06-06' AS ingestion_timestamp, {SECONDS} AS time_taken_seconds,
           {SECONDS} / 60.0::DOUBLE AS time_taken_minutes, {SECONDS} / 3600.0::DOUBLE AS time_taken_hours
    FROM rides
)"""
FARE = "base_passenger_fare + tolls + bcf + sales_tax + congestion_surcharge + tips"
SUMS = f"""round(sum({FARE}), 2) AS total_fare, round(sum(trip_miles), 2) AS total_trip_miles,
           CAST(sum(trip_time) AS BIGINT) AS total_trip_time"""
TIMED_SUMS = f"""{SUMS}, CAST(sum(time_taken_seconds) AS BIGINT) AS total_time_taken_seconds,
           round(sum(time_taken_minutes), 2) AS total_time_taken_minutes,
           round(sum(time_taken_hours), 2) AS total_time_taken_hours"""
ROUTE = "PU_Borough, PU_Zone, DO_Borough, DO_Zone"

ROUTE_TOTALS = f"{_rides(WIDE)} SELECT {ROUTE}, {SUMS} FROM rides GROUP BY {ROUTE}"
COMPANY_TOTALS = f"{_rides(WIDE)} SELECT hvfhs_license_num, {SUMS} FROM rides GROUP BY hvfhs_license_num"
CODED = TIMED.replace(KEEP, "hvfhs_license_num")
ROUTE_TOTALS_DATED = f"""{TIMED} SELECT ingestion_timestamp, {ROUTE}, {TIMED_SUMS}
    FROM timed GROUP BY ingestion_timestamp, {ROUTE}"""
COMPANY_TOTALS_DATED = f"""{TIMED} SELECT ingestion_timestamp, hvfhs_license_num, {TIMED_SUMS}
    FROM timed GROUP BY ingestion_timestamp, hvfhs_license_num"""

CODE_UNKNOWN = """SELECT o_orderkey, CASE o_orderpriority WHEN '1-URGENT' THEN 'Urgent' WHEN '2-HIGH' THEN 'High'
    WHEN '3-MEDIUM' THEN 'Medium' ELSE 'Unknown' END AS o_orderpriority FROM orders"""
CODE_KEEP = CODE_UNKNOWN.replace("'Unknown'", "o_orderpriority")

REVIEWS = """
reviews AS (
    SELECT CAST(l_orderkey AS VARCHAR) || '-' || CAST(l_linenumber AS VARCHAR) AS review_id,
           o_custkey AS user_id, l_partkey AS business_id, CAST(l_shipdate AS DATE) AS date
    FROM lineitem JOIN orders ON l_orderkey = o_orderkey
)"""
REVIEWS_BUSINESS = f"""WITH {REVIEWS} SELECT r.*, p_name AS name, p_brand AS city
    FROM reviews r JOIN part ON business_id = p_partkey"""
REVIEWS_USERS = f"""WITH {REVIEWS} SELECT r.*, p_name AS name, p_brand AS city, c_name AS user_name, c_mktsegment AS segment
    FROM reviews r JOIN part ON business_id = p_partkey JOIN customer ON user_id = c_custkey"""
SKEWED = f"""WITH {REVIEWS}, skewed AS (
    SELECT * FROM reviews
    UNION ALL
    SELECT review_id, user_id, business_id, DATE '2024-06-06' AS date FROM reviews, range(5)
)"""
SKEW_JOIN = f"""{SKEWED} SELECT review_id, user_id, date, p_name AS name, p_brand AS city
    FROM skewed JOIN part ON business_id = p_partkey WHERE date = DATE '2024-06-06'"""
MONTH_JOIN = f"""{SKEWED} SELECT review_id, user_id, date, p_name AS name, p_brand AS city
    FROM skewed JOIN part ON business_id = p_partkey WHERE CAST(date AS VARCHAR) LIKE '1995-03%'"""
HOT_JOIN = f"""WITH {REVIEWS}, hot AS (
    SELECT review_id, user_id, DATE '2024-06-06' AS date,
           CASE WHEN user_id % 3 = 0 THEN 0 ELSE business_id END AS business_id
    FROM reviews
), listed AS (
    SELECT p_partkey, p_name AS name, p_brand AS city FROM part
    UNION ALL SELECT p_partkey, p_name, 'online' FROM part
) SELECT review_id, user_id, date, name, city FROM hot JOIN listed ON business_id = p_partkey"""

GRID_JOIN = f"""WITH {REVIEWS}, hot AS (
    SELECT review_id, CASE WHEN user_id % 3 = 0 THEN 0 ELSE business_id END AS business_id FROM reviews
), offers AS (
    SELECT s_suppkey, CASE WHEN s_suppkey % 3 = 0 THEN 0 ELSE s_suppkey END AS business FROM supplier
)
SELECT business_id, count(*) AS pairs, count(DISTINCT review_id) AS reviews, CAST(sum(s_suppkey) AS BIGINT) AS offers
FROM hot JOIN offers ON business_id = business GROUP BY business_id"""
BUCKETED_JOIN = f"""WITH {REVIEWS}, hot AS (
    SELECT review_id, business_id, date, CASE WHEN business_id % 3 = 0 THEN 1 ELSE user_id END AS user_id FROM reviews
)
SELECT hot.*, c_name AS name, c_mktsegment AS segment FROM hot JOIN customer ON user_id = c_custkey"""


def _clustered(column: str, line: bool) -> str:
    return f"""SELECT '{column}' AS "column", count(*) AS rows, TRUE AS curve_skips, {line} AS line_skips FROM lineitem
        WHERE {column} BETWEEN (SELECT max({column}) // 2 FROM lineitem) AND (SELECT max({column}) // 2 + max({column}) // 64 FROM lineitem)"""


ORDERS = "SELECT * FROM orders"

LOG = """
WITH e AS (
    SELECT *, event_type <> 'view' AS matched,
           strftime(ts, '%Y-%m-%dT%H:%M:%S,') || lpad(CAST((epoch_us(ts) // 1000) % 1000 AS VARCHAR), 3, '0') AS stamp,
           CASE event_type WHEN 'error' THEN 'ERROR' WHEN 'click' THEN 'WARN' ELSE 'INFO' END AS lvl,
           CASE WHEN event_type = 'purchase'
                THEN 'Asked to launch executor app-' || event_id || '/' || user_id || ' for job' || user_id || '-nightly'
                ELSE props END AS msg,
           CASE WHEN event_type = 'signup' THEN 'web' ELSE '' END AS comp
    FROM events
)
SELECT CASE WHEN matched THEN stamp || ' [task-' || user_id || '] ' || rpad(lvl, 5, ' ') || ' app.' || event_type
                 || '.Handler [' || comp || '] - ' || msg ELSE '    at ' || props END AS value,
       matched,
       CASE WHEN matched THEN stamp END AS "timestamp",
       CASE WHEN matched THEN 'task-' || user_id END AS thread,
       CASE WHEN matched THEN lvl END AS loglevel,
       CASE WHEN matched THEN 'app.' || event_type || '.Handler' END AS "class",
       CASE WHEN matched THEN comp END AS component,
       CASE WHEN matched THEN msg END AS log_message,
       CASE WHEN matched THEN date_trunc('milliseconds', ts) END AS event_time,
       CASE WHEN event_type = 'purchase' THEN 'job' || user_id END AS spark_app_name,
       CASE WHEN matched THEN strftime(ts, '%Y.%m.%d') END AS day
FROM e
"""

STAGES = """
base AS (
    SELECT *, CAST(floor(l_extendedprice) AS BIGINT) AS price, CAST(floor(l_quantity) AS BIGINT) AS qty,
           CAST(l_linenumber AS BIGINT) AS line, CAST(date_diff('day', DATE '1970-01-01', CAST(l_shipdate AS DATE)) AS BIGINT) AS day
    FROM lineitem
), stages AS (
    SELECT l_orderkey AS jobId, l_orderkey * 10 + line AS stageId,
           price * line AS stageDuration,
           CASE WHEN line = 1 THEN 0 ELSE price * qty END AS executorRunTime,
           price * (qty - 3) AS executorCpuTime,
           price * (line - 1) AS executorDeserializeTime,
           price AS executorDeserializeCpuTime,
           qty * qty AS resultSerializationTime,
           CASE WHEN line <> 7 THEN qty * 110 END AS jvmGCTime,
           day AS shuffleFetchWaitTime,
           CASE WHEN line <> 2 THEN qty * 21 END AS shuffleWriteTime,
           price AS resultSize,
           CASE WHEN line > 4 THEN price ELSE 0 END AS diskBytesSpilled,
           CASE WHEN line > 5 THEN price ELSE 0 END AS memoryBytesSpilled,
           price * 30000 AS peakExecutionMemory,
           price * 4096 AS bytesRead,
           price * 1024 AS bytesWritten,
           price * 300 AS shuffleTotalBytesRead,
           price * 100 AS shuffleLocalBytesRead,
           price * 200 AS shuffleRemoteBytesRead,
           price * 50 AS shuffleRemoteBytesReadToDisk,
           price * 70 AS shuffleBytesWritten,
           qty AS recordsRead,
           line AS recordsWritten
    FROM base
)"""


def _share(amount: str, of: str, limit: str) -> str:
    """amount / of > limit, where x / 0 is infinite for x > 0 and 0 / 0 is nothing."""
    return f"coalesce(CASE WHEN {of} = 0 THEN {amount} > 0 ELSE CAST({amount} AS DOUBLE) / {of} > {limit} END, FALSE)"


SHUFFLE = "(shuffleFetchWaitTime + shuffleWriteTime)"
FLAGS = {
    "is_cpu_bound": _share("executorCpuTime", "executorRunTime", "0.8::DOUBLE"),
    "is_memory_bound": _share("jvmGCTime", "executorRunTime", "0.1::DOUBLE"),
    "is_network_bound": _share(SHUFFLE, "stageDuration", "0.5::DOUBLE"),
    "is_spill": "diskBytesSpilled + memoryBytesSpilled > 0",
    "is_skew": _share("executorDeserializeTime", "executorRunTime", "0.2::DOUBLE"),
    "is_shuffle": f"coalesce({SHUFFLE} > 1000, FALSE)",
    "is_serialization": _share("resultSerializationTime", "stageDuration", "0.1::DOUBLE"),
    "is_storage": "CAST(peakExecutionMemory AS DOUBLE) / 1073741824 > 1",
}
DIAGNOSIS = ", ".join(
    ["*"]
    + [f"{rule} AS {name}" for name, rule in FLAGS.items()]
    + [f"CAST({c} AS DOUBLE) / 60000 AS {c}_minutes" for c in STAGE_TIMES]
    + [f"CAST({c} AS DOUBLE) / 1048576 AS {c}_MBs" for c in STAGE_SIZES]
)

APPS = f"""{STAGES}, apps AS (
    SELECT 'app-' || (jobId % 16) AS app_id, count(*) AS numStages, max(peakExecutionMemory) AS peakExecutionMemory,
           sum(recordsRead) AS numTasks, sum(stageDuration) AS elapsedTime, sum(executorRunTime) AS executorRunTime,
           sum(executorCpuTime) AS executorCpuTime, sum(jvmGCTime) AS jvmGCTime,
           sum(shuffleTotalBytesRead) AS shuffleTotalBytesRead, sum(shuffleBytesWritten) AS shuffleBytesWritten,
           sum(recordsRead) AS recordsRead, sum(bytesRead) AS bytesRead, sum(recordsWritten) AS recordsWritten,
           sum(bytesWritten) AS bytesWritten
    FROM stages GROUP BY 1
)"""
SUMMARY_COLUMNS = {
    "numStages": "CAST(numStages AS BIGINT)",
    "numTasks": "CAST(numTasks AS BIGINT)",
    "elapsedTime (seconds)": "CAST(elapsedTime AS DOUBLE) / 1000",
    "elapsedTime (minutes)": "CAST(elapsedTime AS DOUBLE) / 60000",
    "executorRunTime (seconds)": "CAST(executorRunTime AS DOUBLE) / 1000",
    "executorRunTime (minutes)": "CAST(executorRunTime AS DOUBLE) / 60000",
    "executorCpuTime (seconds)": "CAST(executorCpuTime AS DOUBLE) / 1000",
    "executorCpuTime (minutes)": "CAST(executorCpuTime AS DOUBLE) / 60000",
    "jvmGCTime (seconds)": "CAST(coalesce(jvmGCTime, 0) AS DOUBLE) / 1000",
    "jvmGCTime (minutes)": "CAST(coalesce(jvmGCTime, 0) AS DOUBLE) / 60000",
    "peakExecutionMemory (MBs)": "CAST(peakExecutionMemory AS DOUBLE) / 1048576",
    "shuffleTotalBytesRead (MBs)": "CAST(shuffleTotalBytesRead AS DOUBLE) / 1048576",
    "shuffleBytesWritten (MBs)": "CAST(shuffleBytesWritten AS DOUBLE) / 1048576",
    "recordsRead": "CAST(recordsRead AS BIGINT)",
    "bytesRead (MBs)": "CAST(bytesRead AS DOUBLE) / 1048576",
    "recordsWritten": "CAST(recordsWritten AS BIGINT)",
    "bytesWritten (MBs)": "CAST(bytesWritten AS DOUBLE) / 1048576",
}
APP_SUMMARY = f"WITH {APPS} SELECT app_id, " + ", ".join(
    f'{value} AS "{name}"' for name, value in SUMMARY_COLUMNS.items()
) + " FROM apps"
SUMMARY_ROWS = f"WITH {APPS} " + " UNION ALL ".join(
    f"SELECT app_id, '{name}' AS metric, CAST({value} AS DOUBLE) AS value FROM apps"
    for name, value in SUMMARY_COLUMNS.items()
)
SLOW = f"""WITH {STAGES}
SELECT jobId, stageId, 'executor_run_time' AS cause FROM stages WHERE executorRunTime > 100000
UNION ALL SELECT jobId, stageId, 'gc_time' FROM stages WHERE coalesce(jvmGCTime, 0) > 5000
UNION ALL SELECT jobId, stageId, 'shuffle_time' FROM stages
    WHERE coalesce(shuffleFetchWaitTime, 0) > 1000 OR coalesce(shuffleWriteTime, 0) > 1000"""
REPORT_STAGES = f"""WITH {STAGES}, d AS (SELECT {DIAGNOSIS} FROM stages)
SELECT 'app-' || (jobId % 16) AS app_id, stageId AS "Stage ID", stageDuration AS "Stage Duration (ms)",
       executorRunTime AS "Executor Run Time (ms)", executorCpuTime AS "Executor CPU Time (ms)",
       jvmGCTime AS "JVM GC Time (ms)", shuffleFetchWaitTime AS "Shuffle Fetch Wait Time (ms)",
       shuffleWriteTime AS "Shuffle Write Time (ms)", peakExecutionMemory AS "Peak Execution Memory (bytes)",
       recordsRead AS "Records Read", bytesRead AS "Bytes Read (bytes)", recordsWritten AS "Records Written",
       bytesWritten AS "Bytes Written (bytes)", is_cpu_bound AS "CPU Bound", is_memory_bound AS "Memory Bound",
       is_network_bound AS "Network Bound", is_spill AS "Spill", is_skew AS "Skew", is_shuffle AS "Shuffle",
       is_serialization AS "Serialization", is_storage AS "Storage"
FROM d"""

EVENTS = """
stage_ends AS (
    SELECT 'app-' || ((o_orderkey // 100) % 16) AS app_id, o_orderkey AS stageId, CAST(0 AS BIGINT) AS stageAttempt,
           CAST(epoch(o_orderdate) AS BIGINT) * 1000 AS submissionTime,
           CAST(epoch(o_orderdate) AS BIGINT) * 1000 + CAST(floor(o_totalprice) AS BIGINT) AS completionTime
    FROM orders
), jobs AS (
    SELECT o_orderkey AS stageId,
           CASE WHEN o_orderkey % 100 <> 0 AND EXISTS (SELECT 1 FROM orders p WHERE p.o_orderkey = o.o_orderkey - 1)
                THEN o_orderkey - 1 ELSE o_orderkey END AS jobId
    FROM orders o
), base AS (
    SELECT *, CAST(floor(l_extendedprice) AS BIGINT) AS price, CAST(floor(l_quantity) AS BIGINT) AS qty,
           CAST(l_linenumber AS BIGINT) AS line
    FROM lineitem
), tasks AS (
    SELECT 'app-' || ((l_orderkey // 100) % 16) AS app_id, l_orderkey AS stageId, CAST(0 AS BIGINT) AS stageAttempt,
           line AS "index", CAST(0 AS BIGINT) AS attempt, CAST(epoch(l_shipdate) AS BIGINT) * 1000 AS launchTime,
           qty AS duration,
           price AS executorRunTime, price * 700001 // 1000000 AS executorCpuTime, line AS executorDeserializeTime,
           line * 900000 // 1000000 AS executorDeserializeCpuTime, qty AS resultSerializationTime, line * 3 AS jvmGCTime,
           qty * 11 AS resultSize, price * 13 AS memoryBytesSpilled, price * 17 AS diskBytesSpilled,
           price * 19 AS peakExecutionMemory, qty AS recordsRead, price * 23 AS bytesRead, line AS recordsWritten,
           price * 29 AS bytesWritten, line * 31 AS shuffleFetchWaitTime, price * 37 AS shuffleLocalBytesRead,
           price * 41 AS shuffleRemoteBytesRead, price * 43 AS shuffleRemoteBytesReadToDisk,
           price * 47 AS shuffleBytesWritten, price * 530003 // 1000000 AS shuffleWriteTime,
           price * 78 AS shuffleTotalBytesRead
    FROM base
)"""
EVENT_MEASURES = (
    "executorRunTime", "executorCpuTime", "executorDeserializeTime", "executorDeserializeCpuTime",
    "resultSerializationTime", "jvmGCTime", "resultSize", "memoryBytesSpilled", "diskBytesSpilled",
    "peakExecutionMemory", "recordsRead", "bytesRead", "recordsWritten", "bytesWritten", "shuffleFetchWaitTime",
    "shuffleLocalBytesRead", "shuffleRemoteBytesRead", "shuffleRemoteBytesReadToDisk", "shuffleBytesWritten",
    "shuffleWriteTime", "shuffleTotalBytesRead",
)
EVENT_SUMS = ", ".join(
    f"CAST({'max' if c == 'peakExecutionMemory' else 'sum'}({c}) AS BIGINT) AS {c}" for c in EVENT_MEASURES
)
EVENT_STAGES = f"""{EVENTS}, task_sums AS (
    SELECT stageId, count(*) AS numTasks, {EVENT_SUMS} FROM tasks GROUP BY stageId
), stages AS (
    SELECT e.*, completionTime - submissionTime AS stageDuration, coalesce(numTasks, 0) AS numTasks, jobId,
           {", ".join(EVENT_MEASURES)}
    FROM stage_ends e JOIN jobs j ON e.stageId = j.stageId LEFT JOIN task_sums t ON e.stageId = t.stageId
)"""
EVENT_APPS = f"""{EVENT_STAGES}, apps AS (
    SELECT app_id, count(*) AS numStages, CAST(sum(numTasks) AS BIGINT) AS numTasks,
           max(completionTime) - min(submissionTime) AS elapsedTime, CAST(sum(stageDuration) AS BIGINT) AS stageDuration,
           {EVENT_SUMS}
    FROM stages GROUP BY app_id
)"""
TASK_SKEW = f"""WITH {EVENTS}, kinds AS (
    SELECT stageId % 100 AS kind, count(*) AS tasks,
           quantile_disc(duration, 0.5) AS median_time, quantile_disc(duration, 0.95) AS high_time,
           quantile_disc(shuffleTotalBytesRead, 0.5) AS median_bytes, quantile_disc(shuffleTotalBytesRead, 0.95) AS high_bytes
    FROM tasks GROUP BY stageId % 100
)
SELECT *, high_time > 1.9 * median_time AND high_time >= 40 AS is_time_skew,
       high_bytes > 1.9 * median_bytes AND high_bytes >= 4000000 AS is_byte_skew
FROM kinds"""
EVENT_TAGS = f"""WITH {EVENT_STAGES}, tagged AS (
    SELECT *, unnest(list_filter(['extract', 'load'], lambda t: jobId % (CASE t WHEN 'extract' THEN 2 ELSE 3 END) = 0)) AS tag
    FROM stages
)
SELECT app_id, tag, count(*) AS numStages, CAST(sum(numTasks) AS BIGINT) AS numTasks,
       max(completionTime) - min(submissionTime) AS elapsedTime, CAST(sum(stageDuration) AS BIGINT) AS stageDuration,
       {EVENT_SUMS}
FROM tagged GROUP BY app_id, tag"""
APP_METRIC_NAMES = ("numStages", "numTasks", "elapsedTime", "stageDuration", *EVENT_MEASURES)

COUNTED = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events")

ORACLES: dict[str, str] = {
    "rides_enriched": f"{_rides(WIDE)} SELECT * FROM rides",
    "rides_narrow": f"{TIMED} SELECT * FROM timed",
    "rides_hinted": f"{_rides(NARROW)} SELECT * FROM rides",
    "rides_ordered_top": f"""{_rides(WIDE)} SELECT * FROM rides
        ORDER BY request_datetime DESC, hvfhs_license_num, {ROUTE}, {WIDE.replace("request_datetime, ", "")} LIMIT 100""",
    "route_totals": ROUTE_TOTALS,
    "route_totals_from_trips": ROUTE_TOTALS,
    "route_totals_sql": ROUTE_TOTALS,
    "route_totals_csv_zones": ROUTE_TOTALS,
    "company_totals": COMPANY_TOTALS,
    "company_totals_of_rides": COMPANY_TOTALS,
    "route_totals_dated": ROUTE_TOTALS_DATED,
    "route_totals_dated_from_trips": ROUTE_TOTALS_DATED,
    "company_totals_dated": COMPANY_TOTALS_DATED,
    "fare_sum_null_as_zero": f"""WITH {TRIPS} SELECT hvfhs_license_num,
        round(sum(CASE WHEN dropoff_datetime >= pickup_datetime THEN {FARE} END), 2) AS total_fare,
        round(sum({FARE} - CASE WHEN dropoff_datetime < pickup_datetime THEN tolls ELSE 0 END), 2)
            AS total_fare_null_as_zero
        FROM trips GROUP BY hvfhs_license_num""",
    "row_counts": " UNION ALL ".join(f"SELECT '{t}' AS name, count(*) AS rows FROM {t}" for t in COUNTED),
    "code_map_unknown": CODE_UNKNOWN,
    "code_map_keep": CODE_KEEP,
    "code_map_udf": CODE_UNKNOWN,
    "code_map_udf_sql": CODE_UNKNOWN,
    "code_map_pandas": CODE_UNKNOWN,
    "reviews_business_plain": REVIEWS_BUSINESS,
    "reviews_business_broadcast": REVIEWS_BUSINESS,
    "reviews_business_hint": REVIEWS_BUSINESS,
    "reviews_business_users": REVIEWS_USERS,
    "reviews_business_users_copartitioned": REVIEWS_USERS,
    "skewed_table": f"{SKEWED} SELECT * FROM skewed",
    "skew_report": f"{SKEWED} SELECT date, count(*) AS qtd FROM skewed GROUP BY date",
    "skew_filter_join": SKEW_JOIN,
    "salted_join": SKEW_JOIN,
    "salted_join_coalesced": SKEW_JOIN,
    "salted_join_month": MONTH_JOIN,
    "salted_join_hot_business": HOT_JOIN,
    "grid_join_both_hot": GRID_JOIN,
    "selective_join_filtered": f"{REVIEWS_BUSINESS} WHERE p_brand = 'Brand#12'",
    "bucketed_join_users": BUCKETED_JOIN,
    "salt_columns": """SELECT l_returnflag, count(*) AS rows, count(*) AS sound, count(*) > 1 AS spread
        FROM lineitem GROUP BY l_returnflag""",
    "json_roundtrip": ORDERS,
    "json_to_parquet": REVIEWS_USERS,
    "csv_roundtrip": ORDERS,
    "partitioned_append": f"{TIMED} SELECT * FROM timed UNION ALL SELECT * FROM timed",
    "partitioned_overwrite": ROUTE_TOTALS,
    "partition_refresh": COMPANY_TOTALS_DATED,
    "clustered_by_several": f"{_clustered('l_partkey', True)} UNION ALL {_clustered('l_suppkey', False)}",
    "incremental_route_totals": ROUTE_TOTALS,
    "incremental_daily_totals": f"""{_rides(WIDE, "hvfhs_license_num")}
        SELECT CAST(pickup_datetime AS DATE) AS trip_day, hvfhs_license_num, {SUMS} FROM rides GROUP BY ALL""",
    "rides_pruned": f"""{_rides(NARROW)} SELECT * FROM rides
        WHERE PU_Borough IN (SELECT Borough FROM zones WHERE Zone LIKE '%3')""",
    "ride_job_append": COMPANY_TOTALS_DATED.replace(KEEP, "hvfhs_license_num"),
    "ride_job_rides": f"{CODED} SELECT * FROM timed",
    "ride_job_routes": ROUTE_TOTALS_DATED,
    "ride_job_hinted": f"{CODED} SELECT * FROM timed",
    "ride_job_refresh": f"{CODED} SELECT * FROM timed",
    "ride_job_refresh_companies": COMPANY_TOTALS_DATED.replace(KEEP, "hvfhs_license_num"),
    "ride_job_partitioned": ROUTE_TOTALS,
    "ride_job_row_udf_append": COMPANY_TOTALS_DATED.replace(KEEP, "'Unknown'"),
    "ride_job_row_udf": COMPANY_TOTALS.replace(KEEP, "'Unknown'"),
    "ride_job_vectorised_udf": COMPANY_TOTALS.replace(KEEP, "'Unknown'"),
    "ride_job_native": COMPANY_TOTALS.replace(KEEP, "hvfhs_license_num"),
    "sorted_overwrite": f"{_rides(WIDE, 'hvfhs_license_num')} SELECT * FROM rides",
    "clustered_write": ROUTE_TOTALS,
    "single_file_sorted": f"WITH {STAGES} SELECT * FROM stages",
    "sorted_files": "SELECT count(*) AS rows, CAST(0 AS BIGINT) AS overlaps FROM lineitem",
    "partition_profile": "SELECT count(*) AS rows, TRUE AS listed_once FROM lineitem",
    "log_parse": LOG,
    "log_parse_stream": LOG,
    "log_tail_stream": LOG,
    "log_delivered_twice": f"SELECT DISTINCT * FROM ({LOG})",
    "stage_diagnosis": f"WITH {STAGES} SELECT {DIAGNOSIS} FROM stages",
    "slow_stages": SLOW,
    "app_summary": APP_SUMMARY,
    "event_log_task_metrics": f"WITH {EVENTS} SELECT tasks.*, jobId FROM tasks JOIN jobs ON tasks.stageId = jobs.stageId",
    "event_log_stage_metrics": f"WITH {EVENT_STAGES} SELECT * FROM stages",
    "event_log_task_metrics_window": f"""WITH {EVENTS} SELECT tasks.*, jobId FROM tasks JOIN jobs ON tasks.stageId = jobs.stageId
        WHERE launchTime BETWEEN 788918400000 AND 820454399999""",
    "event_log_stage_metrics_window": f"""WITH {EVENT_STAGES} SELECT * FROM stages
        WHERE submissionTime BETWEEN 788918400000 AND 820454399999""",
    "event_log_app_metrics": f"WITH {EVENT_APPS} SELECT * FROM apps",
    "event_log_app_task_metrics": f"""WITH {EVENTS} SELECT app_id, count(*) AS numTasks,
        max(launchTime + duration) - min(launchTime) AS elapsedTime, CAST(sum(duration) AS BIGINT) AS duration,
        {EVENT_SUMS} FROM tasks GROUP BY app_id""",
    "event_log_task_skew": TASK_SKEW,
    "event_log_tag_metrics": EVENT_TAGS,
    "event_log_app_report": f"WITH {EVENT_APPS} " + " UNION ALL ".join(
        f"SELECT app_id, '{name}' AS metric, {name} AS value FROM apps" for name in APP_METRIC_NAMES
    ),
    "event_log_memory_report": f"WITH {EVENT_STAGES} SELECT app_id, jobId, stageId, peakExecutionMemory FROM stages",
    "metrics_report_summary": SUMMARY_ROWS,
    "metrics_report_stages": REPORT_STAGES,
}
