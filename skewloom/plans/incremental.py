"""Ride totals that are kept up to date: stored sums, to which only new trip files are added.

A state folder holds `sums`, partitioned by increment: sums per pick-up day, company code and pair of location ids; and
`files`, partitioned likewise: the trip files that an increment took in. The list of files is written last and decides: an
increment without it does not count, and its number is used again, so a run that fails leaves no trace and may be repeated.
One writer at a time.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.totals import totals, totals_of_keys
from ..session import store
from ..sources.readers import list_files
from ..sources.sinks import replace_partitions, write_table
from . import rides

TRIP_DAY = "trip_day"
FILES_SCHEMA = "path string, length bigint, modificationTime timestamp, increment bigint"
KEYS = (TRIP_DAY, rides.COMPANY, *rides.ROLES.values())


def taken_in(spark: SparkSession, state: str) -> DataFrame:
    """The files of all finished increments."""
    try:
        return spark.read.schema(FILES_SCHEMA).parquet(f"{state.rstrip('/')}/files")
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], FILES_SCHEMA)


def take_in(spark: SparkSession, glob: str, state: str) -> int:
    """Add the trip files that match `glob` and were not taken in before; returns how many there were.

    A file is known by its path, whatever its time; trip files are not changed once they are written.
    """
    state = state.rstrip("/")
    known = taken_in(spark, state)
    new = store(list_files(spark, glob).join(known.select("path"), "path", "left_anti").dropDuplicates(["path"]), "new-files")
    paths = [row["path"] for row in new.select("path").toLocalIterator()]  # names, as the scan below needs them
    if not paths:
        return 0
    number = (known.agg(F.max("increment")).first()[0] or 0) + 1
    trips = spark.read.parquet(*paths).select(*rides.TRIP_COLUMNS).withColumn(TRIP_DAY, F.to_date("pickup_datetime"))
    sums = totals(trips, KEYS, rides.ride_sums()).withColumn("increment", F.lit(number).cast("long"))
    replace_partitions(sums, f"{state}/sums", ["increment"])
    replace_partitions(new.withColumn("increment", F.lit(number).cast("long")), f"{state}/files", ["increment"], rebalance=False)
    return len(paths)


def stored_sums(spark: SparkSession, state: str) -> DataFrame:
    """Sums of all finished increments, in the form of `rides.trip_sums` per day."""
    state = state.rstrip("/")
    done = taken_in(spark, state).select("increment").distinct()
    parts = spark.read.parquet(f"{state}/sums")
    measures = {name: F.col(name) for name in rides.ride_sums()}
    return totals(parts.join(F.broadcast(done), "increment", "left_semi"), KEYS, measures)  # a row for each increment


def route_totals(spark: SparkSession, state: str, zones: DataFrame) -> DataFrame:
    """Totals per route over everything taken in, from the stored sums only."""
    sums = totals(stored_sums(spark, state), (rides.COMPANY, *rides.ROLES.values()), {n: F.col(n) for n in rides.ride_sums()})
    return rides.route_totals_from_trips(None, zones, sums=sums)


def daily_company_totals(spark: SparkSession, state: str, zones: DataFrame) -> DataFrame:
    """Totals per pick-up day and company."""
    sums = stored_sums(spark, state)
    return totals_of_keys(sums, zones, rides.ZONE_KEY, rides.ROLES, rides.ZONE_COLUMNS, rides.ride_sums(), [TRIP_DAY, rides.COMPANY])


def compact(spark: SparkSession, state: str, target: str) -> None:
    """Write the state anew below `target` with one increment, so that old increments cost nothing any more."""
    target = target.rstrip("/")
    one = F.lit(1).cast("long")
    write_table(stored_sums(spark, state).withColumn("increment", one), f"{target}/sums", by=["increment"])
    write_table(taken_in(spark, state).withColumn("increment", one), f"{target}/files", by=["increment"], rebalance=False)
