"""The ride job: trips x zones -> rides -> totals per route and per company -> tables."""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.code_map import COMPANIES, UNKNOWN, row_names, vectorised_names, with_names
from ..functions.measures import row_sum, with_day, with_elapsed
from ..operators.joins import role_join
from ..operators.layout import newest_first
from ..operators.totals import totals, totals_of_keys
from ..session import store
from ..sources.sinks import create_clustered_table, fill_clustered_table, replace_partitions, write_table

# Columns of the trip, zone and ride tables.
COMPANY = "hvfhs_license_num"
TRIP_COLUMNS = (
    "hvfhs_license_num", "PULocationID", "DOLocationID", "request_datetime", "pickup_datetime", "dropoff_datetime",
    "trip_miles", "trip_time", "base_passenger_fare", "tolls", "bcf", "sales_tax", "congestion_surcharge", "tips",
)
WIDE_COLUMNS = ("driver_pay", "shared_request_flag", "shared_match_flag")
FARE_PARTS = ("base_passenger_fare", "tolls", "bcf", "sales_tax", "congestion_surcharge", "tips")
ZONE_KEY = "LocationID"
ZONE_COLUMNS = ("Borough", "Zone")
ROLES = {"PU": "PULocationID", "DO": "DOLocationID"}
ROUTE = ("PU_Borough", "PU_Zone", "DO_Borough", "DO_Zone")
DAY = "ingestion_timestamp"
DURATIONS = ("time_taken_seconds", "time_taken_minutes", "time_taken_hours")
CLUSTERED_COLUMNS = (
    "PU_Borough string, PU_Zone string, DO_Borough string, DO_Zone string, "
    "total_fare double, total_trip_miles double, total_trip_time bigint"
)

# Rides of equal time are told apart by these, so that a very frequent time can be cut into ranges.
TIES = ("pickup_datetime", "dropoff_datetime", "trip_miles", "base_passenger_fare")


def name_companies(trips: DataFrame, form: str, names: dict[str, str] = COMPANIES) -> DataFrame:
    """Company names for license codes. "native" keeps an unlisted code, the UDF forms call it unknown."""
    if form == "native":
        return with_names(trips, COMPANY, names)
    if form == "native_unknown":
        return with_names(trips, COMPANY, names, UNKNOWN)
    if form == "vectorised":
        return trips.withColumn(COMPANY, vectorised_names(names, UNKNOWN)(F.col(COMPANY)))
    if form == "row":
        return trips.withColumn(COMPANY, row_names(names, UNKNOWN)(F.col(COMPANY)))
    if form == "none":
        return trips
    raise ValueError(f"unknown form {form!r}")


def rides(trips: DataFrame, zones: DataFrame, wide: bool = True, hinted: tuple[str, ...] = ()) -> DataFrame:
    """Trips with borough and zone of pick-up and drop-off; trips outside the zones are dropped."""
    kept = TRIP_COLUMNS[3:] + (WIDE_COLUMNS if wide else ())
    joined = role_join(trips.select(*TRIP_COLUMNS[:3], *kept), zones, ZONE_KEY, ROLES, ZONE_COLUMNS, hinted)
    return joined.select(COMPANY, *ROUTE, *kept)


def timed_rides(rides: DataFrame, day: dt.date | None = None) -> DataFrame:
    """Rides with run date and elapsed time."""
    return with_elapsed(with_day(rides, DAY, day), "pickup_datetime", "dropoff_datetime")


def rides_of_boroughs(stored: DataFrame, zones: DataFrame, condition: Column) -> DataFrame:
    """Rides picked up in the boroughs that have a zone with `condition`, from a table partitioned by PU_Borough.

    The filter is on the zones; Spark finds the boroughs first and then reads the partitions of these only.
    """
    wanted = zones.filter(condition).select(F.col("Borough").alias("PU_Borough")).distinct()
    return stored.join(wanted, "PU_Borough", "left_semi")


def ride_sums(timed: bool = False, null_as_zero: bool = False) -> dict[str, Column]:
    """What the totals add up. A ride with a null fare part does not count in total_fare unless `null_as_zero`."""
    sums = {
        "total_fare": row_sum(FARE_PARTS, null_as_zero),
        "total_trip_miles": F.col("trip_miles"),
        "total_trip_time": F.col("trip_time"),
    }
    if timed:
        sums |= {f"total_{name}": F.col(name) for name in DURATIONS}
    return sums


def route_totals(rides: DataFrame, timed: bool = False) -> DataFrame:
    return totals(rides, ((DAY,) if timed else ()) + ROUTE, ride_sums(timed))


def company_totals(rides: DataFrame, timed: bool = False) -> DataFrame:
    return totals(rides, ((DAY,) if timed else ()) + (COMPANY,), ride_sums(timed))


def trip_sums(trips: DataFrame, timed: bool = False) -> DataFrame:
    """Sums per company code and pair of location ids: the rows that all totals are made of, few however many trips."""
    if timed:
        trips = with_elapsed(trips, "pickup_datetime", "dropoff_datetime")
    return totals(trips, (COMPANY, *ROLES.values()), ride_sums(timed))


def route_totals_from_trips(
    trips: DataFrame, zones: DataFrame, timed: bool = False, day: dt.date | None = None, sums: DataFrame | None = None
) -> DataFrame:
    """Route totals of `rides(trips, zones)`, summed per pair of location ids before the zones are joined.

    `sums` are stored `trip_sums`, if these are there already.
    """
    sums = trip_sums(trips, timed) if sums is None else sums
    result = totals_of_keys(sums, zones, ZONE_KEY, ROLES, ZONE_COLUMNS, ride_sums(timed))
    return with_day(result, DAY, day).select(DAY, *result.columns) if timed else result


def company_totals_from_trips(
    trips: DataFrame,
    zones: DataFrame,
    timed: bool = False,
    day: dt.date | None = None,
    naming: str = "none",
    names: dict[str, str] = COMPANIES,
    sums: DataFrame | None = None,
) -> DataFrame:
    """Company totals of `rides(trips, zones)`: summed first; zones and names then meet the sums only."""
    sums = trip_sums(trips, timed) if sums is None else sums
    named = name_companies(sums, naming, names)
    result = totals_of_keys(named, zones, ZONE_KEY, ROLES, ZONE_COLUMNS, ride_sums(timed), [COMPANY])
    return with_day(result, DAY, day).select(DAY, *result.columns) if timed else result


@dataclass(frozen=True)
class RideJob:
    """One way to run the ride job; see `RIDE_JOBS`."""

    naming: str = "native"
    wide: bool = True
    timed: bool = False
    sort: bool = False
    hinted: tuple[str, ...] = ()
    mode: str = "overwrite"
    rides_by: tuple[str, ...] | None = None
    routes_by: tuple[str, ...] | None = None
    companies_by: tuple[str, ...] | None = None
    cluster_by: tuple[str, ...] | None = None

    def rides(self, trips: DataFrame, zones: DataFrame, day: dt.date | None = None) -> DataFrame:
        named = name_companies(trips, self.naming)
        result = rides(named, zones, self.wide, self.hinted)
        return timed_rides(result, day) if self.timed else result

    def tables(
        self, trips: DataFrame, zones: DataFrame, day: dt.date | None = None, sums: DataFrame | None = None
    ) -> dict[str, DataFrame]:
        """The lazy results. Only `rides` is sorted: an order below a total would be a wasted shuffle.

        Totals start from sums per company code and pair of locations, not from the joined rides; `sums` may be given.
        """
        enriched = self.rides(trips, zones, day)
        sums = trip_sums(trips, self.timed) if sums is None else sums
        return {
            "rides": newest_first(enriched, "request_datetime", TIES) if self.sort else enriched,
            "total_trip_time": route_totals_from_trips(trips, zones, self.timed, day, sums),
            "hvfhs_license_num": company_totals_from_trips(trips, zones, self.timed, day, self.naming, sums=sums),
        }

    def write(
        self,
        spark: SparkSession,
        trips: DataFrame,
        zones: DataFrame,
        target: str,
        day: dt.date | None = None,
        fmt: str = "parquet",
        table: str = "route_totals_clustered",
    ) -> list[str]:
        """Write what this job writes under `target`; returns the paths.

        The trips are read twice at most: once for the rides, if they are written, and once for their sums, which are
        stored and feed both totals. All tables have the same day, resolved here if it is not given. In mode "refresh"
        the partitions of this run replace those of an earlier one, so the job may be run again.
        """
        target = target.rstrip("/")
        day = day or spark.sql("SELECT current_date()").first()[0]
        written = {"total_trip_time": self.routes_by, "hvfhs_license_num": self.companies_by}
        summed = any(by is not None for by in written.values()) or self.cluster_by is not None
        results = self.tables(trips, zones, day, store(trip_sums(trips, self.timed), "trip-sums") if summed else None)
        if self.rides_by is not None:
            unsorted = self.rides(trips, zones, day)
            results["rides"] = unsorted if self.rides_by else results["rides"]
            written = {"rides": self.rides_by, **written}
        paths = []
        for name, by in written.items():
            if by is None:
                continue
            # One run has one day, so each task writes one file and rebalancing would only move all rows once more.
            rebalance = by != (DAY,)
            path = f"{target}/{name}"
            if self.mode == "refresh":
                replace_partitions(results[name], path, by, fmt, rebalance)
            else:
                write_table(results[name], path, fmt, self.mode, by, rebalance)
            paths.append(path)
        if self.cluster_by is not None:
            path = f"{target}/cluster/{table.split('.')[-1]}"
            create_clustered_table(spark, table, CLUSTERED_COLUMNS, self.cluster_by, path, fmt)
            fill_clustered_table(results["total_trip_time"], table, self.cluster_by, self.mode == "overwrite")
            paths.append(path)
        return paths


_APPENDED = {"mode": "append", "rides_by": (DAY,), "routes_by": (DAY,), "companies_by": (COMPANY,)}
_REFRESHED = {"mode": "refresh", "rides_by": (DAY,), "routes_by": (DAY,), "companies_by": (DAY,)}

# One entry per way the job is run, from the slowest coding to the fastest.
RIDE_JOBS = {
    "row_udf": RideJob("row", sort=True),
    "vectorised_udf": RideJob("vectorised", sort=True),
    "native": RideJob(),
    "partitioned_overwrite": RideJob(routes_by=("PU_Borough",), companies_by=(COMPANY,)),
    "clustered_table": RideJob(cluster_by=("PU_Borough",)),
    "row_udf_append": RideJob("row", timed=True, sort=True, **_APPENDED),
    "narrow_append": RideJob(wide=False, timed=True, **_APPENDED),
    "hinted_append": RideJob(wide=False, timed=True, hinted=("PU",), **_APPENDED),
    "narrow_refresh": RideJob(wide=False, timed=True, **_REFRESHED),
    "sorted_overwrite": RideJob("none", sort=True, rides_by=()),
}
