"""Command line: spark-submit skewloom/jobs.py <job> ..., or python -m skewloom.jobs <job> ..."""

from __future__ import annotations

import argparse
import contextlib
import datetime as dt
import os
import sys

if __package__ in (None, ""):
    sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skewloom.operators.logs import parse_logs
from skewloom.operators.skew import SALT_FACTOR, SKEW_FACTOR, make_skew, skew_report
from skewloom.plans import incremental
from skewloom.plans import reviews as review_plans
from skewloom.plans.measured import write_metrics
from skewloom.plans.rides import RIDE_JOBS, TRIP_COLUMNS, WIDE_COLUMNS
from skewloom.session import PROFILES, build_session, measured
from skewloom.sources.readers import list_files, read_csv, read_lines, read_parquet
from skewloom.sources.sinks import convert, write_table
from skewloom.sources.tail import tail_lines
from skewloom.streaming.logs import stream_lines, stream_logs, write_once

# Entities of the review data.
ENTITIES = ("business", "checkin", "review", "tip", "user")


def _look(df: DataFrame, args: argparse.Namespace) -> None:
    if args.explain:
        df.explain("formatted")
    if args.count:
        print(f"rows: {df.count()}")
    if not (args.explain or args.count):
        df.show(truncate=False)


def run_rides(spark: SparkSession, args: argparse.Namespace) -> None:
    job = RIDE_JOBS[args.job]
    trips = read_parquet(spark, args.trips, TRIP_COLUMNS + (WIDE_COLUMNS if job.wide else ()))
    zones = read_csv(spark, args.zones)
    if args.out:
        for path in job.write(spark, trips, zones, args.out, args.day, args.format):
            print(path)
    else:
        tables = job.tables(trips, zones, args.day)
        for name in ("total_trip_time", "hvfhs_license_num"):
            _look(tables[name], args)


def run_totals(spark: SparkSession, args: argparse.Namespace) -> None:
    print(f"files: {incremental.take_in(spark, args.trips, args.state)}")
    zones = read_csv(spark, args.zones)
    _look(incremental.daily_company_totals(spark, args.state, zones) if args.daily else incremental.route_totals(spark, args.state, zones), args)


def run_reviews(spark: SparkSession, args: argparse.Namespace) -> None:
    reviews = read_parquet(spark, args.reviews)
    joined = review_plans.with_business(reviews, read_parquet(spark, args.business), args.strategy)
    if args.users:
        users = read_parquet(spark, args.users)
        if args.copartitioned:
            joined = review_plans.with_users_copartitioned(joined, reviews, users, args.partitions)
        else:
            joined = review_plans.with_users(joined, users)
    _look(joined, args)


def run_make_skew(spark: SparkSession, args: argparse.Namespace) -> None:
    value = F.lit(args.day) if args.day else F.current_date()
    skewed = make_skew(read_parquet(spark, args.reviews), "date", value, args.factor)
    write_table(skewed, args.out)
    print(f"rows: {read_parquet(spark, args.out).count()}")


def run_skew(spark: SparkSession, args: argparse.Namespace) -> None:
    reviews = read_parquet(spark, args.reviews)
    if args.report:
        _look(skew_report(reviews, "date"), args)
        return
    business = read_parquet(spark, args.business)
    if args.salted:
        result = review_plans.salted_skew_query(reviews, business, args.day, args.salt_factor, args.partitions)
    else:
        result = review_plans.skew_query(reviews, business, args.day)
    _look(result, args)


def run_convert(spark: SparkSession, args: argparse.Namespace) -> None:
    source = args.source.rstrip("/")
    convert(spark, {name: f"{source}/{name}/*.json" for name in args.entities}, args.out).show(truncate=False)


def run_metrics(spark: SparkSession, args: argparse.Namespace) -> None:
    for path in write_metrics(spark, args.log, args.out, args.tasks, args.since, args.until, args.parts):
        print(path)


def run_logs(spark: SparkSession, args: argparse.Namespace) -> None:
    if args.progress and args.once:
        lines = (tail_lines if args.follow else stream_lines)(spark, args.source)
        write_once(lines, args.out, args.progress, interval=args.interval).awaitTermination()
    elif args.progress:
        stream_logs(spark, args.source, args.out, args.progress, args.interval, follow=args.follow).awaitTermination()
    else:
        write_table(parse_logs(read_lines(spark, args.source)), args.out, by=["day"])


def run_files(spark: SparkSession, args: argparse.Namespace) -> None:
    list_files(spark, args.source).show(truncate=False)


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="skewloom")
    top.add_argument("--profile", choices=PROFILES, default="adaptive")
    top.add_argument("--event-log", help="folder for the event log of this run")
    top.add_argument("--tag", help="mark this run's jobs in the event log")
    top.add_argument("--delta", action="store_true", help="enable Delta tables; needs its jars")
    top.add_argument("--conf", action="append", default=[], metavar="KEY=VALUE")
    jobs = top.add_subparsers(dest="command", required=True)

    def job(name, run, *required, look=False):
        sub = jobs.add_parser(name)
        sub.set_defaults(run=run)
        for option in required:
            sub.add_argument(option, required=True)
        if look:
            sub.add_argument("--explain", action="store_true")
            sub.add_argument("--count", action="store_true")
        return sub

    day = dt.date.fromisoformat

    sub = job("rides", run_rides, "--trips", "--zones", look=True)
    sub.add_argument("--job", choices=RIDE_JOBS, default="narrow_append")
    sub.add_argument("--out")
    sub.add_argument("--day", type=day)
    sub.add_argument("--format", default="parquet")

    sub = job("totals", run_totals, "--trips", "--zones", "--state", look=True)
    sub.add_argument("--daily", action="store_true", help="by day and company instead of by route")

    sub = job("reviews", run_reviews, "--reviews", "--business", look=True)
    sub.add_argument("--users")
    sub.add_argument("--strategy", choices=("planner", "broadcast", "hint"), default="planner")
    sub.add_argument("--copartitioned", action="store_true")
    sub.add_argument("--partitions", type=int)

    sub = job("make-skew", run_make_skew, "--reviews", "--out")
    sub.add_argument("--day", type=day)
    sub.add_argument("--factor", type=int, default=SKEW_FACTOR)

    sub = job("skew", run_skew, "--reviews", look=True)
    sub.add_argument("--business")
    sub.add_argument("--day", type=day, default=dt.date.today())
    sub.add_argument("--report", action="store_true")
    sub.add_argument("--salted", action="store_true")
    sub.add_argument("--salt-factor", type=int, default=SALT_FACTOR)
    sub.add_argument("--partitions", type=int)

    sub = job("convert", run_convert, "--source", "--out")
    sub.add_argument("--entities", nargs="+", default=list(ENTITIES))

    sub = job("metrics", run_metrics, "--log", "--out")
    sub.add_argument("--tasks", action="store_true")
    sub.add_argument("--since", type=int, help="epoch milliseconds; measure what starts from then on")
    sub.add_argument("--until", type=int, help="epoch milliseconds; measure what starts until then")
    sub.add_argument("--parts", action="store_true", help="also the parts that were tagged, and skewed stages")

    sub = job("logs", run_logs, "--source", "--out")
    sub.add_argument("--progress", help="checkpoint folder; makes the job a stream")
    sub.add_argument("--follow", action="store_true", help="also take in lines that are added to files")
    sub.add_argument("--once", action="store_true", help="drop lines that come again; late and unmatched lines apart")
    sub.add_argument("--interval", help='time between batches, such as "1 minute"; once over all files if left out')

    job("files", run_files, "--source")
    return top


def run_job(spark: SparkSession, args: argparse.Namespace) -> None:
    """The job that `args` names, with its jobs tagged if `--tag` asks for it."""
    with measured(spark, args.tag) if args.tag else contextlib.nullcontext():
        args.run(spark, args)


def main(argv: list[str] | None = None) -> None:
    args = parser().parse_args(argv)
    conf = dict(pair.split("=", 1) for pair in args.conf)
    spark = build_session(f"skewloom-{args.command}", args.profile, conf, args.delta, event_log=args.event_log)
    run_job(spark, args)


if __name__ == "__main__":
    main()
