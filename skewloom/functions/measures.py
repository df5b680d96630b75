"""Derived columns: elapsed time, run date, null-aware row sums, key casts."""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable
from functools import reduce
from operator import add

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def with_elapsed(df: DataFrame, start: str, end: str, prefix: str = "time_taken") -> DataFrame:
    """Whole seconds from `start` to `end` (negative when end comes first), and the same in minutes and hours."""
    seconds = F.unix_timestamp(F.col(end)) - F.unix_timestamp(F.col(start))
    return df.withColumns(
        {
            f"{prefix}_seconds": seconds,
            f"{prefix}_minutes": seconds / 60,
            f"{prefix}_hours": seconds / 3600,
        }
    )


def with_day(df: DataFrame, column: str, day: dt.date | None = None) -> DataFrame:
    """A constant date column: `day`, or the date of the run."""
    return df.withColumn(column, F.current_date() if day is None else F.lit(day))


def row_sum(columns: Iterable[str], null_as_zero: bool = False) -> Column:
    """Sum over the columns of a row. One null makes the sum null unless `null_as_zero`."""
    parts = [F.coalesce(F.col(c), F.lit(0)) if null_as_zero else F.col(c) for c in columns]
    return reduce(add, parts)


def key_number(key: Column) -> Column:
    """A join key as bigint. Text that is no number becomes null, which joins nothing, instead of failing the job."""
    return key.try_cast("bigint")
