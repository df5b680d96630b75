"""The review jobs: reviews x business x users, on even and on skewed data."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.joins import equi_join
from ..operators.layout import fewer_partitions
from ..operators.skew import SALT_FACTOR, copartitioned_join, hot_keys, salted_join
from ..session import small_frame, store

BUSINESS_KEY = {"business_id": "business_id"}
USER_KEY = {"user_id": "user_id"}
# Columns of the skew query.
SKEW_COLUMNS = ("review_id", "user_id", "date", "name", "city")


def with_business(reviews: DataFrame, business: DataFrame, strategy: str = "planner") -> DataFrame:
    return equi_join(reviews, business, BUSINESS_KEY, strategy, "business_")


def with_users(reviews: DataFrame, users: DataFrame) -> DataFrame:
    """The second join, by the strategy Spark chooses."""
    return equi_join(reviews, users, USER_KEY, prefix="user_")


def with_users_copartitioned(
    with_business: DataFrame, reviews: DataFrame, users: DataFrame, partitions: int | None = None
) -> DataFrame:
    """The second join over two sides partitioned alike. Hot users are looked for in `reviews`, before any join."""
    hot = small_frame(hot_keys(reviews, "user_id"), SALT_FACTOR)
    return copartitioned_join(with_business, users, USER_KEY, partitions, hot, prefix="user_")


def on_date(reviews: DataFrame, day: dt.date) -> DataFrame:
    return reviews.filter(F.col("date") == F.lit(day))


def on_dates_like(reviews: DataFrame, start: str) -> DataFrame:
    """Reviews whose date, as text, starts with `start`, such as "2024-06"."""
    return reviews.filter(F.col("date").cast("string").startswith(start))


def skew_query(reviews: DataFrame, business: DataFrame, day: dt.date) -> DataFrame:
    """Reviews of one day with their business; the date is filtered in the scan, before the join."""
    return with_business(on_date(reviews, day), business).select(*SKEW_COLUMNS)


def salted_skew_query(
    reviews: DataFrame,
    business: DataFrame,
    day: dt.date | str,
    salt_factor: int = SALT_FACTOR,
    partitions: int | None = None,
) -> DataFrame:
    """The same result with hot businesses salted, in `partitions` partitions if given; `day` may be the start of a date.

    With `partitions` the joined rows are stored first: only their scan runs in that few tasks, not the join and its sorts.
    """
    chosen = on_dates_like(reviews, day) if isinstance(day, str) else on_date(reviews, day)
    slim = chosen.select("review_id", "user_id", "business_id", "date")
    joined = salted_join(slim, business, BUSINESS_KEY, salt_factor=salt_factor, prefix="business_")
    joined = joined.select(*SKEW_COLUMNS)
    return fewer_partitions(store(joined, "salted-join"), partitions) if partitions else joined
