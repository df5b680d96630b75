"""Grouped sums."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .joins import role_join


def totals(df: DataFrame, by: Sequence[str], sums: Mapping[str, Column]) -> DataFrame:
    """One row per group with a sum per measure; each task sums its own rows first, so a hot group costs no more."""
    return df.groupBy(*by).agg(*[F.sum(value).alias(name) for name, value in sums.items()])


def totals_by_role(
    fact: DataFrame,
    dimension: DataFrame,
    key: str,
    roles: Mapping[str, str],
    columns: Sequence[str],
    sums: Mapping[str, Column],
) -> DataFrame:
    """The same as `totals` over `role_join`, but summed per key before the dimension is joined.

    The joins then see one row per combination of keys instead of one per fact row, and the first grouping hashes
    numbers instead of names.
    """
    return totals_of_keys(totals(fact, [*roles.values()], sums), dimension, key, roles, columns, sums)


def totals_of_keys(
    per_key: DataFrame,
    dimension: DataFrame,
    key: str,
    roles: Mapping[str, str],
    columns: Sequence[str],
    names: Iterable[str],
    by: Sequence[str] | None = None,
) -> DataFrame:
    """Totals by the dimension's columns in each role, or `by` others, from sums `names` per combination of keys."""
    named = role_join(per_key, dimension, key, roles, columns)
    by = [f"{role}_{column}" for role in roles for column in columns] if by is None else by
    return totals(named, by, {name: F.col(name) for name in names})


def row_counts(frames: Mapping[str, DataFrame]) -> DataFrame:
    """One row (name, rows) per frame; over Parquet only footers are read."""
    result = None
    for name, frame in frames.items():
        count = frame.agg(F.count(F.lit(1)).alias("rows")).select(F.lit(name).alias("name"), "rows")
        result = count if result is None else result.unionByName(count)
    return result
