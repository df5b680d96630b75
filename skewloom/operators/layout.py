"""Physical layout: what the partitions look like."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

CURVE_BITS = 8
SAMPLE = 20


def partition_profile(df: DataFrame) -> DataFrame:
    """One row (partition, rows) per non-empty partition."""
    return df.groupBy(F.spark_partition_id().alias("partition")).agg(F.count(F.lit(1)).alias("rows"))


def fewer_partitions(df: DataFrame, partitions: int) -> DataFrame:
    """Merge partitions without a shuffle. The stage before then runs with that few tasks too."""
    return df.coalesce(partitions)


def range_ranks(df: DataFrame, by: Sequence[str], bits: int = CURVE_BITS) -> dict[str, Column]:
    """For each column a rank, 0 to 2**bits - 1: the number of cuts below the value; nulls rank 0.

    The cuts are quantiles of a sample of some SAMPLE rows for each rank, read by a pass over these columns only. They shape a
    layout, and no result depends on them. A rank is found by bisection, in as many steps as it has bits.
    """
    rows = df.count()
    share = min(1.0, SAMPLE * (1 << bits) / max(1, rows))
    sample = df.select(*by).sample(fraction=share, seed=1).collect()
    steps = F.array(*[F.lit(1 << bit) for bit in reversed(range(bits))])
    ranks = {}
    for column in by:
        values = sorted(row[column] for row in sample if row[column] is not None and row[column] == row[column])
        if not values:
            ranks[column] = F.lit(0)
            continue
        cuts = F.array(*[F.lit(values[n * len(values) >> bits]) for n in range(1, 1 << bits)])
        value = F.col(column)
        ranks[column] = F.aggregate(steps, F.lit(0), lambda r, s: F.when(value > F.element_at(cuts, r + s), r + s).otherwise(r))  # noqa: B023
    return ranks


def curve_position(df: DataFrame, by: Sequence[str], bits: int = CURVE_BITS) -> Column:
    """The place of a row on a space-filling curve (Z order): the interleaved bits of the `range_ranks` of the columns.

    Each column cuts the rows into ranges of like size, however its values are spread.
    """
    if not by or bits * len(by) > 62:
        raise ValueError("the ranks of all columns must fit into 62 bits")
    position = F.lit(0).cast("long")
    for number, rank in enumerate(range_ranks(df, by, bits).values()):
        for bit in range(bits):
            own = F.shiftright(rank, bit).bitwiseAND(1).cast("long")
            position = position.bitwiseOR(F.call_function("shiftleft", own, F.lit(bit * len(by) + number)))
    return position


def newest_first(df: DataFrame, column: str, ties: tuple[str, ...] = ()) -> DataFrame:
    """Sort the whole frame. `ties` order rows of equal time and let Spark cut a very frequent time into ranges."""
    return df.orderBy(F.col(column).desc(), *ties)
