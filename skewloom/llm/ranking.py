"""Positions of rows within groups of any size."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import store


def numbered(rows: DataFrame, group: str, order: Sequence[str], label: str) -> DataFrame:
    """`rows` with `position`, from 0 on in each group by `order` (nulls first), and `size`, the rows of the group.

    `rows` should be a stored table, since it is read twice, and `group` must not be null. Rows are sorted over the whole
    table by ranges and stored with their place, so a group of a third of all rows is spread over many tasks; only the
    number of rows that each task has of each group is then added up. Rows that are equal in `order` are told apart by
    their place in the input, so that ranges can cut them too.
    """
    keys = [group, *order, "_tie"]
    ranged = rows.withColumn("_tie", F.monotonically_increasing_id()).repartitionByRange(*keys).sortWithinPartitions(*keys)
    placed = store(ranged.drop("_tie").withColumn("_at", F.monotonically_increasing_id()), label)
    part = F.shiftright("_at", 33).alias("_part")  # monotonically_increasing_id holds the partition above bit 33
    runs = placed.groupBy(group, part).agg(F.min("_at").alias("_from"), F.count(F.lit(1)).alias("_n"))
    # One row for each task that has rows of the group.
    of_group = Window.partitionBy(group)
    earlier = of_group.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    shift = F.coalesce(F.sum("_n").over(earlier), F.lit(0)) - F.col("_from")
    starts = runs.select(group, "_part", shift.alias("_shift"), F.sum("_n").over(of_group).alias("size"))
    joined = placed.withColumn("_part", part).join(starts, [group, "_part"])
    return joined.withColumn("position", F.col("_at") + F.col("_shift")).drop("_at", "_part", "_shift")
