"""Finding, making and repairing skew."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.salt import row_salt
from ..session import small_frame
from .joins import align

# Salts over a whole table, and copies made of each row.
SALT_FACTOR = 400
SKEW_FACTOR = 5

# Key types that Spark's frequent-items sketch takes, the most items it can track, and sketches in the last merge.
SKETCHED = (T.StringType, T.LongType, T.IntegerType, T.ShortType, T.ByteType, T.DateType)
SKETCH_LIMIT = 1_000_000
SKETCH_MARGIN = 25
SKETCH_GROUPS = 256


def skew_report(df: DataFrame, column: str) -> DataFrame:
    """Rows per value, most frequent first."""
    counts = df.groupBy(column).agg(F.count(F.lit(1)).alias("qtd"))
    return counts.orderBy(F.col("qtd").desc(), column)


def make_skew(df: DataFrame, column: str, value: Column, factor: int = SKEW_FACTOR) -> DataFrame:
    """All rows of `df`, and `factor` copies of each with `column` set to `value`.

    Original and copies come from one evaluation of `df`, whatever the factor. `value` is cast to the column's type,
    which is thereby kept.
    """
    marked = df.withColumn("_copy", F.explode(F.sequence(F.lit(0), F.lit(factor))))
    value = value.cast(df.schema[column].dataType)
    return marked.withColumn(column, F.when(F.col("_copy") == 0, F.col(column)).otherwise(value)).drop("_copy")


def with_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows that an inner join on `keys` can match: those without a null key."""
    for key in keys:
        df = df.filter(F.col(key).isNotNull())
    return df


def hot_keys(df: DataFrame, keys: str | Sequence[str], salt_factor: int = SALT_FACTOR) -> DataFrame:
    """Keys holding more than 1/salt_factor of the rows, with the number of salts each needs in column `_salts`.

    A key with a share s of the rows gets ceil(s * salt_factor) salts, so every salted group is about 1/salt_factor of
    the table. There can be no more than `salt_factor` such keys: the result is small however large the table is.
    A salt factor for which Spark's sketch could not track enough keys is refused.
    """
    if not 1 <= salt_factor <= SKETCH_LIMIT // SKETCH_MARGIN:
        raise ValueError(f"salt_factor must be from 1 to {SKETCH_LIMIT // SKETCH_MARGIN}")
    keys = [keys] if isinstance(keys, str) else list(keys)
    rows = with_keys(df, keys)
    if len(keys) == 1 and isinstance(df.schema[keys[0]].dataType, SKETCHED):
        counts = _frequent(rows, keys[0], salt_factor)
    else:
        counts = rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("_rows"))
        counts = counts.withColumn("_total", counts.agg(F.sum("_rows")).scalar())
    scaled = F.col("_rows") * F.lit(salt_factor)
    hot = counts.filter(scaled > F.col("_total"))
    return hot.select(*keys, F.ceil(scaled / F.col("_total")).cast("int").alias("_salts"))


def _frequent(rows: DataFrame, key: str, salt_factor: int) -> DataFrame:
    """Frequent keys (key, _rows, _total), with counts estimated by a frequent-items sketch.

    Grouping by the key would shuffle every distinct key of every task only to drop nearly all of them; a task's sketch
    has a fixed size. It is large enough to catch each key with more than a fifth of the share asked for. The sketches
    are merged in two steps, so that no task receives those of all others. The counts only choose the salts: the rows
    of a salted join are the same whatever they are.
    """
    tracked = SKETCH_MARGIN * salt_factor
    some = F.pmod(F.spark_partition_id(), F.lit(SKETCH_GROUPS))
    sketches = rows.groupBy(some.alias("_part")).agg(
        F.expr(f"approx_top_k_accumulate(`{key}`, {tracked})").alias("sketch"), F.count(F.lit(1)).alias("_total")
    )
    # Grouped by a constant, since merging without a group fails on a task that has no sketch to merge.
    top = sketches.groupBy(F.lit(1)).agg(
        F.expr(f"approx_top_k_estimate(approx_top_k_combine(sketch, {tracked}), {salt_factor})").alias("top"),
        F.sum("_total").alias("_total"),
    )
    found = top.select("_total", F.inline("top"))
    return found.select(F.col("item").alias(key), F.col("count").alias("_rows"), "_total")


def salt_sides(
    left: DataFrame, right: DataFrame, keys: Sequence[str], hot: DataFrame, salt_on: Sequence[str] | None = None
) -> tuple[DataFrame, DataFrame]:
    """Add `_salt` to both sides of a join on `keys`.

    A left row with a hot key draws one of that key's salts; a right row with a hot key appears once per salt; all other
    rows have salt 0. So each pair meets exactly once and the join loses nothing. `hot` must come from `hot_keys`, whose
    size has a bound, so it is broadcast. `salt_on` names the left columns the salt is drawn from, default all.
    """
    keys = list(keys)
    columns = salt_on or left.columns
    salt = F.coalesce(row_salt(F.col("_salts"), columns), F.lit(0))
    left = with_keys(left, keys).join(F.broadcast(hot), keys, "left")
    left = left.withColumn("_salt", salt).drop("_salts")
    every_salt = F.explode(F.sequence(F.lit(0), F.coalesce(F.col("_salts"), F.lit(1)) - 1))
    right = with_keys(right, keys).join(F.broadcast(hot), keys, "left")
    right = right.withColumn("_salt", every_salt).drop("_salts")
    return left, right


def salted_join(
    left: DataFrame,
    right: DataFrame,
    on: Mapping[str, str],
    hot: DataFrame | None = None,
    salt_factor: int = SALT_FACTOR,
    salt_on: Sequence[str] | None = None,
    prefix: str = "right_",
) -> DataFrame:
    """Inner join whose hot keys are spread over many tasks; the same rows as the plain join.

    Without `hot` a first job looks for the left side's hot keys (reading that column only), of which there are at most
    `salt_factor`; if there are none, this is the plain join. Filter `left` before, not after: a condition on a salted column cannot reach the scan.
    """
    keys = list(on)
    right = align(left, right, on, prefix)
    hot = small_frame(hot_keys(left, keys, salt_factor), salt_factor) if hot is None else hot
    if hot.isEmpty():
        return left.join(right, keys, "inner")
    left, right = salt_sides(left, right, keys, hot, salt_on)
    return left.join(right, [*keys, "_salt"], "inner").drop("_salt")


def grid_sides(left: DataFrame, right: DataFrame, keys: Sequence[str], hot: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Add `_row` and `_column` to both sides of a join on `keys`.

    A hot key has a grid of `_rows` x `_columns` cells. A left row draws a row of the grid and appears in each of its cells, a
    right row draws a column and appears in each of its cells, so each pair meets in exactly one cell. All other keys have
    one cell. `hot` has a bounded number of rows and is broadcast.
    """

    def dealt(df: DataFrame, own: str, other: str, drawn: str, repeated: str) -> DataFrame:
        columns = df.columns
        marked = with_keys(df, keys).join(F.broadcast(hot), list(keys), "left")
        cells = F.sequence(F.lit(0), F.coalesce(F.col(other), F.lit(1)) - 1)
        marked = marked.withColumn(drawn, F.coalesce(row_salt(F.col(own), columns), F.lit(0)))
        return marked.withColumn(repeated, F.explode(cells)).drop("_rows", "_columns")

    return dealt(left, "_rows", "_columns", "_row", "_column"), dealt(right, "_columns", "_rows", "_column", "_row")


def hot_grid(
    left: DataFrame, right: DataFrame, keys: Sequence[str], edge: int, salt_factor: int = SALT_FACTOR
) -> DataFrame:
    """(keys, _rows, _columns) of the keys that hold more than 1/salt_factor of a side's rows; no edge beyond `edge`.

    The sides' sketches are made apart: rows follow the key's share of the left side, columns its share of the right.
    """
    found = [small_frame(hot_keys(side, keys, salt_factor), salt_factor) for side in (left, right)]
    sides = [df.withColumnRenamed("_salts", name) for df, name in zip(found, ("_rows", "_columns"))]
    edges = [F.least(F.coalesce(name, F.lit(1)), F.lit(edge)).alias(name) for name in ("_rows", "_columns")]
    return small_frame(sides[0].join(sides[1], list(keys), "full").select(*keys, *edges), 2 * salt_factor)


def grid_join(
    left: DataFrame,
    right: DataFrame,
    on: Mapping[str, str],
    edge: int = 20,
    hot: DataFrame | None = None,
    salt_factor: int = SALT_FACTOR,
    prefix: str = "right_",
    totals: Mapping[str, Column] | None = None,
) -> DataFrame:
    """Inner join for keys that are hot on both sides; the same rows as the plain join.

    `salted_join` repeats a hot key's right rows once for each of up to `salt_factor` salts, which is dear where they are
    many. Here a row is repeated `edge` times at most, on either side, and a hot key is still spread over up to edge x edge
    tasks. Without `hot` (see `hot_grid`) two first jobs look for the hot keys, reading the key columns only.

    Pairs of a key that is hot on both sides are as many as the product of its rows. Where only sums over the pairs are wanted,
    `totals` (name -> aggregate of right columns, under the names they have in the result) takes a key's right rows together in
    each cell before the left rows meet them: the result has these columns in place of the right ones, and a left row appears
    once for each cell in which it has partners. Their sums over all cells are those over all pairs.
    """
    keys, place = list(on), []
    right = align(left, right, on, prefix)
    hot = hot_grid(left, right, keys, edge, salt_factor) if hot is None else hot
    if not hot.isEmpty():
        left, right = grid_sides(left, right, keys, hot)
        place = ["_row", "_column"]
    if totals:
        right = right.groupBy(*keys, *place).agg(*[value.alias(name) for name, value in totals.items()])
    return left.join(right, [*keys, *place], "inner").drop(*place)


def bucketed_sides(
    left: DataFrame,
    right: DataFrame,
    on: Mapping[str, str],
    tables: tuple[str, str],
    buckets: int,
    hot: DataFrame | None = None,
    salt_factor: int = SALT_FACTOR,
    prefix: str = "right_",
    paths: tuple[str, str] | None = None,
) -> None:
    """Store both sides of a join as tables bucketed and sorted by the keys and a salt.

    `bucketed_join` then joins them as often as is wanted without a shuffle; its tasks only sort rows that are in order.
    A hot key's left rows are spread over
    its salts, and with them over buckets; its right rows are stored once for each. One task writes one bucket, so that a
    bucket is one sorted file. `paths` makes the tables external.
    """
    keys = list(on)
    right = align(left, right, on, prefix)
    hot = small_frame(hot_keys(left, keys, salt_factor), salt_factor) if hot is None else hot
    for number, side in enumerate(salt_sides(left, right, keys, hot)):
        writer = side.repartition(buckets, *keys, "_salt").write.format("parquet").mode("overwrite")
        writer = writer.bucketBy(buckets, *keys, "_salt").sortBy(*keys, "_salt")
        (writer.option("path", paths[number]) if paths else writer).saveAsTable(tables[number])


def bucketed_join(spark: SparkSession, tables: tuple[str, str], keys: Sequence[str]) -> DataFrame:
    """The join of two tables that `bucketed_sides` stored."""
    left, right = (spark.table(name) for name in tables)
    return left.join(right.hint("merge"), [*keys, "_salt"], "inner").drop("_salt")


def copartitioned_join(
    left: DataFrame,
    right: DataFrame,
    on: Mapping[str, str],
    partitions: int | None = None,
    hot: DataFrame | None = None,
    salt_factor: int = SALT_FACTOR,
    salt_on: Sequence[str] | None = None,
    prefix: str = "right_",
) -> DataFrame:
    """Join after partitioning both sides alike, so that the join itself shuffles nothing.

    AQE does not split a partition the user asked for, so hot keys are salted here and the salt is part of the
    partitioning. Without `partitions` the session's shuffle setting applies and AQE may merge small partitions.
    """
    keys = list(on)
    right = align(left, right, on, prefix)
    hot = small_frame(hot_keys(left, keys, salt_factor), salt_factor) if hot is None else hot
    salted = keys
    if not hot.isEmpty():
        left, right = salt_sides(left, right, keys, hot, salt_on)
        salted = [*keys, "_salt"]
    layout = [*([partitions] if partitions else []), *salted]
    joined = left.repartition(*layout).join(right.repartition(*layout).hint("merge"), salted, "inner")
    return joined.drop("_salt")
