"""Salts. They must come out the same when a lost task runs again, or rows would be lost or doubled."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F


def row_salt(pieces: Column | int, columns: Iterable[str]) -> Column:
    """A number in [0, pieces) from the row's values and its input partition.

    A retried task sees the same partition with the same rows, maybe in another order, so the salt does not change; a
    rand() drawn behind a shuffle could. The partition number also spreads rows that are copies of one another.
    """
    pieces = F.lit(pieces) if isinstance(pieces, int) else pieces
    return F.pmod(F.xxhash64(*[F.col(c) for c in columns], F.spark_partition_id()), pieces.cast("bigint")).cast("int")


def salted_text(key: Column, salt: Column) -> Column:
    """`key_salt` as text; null when the key is null."""
    return F.concat(key.cast("string"), F.lit("_"), salt.cast("string"))
