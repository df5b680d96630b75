"""Inner equi joins under different shuffle strategies.

All of them return the same rows. The key columns keep the left side's names and appear once; other right-hand columns
whose names are taken get a prefix, so that every result can be written.
"""

from __future__ import annotations

import logging
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.measures import key_number

BROADCAST_ROWS = 1_000_000
BROADCAST_BYTES = 64 * 1024 * 1024


def fits_broadcast(df: DataFrame, max_rows: int = BROADCAST_ROWS, max_bytes: int = BROADCAST_BYTES) -> bool:
    """Measure whether `df` may be sent to every executor: runs one job over it. A refusal is logged.

    A frame that is costly to compute should be stored first.
    """
    row_size = F.octet_length(F.to_json(F.struct("*")))
    found = df.agg(F.count(F.lit(1)).alias("rows"), F.coalesce(F.sum(row_size), F.lit(0)).alias("size")).first()
    fits = found["rows"] <= max_rows and found["size"] <= max_bytes
    if not fits:
        logging.getLogger(__name__).warning("not broadcast: %d rows, about %d bytes", found["rows"], found["size"])
    return fits


def align(left: DataFrame, right: DataFrame, on: Mapping[str, str], prefix: str) -> DataFrame:
    """`right` with its keys named as in `left` and its clashing columns prefixed."""
    left_name = {theirs: ours for ours, theirs in on.items()}
    taken = set(left.columns) | set(on)
    names = [left_name.get(c) or (f"{prefix}{c}" if c in taken else c) for c in right.columns]
    return right.toDF(*names)


def equi_join(
    left: DataFrame,
    right: DataFrame,
    on: Mapping[str, str],
    strategy: str = "planner",
    prefix: str = "right_",
    max_rows: int = BROADCAST_ROWS,
    max_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """Join on {left column: right column}.

    "planner" lets Spark choose from statistics and, with AQE, from the sizes seen at run time.
    "broadcast" and "hint" send the right side to every executor, through the function or the hint, but only after
    `fits_broadcast` has measured it against `max_rows` and `max_bytes`; a larger side is left to the planner.
    """
    right = align(left, right, on, prefix)
    if strategy not in ("planner", "broadcast", "hint"):
        raise ValueError(f"unknown join strategy {strategy!r}")
    if strategy != "planner" and fits_broadcast(right, max_rows, max_bytes):
        right = F.broadcast(right) if strategy == "broadcast" else right.hint("broadcast")
    return left.join(right, list(on), "inner")


def role_join(
    fact: DataFrame,
    dimension: DataFrame,
    key: str,
    roles: Mapping[str, str],
    columns: Sequence[str],
    hinted: Sequence[str] = (),
    max_rows: int = BROADCAST_ROWS,
    max_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """Join one dimension once per role, e.g. roles={"PU": "pickup_id", "DO": "dropoff_id"}.

    The result has the fact's columns and `<role>_<column>` for each dimension column; a fact row that misses the
    dimension in any role is dropped. The dimension key is cast once, to the type of the cast fact keys, so a dimension
    that Spark broadcasts is sent once and serves all roles. A role in `hinted` gets a broadcast hint if the dimension
    is within `max_rows` and `max_bytes`; otherwise Spark decides by its size threshold, and beyond it shuffles.
    """
    keyed = dimension.select(key_number(F.col(key)).alias(key), *columns)
    hint = bool(hinted) and fits_broadcast(keyed, max_rows, max_bytes)
    for role, fact_key in roles.items():
        side = keyed.select(F.col(key).alias(f"_{role}"), *[F.col(c).alias(f"{role}_{c}") for c in columns])
        if hint and role in hinted:
            side = side.hint("broadcast")
        fact = fact.join(side, key_number(F.col(fact_key)) == F.col(f"_{role}"), "inner").drop(f"_{role}")
    return fact
