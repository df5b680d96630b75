"""Code -> name columns in three forms: native expression (the default), vectorised UDF, row-at-a-time UDF."""

from __future__ import annotations

from collections.abc import Mapping
from itertools import chain

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Ride company by license code, and the name of a company whose code is not listed.
COMPANIES = {
    "HV0002": "Juno",
    "HV0003": "Uber",
    "HV0004": "Via",
    "HV0005": "Lyft",
}
UNKNOWN = "Unknown"


def name_of(code: Column, names: Mapping[str, str], default: str | None = None) -> Column:
    """Native form. A code that is not listed becomes `default`; with no default it stays as it is, null included."""
    table = F.create_map(*[F.lit(part) for part in chain.from_iterable(names.items())])
    return F.coalesce(F.try_element_at(table, code), code if default is None else F.lit(default))


def with_names(df: DataFrame, column: str, names: Mapping[str, str], default: str | None = None) -> DataFrame:
    """Replace a code column by its names."""
    return df.withColumn(column, name_of(F.col(column), names, default))


def vectorised_names(names: Mapping[str, str], default: str):
    """Pandas UDF over Arrow batches."""
    table = dict(names)

    @F.pandas_udf("string")
    def look_up(codes: pd.Series) -> pd.Series:
        return codes.map(table).astype(object).fillna(default)

    return look_up


def row_names(names: Mapping[str, str], default: str):
    """Row-at-a-time UDF, the slowest form; here to be compared with the others."""
    table = dict(names)
    return F.udf(lambda code: table.get(code, default), "string", useArrow=False)


def register_names(spark: SparkSession, sql_name: str, names: Mapping[str, str], default: str):
    """Make the row form callable from SQL text."""
    return spark.udf.register(sql_name, row_names(names, default))
