"""Scans. Every reader takes any path or glob Spark can open (local, HDFS, S3A, ...) and is lazy."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def read_parquet(spark: SparkSession, glob: str, columns: Sequence[str] | None = None) -> DataFrame:
    """All columns, or only `columns`, in which case the scan reads nothing else."""
    df = spark.read.parquet(glob)
    return df.select(*columns) if columns else df


def read_csv(spark: SparkSession, glob: str, schema: str | None = None, delimiter: str = ",") -> DataFrame:
    """Delimited text with a header. Without a schema all columns are strings named by the header."""
    reader = spark.read.option("header", True).option("delimiter", delimiter)
    if schema:
        # The header is matched by name, so a file with other or reordered columns fails instead of shifting.
        reader = reader.schema(schema).option("enforceSchema", False)
    return reader.csv(glob)


def read_json(spark: SparkSession, glob: str, schema: str | None = None, sample: float | None = None) -> DataFrame:
    """JSON lines. Without a schema Spark infers one, which costs a pass over all of the input or over a `sample`."""
    reader = spark.read
    if schema:
        reader = reader.schema(schema)
    elif sample:
        reader = reader.option("samplingRatio", sample)
    return reader.json(glob)


def read_lines(spark: SparkSession, glob: str) -> DataFrame:
    return spark.read.text(glob)


def read_event_log(spark: SparkSession, glob: str) -> DataFrame:
    """Lines of plain (uncompressed) Spark event logs with the application they come from.

    The file's name names it. A rolled log is a folder of parts events_<n>_<application> and an empty status file; all
    parts belong to the one application.
    """
    file = F.col("_metadata.file_name")
    name = F.regexp_replace(file, r"^events_\d+_|(\.compact)?(\.inprogress)?$", "")
    return spark.read.text(glob).filter(~file.startswith("appstatus_")).select(name.alias("app_id"), "value")


def list_files(spark: SparkSession, glob: str) -> DataFrame:
    """One row per file that matches. The content column is not selected, so no file is opened."""
    return spark.read.format("binaryFile").load(glob).select("path", "length", "modificationTime")


def register_views(**frames: DataFrame) -> None:
    """Name frames for use in SQL text; the library itself passes frames as arguments."""
    for name, frame in frames.items():
        frame.createOrReplaceTempView(name)
