"""Sinks. `fmt` is any installed table format: parquet by default, delta where its jars are present."""

from __future__ import annotations

import sys
from collections.abc import Iterator, Mapping, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyarrow.fs import FileSelector
from pyarrow.parquet import ParquetFile
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from ..operators.layout import CURVE_BITS, curve_position
from ..session import scratch_path, setting
from .readers import read_json
from .tail import open_store

cloudpickle.register_pickle_by_value(sys.modules[__name__])

BATCH_ROWS = 10_000
RANGE_ROWS = 1_000_000  # of a range that one task sorts, about
RANGE_SAMPLE = 100  # keys for each range
PACK_BYTES = 64 << 20  # that a task gathers before it packs them by range
SORTED_ALIKE = [
    *(T.ByteType(), T.ShortType(), T.IntegerType(), T.LongType(), T.BooleanType(), T.StringType(), T.BinaryType()),
    *(T.DateType(), T.TimestampType(), T.TimestampNTZType()),
]


def write_table(
    df: DataFrame,
    path: str,
    fmt: str = "parquet",
    mode: str = "overwrite",
    by: Sequence[str] = (),
    rebalance: bool = True,
) -> None:
    """Write a flat or partitioned table.

    A partitioned write is rebalanced on the partition columns first: each value gets a few files of the advisory size
    instead of one small file per task, and AQE splits a value that holds a large share of the rows over many tasks.
    Appending twice stores the rows twice; see `replace_partitions` for a write that can be run again.
    """
    _partitioned(df, by, rebalance).format(fmt).mode(mode).save(path)


def replace_partitions(df: DataFrame, path: str, by: Sequence[str], fmt: str = "parquet", rebalance: bool = True) -> None:
    """Replace the partitions that occur in `df` and leave all others, so that a re-run does not double them."""
    writer = _partitioned(df, by, rebalance).format(fmt).mode("overwrite")
    writer.option("partitionOverwriteMode", "dynamic").save(path)


def _partitioned(df: DataFrame, by: Sequence[str], rebalance: bool):
    if not by:
        return df.write
    return (df.hint("rebalance", *by) if rebalance else df).write.partitionBy(*by)


def create_clustered_table(
    spark: SparkSession, name: str, columns: str, by: Sequence[str], path: str, fmt: str = "parquet"
) -> None:
    """Declare an external table clustered by `by`, unless it is there; `columns` is DDL such as "a string, b double"."""
    keys = ", ".join(f"`{key}`" for key in by)
    path = path.replace("\\", "\\\\").replace("'", "\\'")
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({columns}) USING {fmt} CLUSTER BY ({keys}) LOCATION '{path}'")


def fill_clustered_table(df: DataFrame, name: str, by: Sequence[str], overwrite: bool = False) -> None:
    """Append to a clustered table, or replace its rows, so that equal keys lie together.

    Plain Spark only records the clustering columns. With one column, rebalancing brings equal keys together (and splits a
    hot key), and sorting inside each task makes the row-group statistics narrow, so that filters on it skip most of the
    data. With several, rows lie along a curve; see `write_clustered`.
    """
    columns = df.sparkSession.table(name).columns
    rows = df.select(*columns)
    if len(by) > 1:
        along_curve(rows, by).write.insertInto(name, overwrite)
    else:
        rows.hint("rebalance", *by).sortWithinPartitions(*by).write.insertInto(name, overwrite)


def along_curve(df: DataFrame, by: Sequence[str], files: int | None = None, bits: int = CURVE_BITS) -> DataFrame:
    """`df` in range partitions of the curve over the columns `by`, sorted along it: one shuffle.

    A range of the curve is a box in most columns at once, so files have narrow bounds in each of them. Rows of one place are
    told apart by their hash, so that a hot combination of values can be cut too. `df` is read twice more for its ranks and
    ranges; it should be a scan or a stored table.
    """
    keys = [curve_position(df, by, bits).alias("_curve"), F.xxhash64(*df.columns).alias("_hash")]
    placed = df.select("*", *keys)
    layout = [*([files] if files else []), "_curve", "_hash"]
    return placed.repartitionByRange(*layout).sortWithinPartitions("_curve", "_hash").drop("_curve", "_hash")


def write_clustered(
    df: DataFrame, path: str, by: Sequence[str], files: int | None = None, fmt: str = "parquet", mode: str = "overwrite"
) -> None:
    """Write `df` clustered by several columns alike: a filter on any of them opens few files.

    Sorting by the columns one after the other serves the first only. Spark chooses the number of files by the size of the
    data, or `files` gives it.
    """
    along_curve(df, by, files).write.format(fmt).mode(mode).save(path)


def files_to_open(df: DataFrame, column: str, low, high) -> DataFrame:
    """(files, opened): how many files a table read from files has, and how many may hold values from `low` to `high`.

    By the least and the greatest value of each file, which is what Parquet's statistics tell a scan.
    """
    bounds = df.groupBy(F.col("_metadata.file_path").alias("file")).agg(F.min(column).alias("least"), F.max(column).alias("most"))
    touched = (F.col("most") >= low) & (F.col("least") <= high)
    return bounds.agg(F.count(F.lit(1)).alias("files"), F.count_if(touched).alias("opened"))


def write_sorted(
    df: DataFrame,
    path: str,
    order: Sequence,
    fmt: str = "parquet",
    files: int | None = None,
    compression: str | None = None,
    options: Mapping[str, str] | None = None,
) -> None:
    """One globally sorted table: file n holds only rows that come before those of file n + 1.

    Spark chooses the number of files by the size of the data, so a small table is one file. `files` asks for at most that
    many; each is then written by one task, but sorted by many; see `in_files`. `compression` is a codec of the format, and
    `options` are other options of its writer, such as the codec's level.
    """
    ordered = in_files(df, order, files) if files else df.orderBy(*order)
    writer = ordered.write.format(fmt).mode("overwrite").options(**(options or {}))
    (writer.option("compression", compression) if compression else writer).save(path)


def in_files(df: DataFrame, order: Sequence, files: int) -> DataFrame:
    """`df` in `files` range partitions, sorted, none of which a single task has to sort.

    With fewer files than the session has shuffle partitions, or than there are times RANGE_ROWS rows, as many ranges as these
    are sorted and stored, the same number for each file; a task then passes the rows of its file's ranges on in their order, a
    batch at a time. `df` is counted and read once more for its ranges; it should be a scan or a stored table.
    """
    spark = df.sparkSession
    rows, least = df.count(), int(spark.conf.get("spark.sql.shuffle.partitions"))
    each = -(-max(least, -(-rows // RANGE_ROWS)) // files)
    if each == 1:
        return df.repartitionByRange(files, *order).sortWithinPartitions(*order)
    ranges = scratch_path(spark, "ranges")
    ordered = _in_ranges(df, order, files * each, rows).sortWithinPartitions(*order)
    with setting(spark, "spark.sql.classic.shuffleDependency.fileCleanup.enabled", "true"):  # its files would stay beside the ranges
        ordered.write.option("compression", "zstd").parquet(ranges)
    kinds = to_arrow_schema(df.schema)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, folder = open_store(ranges)
        found = [f for f in store.get_file_info(FileSelector(folder)) if f.base_name.startswith("part-")]
        for file in (n for batch in batches for n in batch.column(0).to_pylist()):
            # part-<number of the range>-...
            for info in sorted((f for f in found if int(f.base_name.split("-")[1]) // each == file), key=lambda f: f.base_name):
                with store.open_input_file(info.path) as opened:
                    for batch in ParquetFile(opened, coerce_int96_timestamp_unit="us").iter_batches(BATCH_ROWS):
                        columns = [c.cast(f.type) for c, f in zip(batch.columns, kinds)]
                        yield pa.RecordBatch.from_arrays(columns, schema=kinds)

    return spark.range(0, files, 1, files).mapInArrow(read, df.schema)


def _in_ranges(df: DataFrame, order: Sequence, ranges: int, rows: int) -> DataFrame:
    """`df`, which has `rows` rows, in `ranges` range partitions, shuffled in less space than its rows take one by one.

    The rows that a task has for a range travel together, by column and compressed. Ranges are cut by a sample of the keys.
    An order by anything else than columns that Arrow and Spark sort alike is left to Spark, row by row.
    """
    if not all(isinstance(c, str) and c in df.columns and df.schema[c].dataType in SORTED_ALIKE for c in order):
        return df.repartitionByRange(ranges, *order)
    by = list(dict.fromkeys(order))
    kinds = to_arrow_schema(df.select(*by).schema)
    share = min(1.0, RANGE_SAMPLE * ranges / max(1, rows))
    sample = df.select(*by).sample(fraction=share, seed=1).toArrow().cast(kinds)
    keys = sample.take(_sorted_places(sample))
    cuts = keys.take(np.arange(1, ranges) * len(keys) // ranges) if len(keys) else keys

    def packed(held: list[pa.RecordBatch]) -> pa.RecordBatch:
        table = pa.Table.from_batches(held)
        # A row stands before the cuts that are not below it: its range is the number of cuts before it.
        places = _sorted_places(table.select(by).cast(kinds), cuts)
        rows = places < len(table)
        table = table.take(places[rows]).combine_chunks()
        found, counts = np.unique(np.cumsum(~rows)[rows], return_counts=True)
        packs = []
        for stop, count in zip(counts.cumsum().tolist(), counts.tolist()):
            sink = pa.BufferOutputStream()
            with pa.CompressedOutputStream(sink, "zstd") as packer, pa.ipc.new_stream(packer, table.schema) as stream:
                stream.write_table(table.slice(stop - count, count))
            packs.append(sink.getvalue().to_pybytes())
        return pa.record_batch({"range": pa.array(found, pa.int32()), "pack": pa.array(packs, pa.binary())})

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in batches:
            held.append(batch)
            size += batch.nbytes
            if size >= PACK_BYTES:
                yield packed(held)
                held, size = [], 0
        if held:
            yield packed(held)

    def unpack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for pack in (pack for batch in batches for pack in batch.column("pack")):
            with pa.CompressedInputStream(pa.BufferReader(pack.as_buffer()), "zstd") as opened:
                yield from pa.ipc.open_stream(opened)

    dealt = df.mapInArrow(pack, "range int, pack binary").repartitionById(ranges, "range")
    return dealt.mapInArrow(unpack, df.schema)


def _sorted_places(keys: pa.Table, cuts: pa.Table | None = None) -> np.ndarray:
    """The places of rows in their order, nulls first; `cuts` stand behind them, and come after rows that are equal."""
    late = np.repeat([0, 1], [len(keys), len(cuts or [])])
    columns = (pa.concat_tables([keys, cuts]) if cuts else keys).columns
    table = pa.table([*columns, pa.array(late)], names=[str(n) for n in range(len(columns) + 1)])
    return pc.sort_indices(table, sort_keys=[(c, "ascending") for c in table.column_names], null_placement="at_start").to_numpy()


def write_json(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").json(path)


def write_tsv(df: DataFrame, path: str, header: bool = True) -> None:
    df.write.mode("overwrite").option("sep", "\t").option("header", header).csv(path)


def convert(
    spark: SparkSession, sources: Mapping[str, str], target: str, schemas: Mapping[str, str] | None = None
) -> DataFrame:
    """Convert JSON-lines entities to Parquet under `target`; returns one row (entity, rows) per entity.

    The rows are counted from the footers of what was written, not by another pass over the JSON.
    """
    counts = None
    for entity, glob in sources.items():
        path = f"{target.rstrip('/')}/{entity}"
        read_json(spark, glob, (schemas or {}).get(entity)).write.mode("overwrite").parquet(path)
        count = spark.read.parquet(path).agg(F.count(F.lit(1)).alias("rows")).select(F.lit(entity).alias("entity"), "rows")
        counts = count if counts is None else counts.unionByName(count)
    return counts
