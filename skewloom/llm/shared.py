"""What several operators need: folds, row keys, Arrow batches, bitmaps of bounded size."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import store


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def fold(doc_id: Column, parts: int) -> Column:
    """crc32 of the id's text modulo `parts`; null for a null id."""
    return F.crc32(doc_id.cast("string").cast("binary")) % parts


def in_fold(doc_id: Column, parts: int, part: int) -> Column:
    """True in one fold. A null id is in no fold."""
    return F.coalesce(fold(doc_id, parts) == part, F.lit(False))


def out_of_fold(doc_id: Column, parts: int, part: int) -> Column:
    """True in all other folds. A null id is in no fold."""
    return F.coalesce(fold(doc_id, parts) != part, F.lit(False))


def row_key(*columns: Column) -> Column:
    """A key made of a row's content: equal rows have equal keys and equal results, whatever their number."""
    return F.xxhash64(*columns, *(c.isNull() for c in columns))


SLICE_BYTES = 8 << 20
BATCH_LIMIT = "spark.sql.execution.arrow.maxBytesPerBatch"
BATCH_BYTES = 4 << 20


def in_arrow(df: DataFrame, function: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema: str) -> DataFrame:
    """mapInArrow over batches of BATCH_BYTES, unless the session has a limit of its own.

    Spark's 64 MB are held several times over, by each task's writer, its worker and the buffers both keep for later.
    """
    conf = df.sparkSession.conf
    if conf.get(BATCH_LIMIT, None) is None:
        conf.set(BATCH_LIMIT, BATCH_BYTES)
    return df.mapInArrow(function, schema)


def slices(batch: pa.RecordBatch, rows: int, size: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Parts of a batch of at most `rows` rows and `size` bytes; a row that is larger is a part of its own."""
    if batch.num_rows > 1 and (batch.num_rows > rows or batch.nbytes > size):
        half = batch.num_rows // 2
        yield from slices(batch.slice(0, half), rows, size)
        yield from slices(batch.slice(half), rows, size)
    elif batch.num_rows:
        yield batch


def release() -> None:
    """Give memory that is no longer used back to the system: a Python worker lives on and would keep its highest use."""
    import ctypes

    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL("libc.so.6").malloc_trim(0)
    except (OSError, AttributeError):  # another C library
        pass


def map_batches(
    df: DataFrame, function: Callable[..., dict], schema: str, rows: int = 10_000, setup: Callable | None = None
) -> DataFrame:
    """`function` makes a dictionary of columns from each part of an Arrow batch; `schema` is DDL.

    A part has at most `rows` rows, fewer for functions that make much from each row, and a bounded number of bytes. What
    `setup` returns, once for each task, is passed to `function` too.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        state = (setup(),) if setup else ()
        for batch in batches:
            for part in slices(batch, rows):
                yield from record_batches(function(part, *state), kinds)
            batch = part = None
        state = None
        release()

    kinds = arrow_schema(df.sparkSession, schema)
    return in_arrow(df, run, schema)


def arrow_schema(spark: SparkSession, schema: str) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    return to_arrow_schema(StructType.fromDDL(schema))


def record_batches(columns: dict, kinds: pa.Schema, rows: int = 50_000) -> Iterator[pa.RecordBatch]:
    """Batches of at most `rows` rows. Columns may be lists, numpy or Arrow arrays."""
    arrays = [x if isinstance(x := columns[f.name], pa.Array) else pa.array(x, f.type) for f in kinds]
    whole = pa.RecordBatch.from_arrays([a.cast(f.type) for a, f in zip(arrays, kinds)], schema=kinds)
    for start in range(0, whole.num_rows, rows):
        yield whole.slice(start, rows)


def null_as_empty(values: list) -> list:
    return ["" if x is None else x for x in values]


BITMAP_BITS = 23


def bitmap_words(keys: DataFrame, key: str, bits: int = BITMAP_BITS) -> DataFrame:
    """(_word, _bit): 2**(bits - 6) rows at most, with a bit for each 64-bit key of `keys`, whatever the number of keys.

    A key whose bit is not set does not occur; one whose bit is set may occur. It narrows a scan before an exact join,
    and where so many keys occur that most bits are set, the join does all of the work.
    """
    slot = F.col(key).bitwiseAND((1 << bits) - 1)
    bit = F.call_function("shiftleft", F.lit(1).cast("long"), slot.bitwiseAND(63).cast("int"))
    words = keys.select(F.shiftright(slot, 6).alias("_word"), bit.alias("_bit"))
    return store(words.groupBy("_word").agg(F.bit_or("_bit").alias("_bit")), "bitmap")


def marked(df: DataFrame, column: Column, words: DataFrame, mark: str, bits: int = BITMAP_BITS) -> DataFrame:
    """`df` with a boolean column `mark`: whether `column` may be one of the keys of the bitmap."""
    slot = column.bitwiseAND((1 << bits) - 1)
    joined = df.withColumn("_slot", slot).join(F.broadcast(words), F.shiftright("_slot", 6) == F.col("_word"), "left")
    found = F.call_function("getbit", F.col("_bit"), F.col("_slot").bitwiseAND(63).cast("int")) == 1
    return joined.withColumn(mark, F.coalesce(found, F.lit(False))).drop("_slot", "_word", "_bit")


def narrowed(df: DataFrame, column: Column, keys: DataFrame, key: str) -> DataFrame:
    """The rows whose `column` may be a key of `keys`."""
    return marked(df, column, bitmap_words(keys, key), "_possible").filter("_possible").drop("_possible")


def bitmap(keys: DataFrame, key: str, bits: int = BITMAP_BITS) -> bytes:
    """The bitmap as 2**(bits - 3) bytes, for lookups in Python."""
    import numpy as np

    rows = bitmap_words(keys, key, bits).toPandas()
    filled = np.zeros(1 << (bits - 6), "<i8")
    filled[rows["_word"].to_numpy("int64")] = rows["_bit"].to_numpy("int64")
    return filled.tobytes()


def in_bitmap(filled: bytes, keys):
    """Of a numpy array of 64-bit keys, which may be in the bitmap."""
    import numpy as np

    words = np.frombuffer(filled, "<u8")
    slots = keys.view("u8") & np.uint64(len(words) * 64 - 1)
    return (words[slots >> np.uint64(6)] >> (slots & np.uint64(63))) & np.uint64(1) == 1
