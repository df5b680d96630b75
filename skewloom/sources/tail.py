"""A streaming source that follows growing text files line by line.

It is written with Spark's Python data source interface. An offset holds, for each file, the byte behind the last whole line
that was taken in; a batch reads what lies between two offsets, cut into byte ranges that tasks read on their own. A line
without its line feed waits until it is complete. Offsets are kept in the stream's checkpoint, so a stream that starts again
goes on where it stopped, and a batch that is run again reads the same bytes.

Files are told apart by `identity`, together with a checksum of their first line:

- "inode": by device and inode, for folders that are mounted. A file that is renamed on rotation stays the file it was, and
  a new file under the old name is a new one.
- "content": by the first line alone, for any store. Lines begin with a time, so files differ in their first line.
- "name": by path. A renamed file counts as new, so rotated names must not match the pattern.

A file that is cut off and written anew has another first line and is read from its start; so is one that became shorter.
Folders may lie on any store that Arrow opens (file, s3, gs, hdfs), and must look alike from all executors.
"""

from __future__ import annotations

import json
import os
import sys
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from fnmatch import fnmatch

import pyarrow as pa
from pyarrow import fs as stores
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition

# Workers read without a copy of the library.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

FORMAT = "line_tail"
SCHEMA = "file string, offset long, value string"
CHUNK = 1 << 20
PARTITION_BYTES = 64 << 20
HEAD_BYTES = 4096


@dataclass
class Range(InputPartition):
    """Lines of a file that begin in [start, stop); whole lines end at `end`."""

    path: str
    start: int
    stop: int
    end: int
    begins: bool  # whether `start` is the start of a line


def open_store(folder: str) -> tuple[stores.FileSystem, str]:
    """The store of a folder given as a path or a URI, and the path there."""
    if folder.startswith("file:"):
        folder = "/" + folder.removeprefix("file:").lstrip("/")
    return stores.FileSystem.from_uri(folder if "://" in folder else os.path.abspath(folder))


def last_line_end(file, size: int, chunk: int = CHUNK) -> int:
    """The byte behind the last line feed; 0 if there is none."""
    at = size
    while at > 0:
        start = max(0, at - chunk)
        place = file.read_at(at - start, start).rfind(b"\n")
        if place >= 0:
            return start + place + 1
        at = start
    return 0


def first_line_mark(file, size: int) -> int | None:
    """A checksum of the first line, of its first bytes if it is long; None while it is neither long nor complete."""
    head = file.read_at(min(size, HEAD_BYTES), 0)
    place = head.find(b"\n")
    if place < 0 and len(head) < HEAD_BYTES:
        return None
    return zlib.crc32(head[:place] if place >= 0 else head)


def line_starts(file, start: int, stop: int, end: int, begins: bool, chunk: int = CHUNK) -> Iterator[tuple[int, list[bytes]]]:
    """(place of the first, lines) in parts: the lines that begin in [start, stop), without line feeds."""
    at, rest = (start, b"") if begins else (start - 1, b"")
    skipping = not begins  # up to and with the first line feed from start - 1 on
    while at < end:
        data = file.read_at(min(chunk, end - at), at)
        if not data:
            return
        at += len(data)
        if skipping:
            place = data.find(b"\n")
            if place < 0:
                continue
            data, skipping = data[place + 1 :], False
        rest += data
        begin = at - len(rest)
        cut = rest.rfind(b"\n") + 1
        if cut:
            lines = rest[: cut - 1].split(b"\n")
            rest = rest[cut:]
            if at - len(rest) > stop:
                kept, place = [], begin
                for line in lines:
                    if place >= stop:
                        break
                    kept.append(line)
                    place += len(line) + 1
                if kept:
                    yield begin, kept
                return
            yield begin, lines
        elif begin >= stop:
            return


class LineTailReader(DataSourceStreamReader):
    def __init__(self, options: dict[str, str]):
        self.folder = options["path"]
        self.pattern = options.get("pattern", "*")
        self.identity = options.get("identity", "inode")
        self.partition_bytes = int(options.get("partitionBytes", PARTITION_BYTES))
        if self.identity not in ("inode", "content", "name"):
            raise ValueError(f"unknown identity {self.identity!r}")

    def files(self) -> Iterator[tuple[str, str, int]]:
        """(identity, path, end of whole lines) of each file that has a line."""
        store, folder = open_store(self.folder)
        local = isinstance(store, stores.LocalFileSystem)
        if self.identity == "inode" and not local:
            raise ValueError('only a mounted folder has inodes; set identity to "content" or "name"')
        for info in store.get_file_info(stores.FileSelector(folder, allow_not_found=True)):
            if info.type != stores.FileType.File or not fnmatch(info.base_name, self.pattern) or info.base_name[0] in "._":
                continue
            try:
                with store.open_input_file(info.path) as file:
                    size = file.size()
                    mark, end = first_line_mark(file, size), last_line_end(file, size)
                status = os.stat(info.path) if self.identity == "inode" else None
            except FileNotFoundError:  # renamed or removed meanwhile: the next listing tells
                continue
            if mark is None or not end:
                continue
            who = {"inode": status and f"{status.st_dev}:{status.st_ino}", "content": "", "name": info.path}[self.identity]
            yield f"{who}#{mark:08x}", info.path, end

    def initialOffset(self) -> dict:
        return {"files": "{}"}

    def latestOffset(self) -> dict:
        return {"files": json.dumps({who: end for who, _, end in sorted(self.files())})}

    def partitions(self, start: dict, end: dict) -> list[InputPartition]:
        taken, wanted = json.loads(start["files"]), json.loads(end["files"])
        paths = {who: path for who, path, _ in self.files()}
        ranges: list[InputPartition] = []
        for who, stop in wanted.items():
            begin = taken.get(who, 0)
            if begin > stop:  # written anew
                begin = 0
            if who not in paths:
                if begin < stop:
                    raise FileNotFoundError(f"{who} had lines up to byte {stop} of which {stop - begin} bytes were not read")
                continue
            for at in range(begin, stop, self.partition_bytes):
                ranges.append(Range(paths[who], at, min(stop, at + self.partition_bytes), stop, at == begin))
        return ranges

    def read(self, partition: Range) -> Iterator[pa.RecordBatch]:
        store, _ = open_store(self.folder)
        with store.open_input_file(partition.path) as file:
            parts = line_starts(file, partition.start, partition.stop, partition.end, partition.begins)
            for place, lines in parts:
                offsets = []
                for line in lines:
                    offsets.append(place)
                    place += len(line) + 1
                values = [line.removesuffix(b"\r").decode("utf-8", "replace") for line in lines]
                yield pa.record_batch({"file": [partition.path] * len(lines), "offset": offsets, "value": values})

    def commit(self, end: dict) -> None:
        pass

    def stop(self) -> None:
        pass


class LineTail(DataSource):
    @classmethod
    def name(cls) -> str:
        return FORMAT

    def schema(self) -> str:
        return SCHEMA

    def streamReader(self, schema) -> DataSourceStreamReader:
        return LineTailReader(self.options)


def tail_lines(
    spark: SparkSession, folder: str, pattern: str = "*", identity: str = "inode", partition_bytes: int = PARTITION_BYTES
) -> DataFrame:
    """(file, offset, value) as a stream: the lines of the files in `folder`, and those added to them later.

    offset: the byte where the line begins. Lines end with a line feed, before which a carriage return is dropped.
    """
    spark.dataSource.register(LineTail)
    reader = spark.readStream.format(FORMAT).option("pattern", pattern).option("identity", identity)
    return reader.option("partitionBytes", partition_bytes).load(folder)
