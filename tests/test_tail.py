"""Following files that grow, are rotated and are cut off."""

import os

import pytest
from hypothesis import given, settings as checks
from hypothesis import strategies as st
from pyarrow import BufferReader

from skewloom.sources.tail import LineTailReader, last_line_end, line_starts, open_store, tail_lines


@checks(max_examples=300, deadline=None)
@given(st.lists(st.binary(max_size=5).map(lambda b: b.replace(b"\n", b"")), max_size=12), st.binary(max_size=3), st.integers(1, 9), st.integers(1, 7))
def test_ranges_of_any_size_hold_each_line_once(lines, tail, size, chunk):
    whole = b"".join(line + b"\n" for line in lines)
    file = BufferReader(whole + tail.replace(b"\n", b""))
    end = last_line_end(file, file.size(), chunk)
    assert end == len(whole)
    found = []
    for at in range(0, end, size):
        for place, part in line_starts(file, at, min(end, at + size), end, at == 0, chunk):
            for line in part:
                found.append((place, line))
                place += len(line) + 1
    places = [sum(len(x) + 1 for x in lines[:i]) for i in range(len(lines))]
    assert found == list(zip(places, lines))


@pytest.fixture
def follow(spark, tmp_path):
    """What a stream over a folder takes in from one run to the next."""
    (tmp_path / "log").mkdir()

    def run(folder=tmp_path / "log", **options):
        target, progress = str(tmp_path / "out"), str(tmp_path / "progress")
        seen = sorted(r.value for r in spark.read.parquet(target).collect()) if os.path.exists(target) else []
        stream = tail_lines(spark, str(folder), **options).select("value")
        query = stream.writeStream.format("parquet").option("checkpointLocation", progress).trigger(availableNow=True).start(target)
        query.awaitTermination()
        every = sorted(r.value for r in spark.read.parquet(target).collect())
        for value in seen:
            every.remove(value)
        return every

    return run


def add(path, *lines, end="\n"):
    with open(path, "a") as file:
        file.write("".join(f"{line}{end}" for line in lines))


def test_added_lines_rotation_and_lines_without_an_end(follow, tmp_path):
    live = tmp_path / "log" / "live.log"
    add(live, "1 a", "1 b", "")
    add(live, "1 c, not yet complete", end="")
    assert follow() == ["", "1 a", "1 b"]
    assert follow() == []
    add(live, ", now it is", "1 d\r")
    assert follow() == ["1 c, not yet complete, now it is", "1 d"]
    add(live, "1 e, last before rotation")
    live.rename(tmp_path / "log" / "live.log.1")
    add(live, "2 a, first of the new file")
    add(tmp_path / "log" / "other.log", "other")
    assert follow() == ["1 e, last before rotation", "2 a, first of the new file", "other"]
    add(tmp_path / "log" / "live.log.1", "1 f, written late")
    live.write_text("3 a, written anew\n")
    assert follow() == ["1 f, written late", "3 a, written anew"]
    (tmp_path / "log" / "other.log").unlink()
    assert follow() == []


@pytest.mark.parametrize("identity, again", [("content", ["1 c"]), ("name", ["1 a", "1 b", "1 c"])])
def test_other_identities_on_rotation(follow, tmp_path, identity, again):
    live = tmp_path / "log" / "live.log"
    add(live, "1 a", "1 b")
    assert follow(identity=identity) == ["1 a", "1 b"]
    add(live, "1 c")
    live.rename(tmp_path / "log" / "old.log")
    assert follow(identity=identity) == again
    assert follow(identity=identity, pattern="no*") == []


def test_small_partitions_and_empty_folder(follow, tmp_path):
    assert follow(f"file:{tmp_path}/log") == []
    add(tmp_path / "log" / "a.log", *(f"line {n} é漢" for n in range(500)))
    add(tmp_path / "log" / "_hidden", "no")
    assert len(follow(f"file:{tmp_path}/log", partition_bytes=64)) == 500


def test_a_batch_is_planned_alike_after_a_rename(tmp_path):
    add(tmp_path / "a.log", "x", "y")
    reader = LineTailReader({"path": str(tmp_path), "partitionBytes": "2"})
    start, end = reader.initialOffset(), reader.latestOffset()
    read = lambda: [b.to_pylist() for p in reader.partitions(start, end) for b in reader.read(p)]
    before = read()
    (tmp_path / "a.log").rename(tmp_path / "b.log")
    add(tmp_path / "b.log", "z")
    after = read()
    assert [[r["value"] for r in b] for b in before] == [[r["value"] for r in b] for b in after] == [["x"], ["y"]]
    (tmp_path / "b.log").unlink()
    with pytest.raises(FileNotFoundError):
        reader.partitions(start, end)


@pytest.mark.parametrize("folder", ["/a/b", "file:/a/b", "file:///a/b"])
def test_paths(folder):
    assert open_store(folder)[1] == "/a/b"
