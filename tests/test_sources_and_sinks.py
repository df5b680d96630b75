import datetime as dt
import json
import re
from pathlib import Path
from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F

from skewloom.plans import mapping
from skewloom.plans.queries import QUERIES
from skewloom.plans.rides import DAY, RIDE_JOBS
from skewloom.session import PROFILES, scratch_path
from skewloom.sources import schemas, sinks
from skewloom.sources.readers import list_files, read_csv, read_json, read_parquet, register_views
from skewloom.sources.sinks import (
    convert,
    create_clustered_table,
    fill_clustered_table,
    replace_partitions,
    write_json,
    in_files,
    write_sorted,
    write_table,
    write_tsv,
)

RUN_DAY = dt.date(2024, 6, 6)


def files(path, suffix):
    return sorted(p for p in Path(path).rglob(f"part-*{suffix}"))


@pytest.fixture
def totals(spark):
    return spark.range(0, 1_000, 1, 8).select(
        F.when(F.col("id") % 3 == 0, "Bronx").otherwise(F.concat(F.lit("Z"), F.col("id") % 7)).alias("borough"),
        F.col("id").alias("n"),
    )


def test_projected_scan(spark, folder, plan):
    df = read_parquet(spark, f"{folder}/line*.parquet", ["l_orderkey", "l_tax"])
    assert "ReadSchema: struct<l_orderkey:bigint,l_tax:double>" in plan(df)
    assert len(read_parquet(spark, f"{folder}/line*.parquet").columns) == 11


def test_csv_is_text_unless_declared(spark, tmp_path):
    (tmp_path / "zones.csv").write_text('LocationID,Borough,Zone\n1,Queens,"Park, North"\nN/A,Unknown,\n')
    plain = read_csv(spark, str(tmp_path / "zones.csv"))
    assert {kind for _, kind in plain.dtypes} == {"string"}
    declared = read_csv(spark, str(tmp_path / "zones.csv"), schemas.ZONES)
    assert plain.collect() == declared.collect()
    assert plain.first().Zone == "Park, North"


def test_declared_csv_with_other_header_fails(spark, tmp_path):
    (tmp_path / "zones.csv").write_text("Borough,LocationID,Zone\nQueens,1,Park\n")
    with pytest.raises(Exception, match="(?i)header"):
        read_csv(spark, str(tmp_path / "zones.csv"), schemas.ZONES).collect()


def test_json_inferred_and_declared(spark, tmp_path):
    (tmp_path / "review.json").write_text('{"review_id":"a","user_id":"u","business_id":"b","date":"2024-06-06"}\n')
    path = str(tmp_path / "*.json")
    assert dict(read_json(spark, path).dtypes)["date"] == "string"
    assert read_json(spark, path, schemas.REVIEW).first().date == RUN_DAY
    assert read_json(spark, path, sample=1.0).count() == 1


def test_list_files(spark, tmp_path):
    (tmp_path / "a.json").write_text("{}")
    (tmp_path / "b.txt").write_text("x")
    rows = list_files(spark, str(tmp_path / "*.json")).collect()
    assert [(r.path.rsplit("/", 1)[1], r.length) for r in rows] == [("a.json", 2)]


def test_register_views(spark):
    register_views(some_numbers=spark.range(3))
    assert spark.sql("SELECT sum(id) FROM some_numbers").first()[0] == 3


def test_append_twice_doubles_and_overwrite_does_not(spark, totals, tmp_path):
    for mode, rows in (("append", 2_000), ("overwrite", 1_000)):
        for _ in range(2):
            write_table(totals, str(tmp_path / mode), mode=mode, by=["borough"])
        assert spark.read.parquet(str(tmp_path / mode)).count() == rows


def test_partitioned_write_makes_few_files(spark, totals, tmp_path):
    write_table(totals, str(tmp_path / "few"), by=["borough"])
    write_table(totals, str(tmp_path / "many"), by=["borough"], rebalance=False)
    assert len(files(tmp_path / "few", ".parquet")) == 8
    assert len(files(tmp_path / "many", ".parquet")) == 64


def test_hot_partition_is_split_over_tasks(spark, tmp_path, settings):
    settings("spark.sql.adaptive.advisoryPartitionSizeInBytes", "64KB")
    hot = spark.range(0, 200_000, 1, 8).select(
        F.lit("hot").alias("day"), F.xxhash64("id").alias("a"), F.xxhash64("id", F.lit(1)).alias("b")
    )
    write_table(hot, str(tmp_path / "hot"), by=["day"])
    assert len(files(tmp_path / "hot", ".parquet")) > 4
    assert spark.read.parquet(str(tmp_path / "hot")).count() == 200_000


def test_partition_pruning(spark, totals, tmp_path, plan):
    write_table(totals, str(tmp_path / "t"), by=["borough"])
    text = plan(spark.read.parquet(str(tmp_path / "t")).filter("borough = 'Bronx'"))
    assert "PartitionFilters: [isnotnull(borough" in text


def test_replace_partitions_leaves_others(spark, totals, tmp_path):
    path = str(tmp_path / "t")
    write_table(totals, path, by=["borough"])
    replace_partitions(totals.filter("borough = 'Bronx'").withColumn("n", F.lit(-1).cast("bigint")), path, ["borough"])
    stored = spark.read.parquet(path)
    assert stored.count() == 1_000
    assert stored.filter("n = -1").select("borough").distinct().collect() == [("Bronx",)]


def test_clustered_table(spark, totals, tmp_path):
    create_clustered_table(spark, "clustered_totals", "borough string, n bigint", ["borough"], str(tmp_path / "c"))
    assert spark.table("clustered_totals").count() == 0
    fill_clustered_table(totals, "clustered_totals", ["borough"])
    assert spark.table("clustered_totals").count() == 1_000
    described = str(spark.sql("DESCRIBE EXTENDED clustered_totals").collect())
    assert "Clustering" in described
    for file in files(tmp_path / "c", ".parquet"):
        boroughs = [r.borough for r in spark.read.parquet(f"file:{file}").coalesce(1).collect()]
        assert boroughs == sorted(boroughs)
    create_clustered_table(spark, "clustered_totals", "borough string, n bigint", ["borough"], str(tmp_path / "c"))
    fill_clustered_table(totals, "clustered_totals", ["borough"], overwrite=True)
    assert spark.table("clustered_totals").count() == 1_000
    spark.sql("DROP TABLE clustered_totals")


def test_sorted_table(spark, totals, tmp_path):
    write_sorted(totals, str(tmp_path / "s"), [F.col("n").desc()])
    ranges = [
        spark.read.parquet(f"file:{f}").agg(F.max("n"), F.min("n")).first() for f in files(tmp_path / "s", ".parquet")
    ]
    assert all(a[1] > b[0] for a, b in zip(ranges, ranges[1:]))


def test_sorted_json_is_in_order_over_all_files(spark, totals, tmp_path, settings):
    settings("spark.sql.adaptive.coalescePartitions.enabled", "false")
    write_sorted(totals, str(tmp_path / "many"), ["n"], "json")
    parts = files(tmp_path / "many", ".json")
    lines = [line for part in parts for line in part.read_text().splitlines()]
    assert len(parts) > 1 and len(lines) == 1_000
    assert [json.loads(line)["n"] for line in lines] == list(range(1_000))


def test_sorted_json_in_a_number_of_files(spark, totals, tmp_path):
    write_sorted(totals, str(tmp_path / "one"), ["n"], "json", files=1)
    (only,) = files(tmp_path / "one", ".json")
    assert only.read_text().splitlines()[:2] == ['{"borough":"Bronx","n":0}', '{"borough":"Z1","n":1}']


def test_few_sorted_files_are_sorted_by_many_tasks(spark, tmp_path, same_rows):
    rows = spark.range(0, 4_000, 1, 5).selectExpr(
        "IF(id % 50 = 7, null, id * 37 % 1000) AS n", "timestamp_micros(id * 86400000001 - 9000000000000000) AS at", "array(id, null) AS ids",
        "CAST(id AS DECIMAL(20, 3)) AS amount", "named_struct('a', concat('é', id)) AS s",
    )
    write_sorted(rows, str(tmp_path / "few"), ["n"], files=2)
    parts = files(tmp_path / "few", ".parquet")
    found = [[r.n for r in spark.read.parquet(f"file:{p}").coalesce(1).collect()] for p in parts]
    assert len(parts) == 2 and min(map(len, found)) > 1_000
    numbers = [-1 if n is None else n for n in found[0] + found[1]]
    assert numbers == sorted(numbers) and found[0][-1] < found[1][0]
    same_rows(spark.read.parquet(str(tmp_path / "few")), rows)
    sorting = in_files(rows, ["n"], 2)
    assert sorting.rdd.getNumPartitions() == 2 and "Sort" not in sorting._jdf.queryExecution().toString()
    write_sorted(rows.limit(0), str(tmp_path / "none"), ["n"], files=2)
    assert spark.read.schema(rows.schema).parquet(str(tmp_path / "none")).count() == 0


@pytest.fixture
def tasks(spark, log_dir):
    """The metrics of the tasks that ran since the fixture was last asked."""
    (log,) = (p for p in log_dir.iterdir() if spark.sparkContext.applicationId in p.name)
    seen = [log.stat().st_size]

    def since():
        spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty(30_000)
        with log.open() as file:
            file.seek(seen[0])
            events = [json.loads(line) for line in file.readlines() if line.endswith("\n")]
            seen[0] = file.tell()
        return [e["Task Metrics"] for e in events if e["Event"] == "SparkListenerTaskEnd"]

    return since


def test_few_sorted_files_shuffle_packed_rows(spark, tmp_path, tasks):
    """No row travels alone, and what travels takes less than two thirds of the space of rows in the shuffle."""
    rows = spark.range(0, 60_000, 1, 4).select(
        F.pmod(F.xxhash64("id"), F.lit(5_000)).alias("job"), "id", *[(F.pmod(F.hash("id"), F.lit(1_000)) * n).alias(f"m{n}") for n in range(1, 20)]
    )
    tasks()
    rows.repartitionByRange(8, "job", "id").write.format("noop").mode("overwrite").save()
    plain = sum(m["Shuffle Write Metrics"]["Shuffle Bytes Written"] for m in tasks())
    write_sorted(rows, str(tmp_path / "few"), ["job", "id"], files=2)
    shuffled = [m["Shuffle Write Metrics"] for m in tasks() if m["Shuffle Write Metrics"]["Shuffle Records Written"]]
    assert sum(m["Shuffle Bytes Written"] for m in shuffled) < plain * 2 / 3
    assert sum(m["Shuffle Records Written"] for m in shuffled) <= 4 * 8 + 8  # a pack a task and range, and the counts
    found = [r for p in files(tmp_path / "few", ".parquet") for r in spark.read.parquet(f"file:{p}").coalesce(1).collect()]
    assert [(r.job, r.id) for r in found] == sorted((r.job, r.id) for r in rows.collect())


@pytest.mark.parametrize("zone", ["UTC", "America/New_York"])
def test_sorted_files_by_keys_of_all_kinds(spark, tmp_path, same_rows, settings, zone):
    settings("spark.sql.session.timeZone", zone)
    rows = spark.range(0, 3_000, 1, 5).selectExpr(
        "id", "IF(id % 9 = 0, null, concat(chr(65 + cast(id * 7 % 50 AS int)), 'é', id % 4)) AS text", "id % 3 = 0 AS flag",
        "IF(id % 7 = 0, null, timestamp_micros(id * 86400000001 * 37 % 9000000000000000)) AS at", "date_from_unix_date(CAST(id * 31 % 900 AS int)) AS day",
        "CAST(id * 13 % 40 - 20 AS tinyint) AS small", "IF(id % 11 = 0, double('NaN'), double(id * 17 % 70 - 30)) AS real", "map('a', timestamp_micros(id)) AS seen",
    )
    for n, order in enumerate((["text", "at"], ["flag", "small", "id"], ["day", "text"], ["real", "id"], [F.col("small").desc_nulls_first(), "id"], ["at"])):
        write_sorted(rows, str(tmp_path / str(n)), order, files=3)
        parts = files(tmp_path / str(n), ".parquet")
        found = [spark.read.parquet(f"file:{p}").coalesce(1).withColumn("place", F.monotonically_increasing_id() + F.lit(k << 40)) for k, p in enumerate(parts)]
        stored = found[0].unionByName(found[1]).unionByName(found[2])
        keys = [c for c in order if isinstance(c, str)] or ["small"]
        placed = [tuple(r) for r in stored.orderBy("place").select(*keys).collect()]
        if "real" in keys:
            placed, expected = ([tuple(map(str, r)) for r in x] for x in (placed, rows.orderBy(*order).select(*keys).collect()))
        else:
            expected = [tuple(r) for r in rows.orderBy(*order).select(*keys).collect()]
        assert placed == expected and len(parts) == 3
        same_rows(stored.drop("place").withColumn("seen", F.map_entries("seen")), rows.withColumn("seen", F.map_entries("seen")))


def test_ranges_grow_in_number_with_the_rows(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(sinks, "RANGE_ROWS", 100)
    monkeypatch.setattr(sinks, "PACK_BYTES", 1_000)
    shared = Path(spark.conf.get("spark.checkpoint.dir"))
    before = set(shared.glob("ranges-*"))
    write_sorted(spark.range(0, 3_000, 1, 4).select((F.col("id") * 7 % 3_000).alias("n")), str(tmp_path / "few"), ["n"], "json", files=2)
    (ranges,) = set(shared.glob("ranges-*")) - before
    sizes = [r["count"] for r in spark.read.parquet(str(ranges)).groupBy("_metadata.file_name").count().collect()]
    assert len(sizes) == 30 and sum(sizes) == 3_000 and max(sizes) < 300
    lines = [json.loads(line)["n"] for part in files(tmp_path / "few", ".json") for line in part.read_text().splitlines()]
    assert lines == list(range(3_000))


def test_rows_in_few_sorted_files_are_not_sorted_again(spark, folder, plan):
    shared = Path(spark.conf.get("spark.checkpoint.dir"))
    before = set(shared.glob("sorted-files-*"))
    found = QUERIES["sorted_files"](spark, folder)
    assert not re.search(r"Aggregate\(key=\[\w", plan(found))
    assert found.collect() == [(spark.read.parquet(f"{folder}/lineitem.parquet").count(), 0)]
    (path,) = set(shared.glob("sorted-files-*")) - before
    assert len(files(path, ".json.gz")) == 3


def test_sorted_json_may_be_compressed(spark, totals, tmp_path):
    write_sorted(totals, str(tmp_path / "c"), ["n"], "json", compression="gzip")
    assert files(tmp_path / "c", ".json.gz") and spark.read.json(str(tmp_path / "c")).count() == 1_000


def test_tsv(spark, tmp_path):
    write_tsv(spark.createDataFrame([("a", 1)], "key string, value int").coalesce(1), str(tmp_path / "t"))
    (only,) = files(tmp_path / "t", ".csv")
    assert only.read_text() == "key\tvalue\na\t1\n"


def test_convert(spark, tmp_path):
    write_json(spark.range(30).select(F.col("id").alias("n")), str(tmp_path / "json/tip"))
    write_json(spark.range(5).select(F.col("id").cast("string").alias("user_id")), str(tmp_path / "json/user"))
    sources = {name: str(tmp_path / f"json/{name}/*.json") for name in ("tip", "user")}
    counts = convert(spark, sources, str(tmp_path / "parquet"), {"user": schemas.USER})
    assert {r.entity: r.rows for r in counts.collect()} == {"tip": 30, "user": 5}
    assert spark.read.parquet(str(tmp_path / "parquet/user")).dtypes == [("user_id", "string")]


@pytest.mark.parametrize(
    "name, tables",
    [
        ("row_udf", []),
        ("native", []),
        ("partitioned_overwrite", ["total_trip_time", "hvfhs_license_num"]),
        ("clustered_table", ["cluster/by_borough"]),
        ("narrow_append", ["rides", "total_trip_time", "hvfhs_license_num"]),
        ("narrow_refresh", ["rides", "total_trip_time", "hvfhs_license_num"]),
        ("sorted_overwrite", ["rides"]),
    ],
)
def test_ride_job_writes(spark, folder, tmp_path, name, tables):
    job = RIDE_JOBS[name]
    trips, zones = mapping.trips(spark, folder), mapping.zones(spark, folder)
    paths = job.write(spark, trips, zones, str(tmp_path), RUN_DAY, table="by_borough")
    assert paths == [f"{tmp_path}/{t}" for t in tables]
    frames = job.tables(trips, zones, RUN_DAY)
    for path in paths:
        key = path.rsplit("/", 1)[1]
        assert spark.read.parquet(path).count() == frames[key if key in frames else "total_trip_time"].count()
    if name == "narrow_append":
        assert dict(spark.read.parquet(paths[0]).dtypes)[DAY] == "date"
        assert len(files(paths[0], ".parquet")) > 0
    spark.sql("DROP TABLE IF EXISTS by_borough")


def test_profiles():
    assert PROFILES["fixed_partitions"]["spark.sql.shuffle.partitions"] == "50"
    assert PROFILES["tight_memory"]["spark.sql.adaptive.enabled"] == "false"


def test_refreshed_job_keeps_other_days(spark, folder, tmp_path):
    trips, zones = mapping.trips(spark, folder), mapping.zones(spark, folder)
    job = RIDE_JOBS["narrow_refresh"]
    for day in (RUN_DAY, dt.date(2024, 6, 7), RUN_DAY):
        job.write(spark, trips, zones, str(tmp_path), day)
    days = spark.read.parquet(str(tmp_path / "total_trip_time")).groupBy(DAY).count().collect()
    assert len(days) == 2 and len({r["count"] for r in days}) == 1


def test_zones_meet_sums_only(spark, folder):
    """In the plan, no zone is scanned below the first sum."""
    tables = RIDE_JOBS["narrow_append"].tables(mapping.trips(spark, folder), mapping.zones(spark, folder), RUN_DAY)
    for name in ("total_trip_time", "hvfhs_license_num"):
        lines = tables[name]._jdf.queryExecution().optimizedPlan().toString().splitlines()
        depth = [len(line) - len(line.lstrip(" :+-")) for line in lines]
        first = max((d, i) for i, d in enumerate(depth) if lines[i].lstrip(" :+-").startswith("Aggregate"))[1]
        end = next((i for i in range(first + 1, len(lines)) if depth[i] <= depth[first]), len(lines))
        assert any("s_nationkey" in line for line in lines[first:end])
        assert not any("n_name" in line or "r_name" in line for line in lines[first:end])
        assert any("n_name" in line for line in lines)


def test_scratch_without_a_checkpoint_folder_is_below_the_warehouse():
    conf = {"spark.master": "local[2]", "spark.sql.warehouse.dir": "file:/w/"}
    session = SimpleNamespace(conf=SimpleNamespace(get=lambda key, default=None: conf.get(key, default)))
    assert scratch_path(session, "x").startswith("file:/w/scratch/x-")
    conf["spark.master"] = "spark://host:7077"
    with pytest.raises(ValueError, match="checkpoint"):
        scratch_path(session, "x")
