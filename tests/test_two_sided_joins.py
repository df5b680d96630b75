"""Joins whose sides are both hot, stored in buckets, or thinned out by a Bloom filter."""

import pytest
from pyspark.sql import functions as F

from skewloom.operators import bloom
from skewloom.operators.bloom import bloom_filtered, selective_join
from skewloom.operators.skew import bucketed_join, bucketed_sides, grid_join, grid_sides, hot_grid


@pytest.fixture
def sides(spark):
    """A third of both sides on key 0; nulls, and rows that repeat."""
    left = spark.range(0, 900, 1, 4).selectExpr("IF(id % 3 = 0, 0, IF(id % 50 = 1, null, id % 40)) AS k", "id % 100 AS a", "'l' AS name")
    right = spark.range(0, 300, 1, 3).selectExpr("IF(id % 3 = 0, 0, IF(id % 50 = 1, null, id % 40)) AS key", "id % 60 AS b", "'r' AS name")
    return left, right


def plain(left, right):
    return left.join(right.withColumnsRenamed({"key": "k", "name": "right_name"}), "k")


@pytest.mark.parametrize("edge", [1, 3, 20])
def test_grid_join_is_the_plain_join(sides, edge, same_rows, settings):
    settings("spark.sql.autoBroadcastJoinThreshold", "-1")
    same_rows(grid_join(*sides, {"k": "key"}, edge=edge, salt_factor=20), plain(*sides))


def test_repeats_are_bounded_by_the_edge_and_pairs_are_spread(sides):
    left, right = sides
    right = right.withColumnRenamed("key", "k")
    hot = hot_grid(left, right, ["k"], 4, 64)
    assert {r.k: (r._rows, r._columns) for r in hot.collect()}[0] == (4, 4)
    dealt_left, dealt_right = grid_sides(left, right, ["k"], hot)
    assert dealt_left.filter("k = 0").count() == 4 * left.filter("k = 0").count()
    assert dealt_right.filter("k = 0").count() == 4 * right.filter("k = 0").count()
    cells = dealt_left.filter("k = 0").groupBy("_row", "_column").count().collect()
    assert len(cells) == 16 and max(r["count"] for r in cells) < 0.5 * left.filter("k = 0").count()


def test_grid_of_one_hot_side_and_of_none(sides, same_rows, spark):
    left, right = sides
    even = spark.range(40).selectExpr("id AS key", "id AS b", "'r' AS name")
    own = even.selectExpr("key AS k", "b AS a", "name")
    hot = hot_grid(left, even.withColumnRenamed("key", "k"), ["k"], 8, 30)
    assert {r.k: (r._rows, r._columns) for r in hot.collect()}[0][1] == 1
    same_rows(grid_join(left, even, {"k": "key"}, edge=8, salt_factor=30), plain(left, even))
    same_rows(grid_join(own, even, {"k": "key"}, salt_factor=10), plain(own, even))
    same_rows(grid_join(left.limit(0), right, {"k": "key"}), plain(left.limit(0), right))


@pytest.mark.parametrize("edge", [1, 4])
def test_totals_of_cells_add_up_to_those_of_pairs(spark, sides, edge, same_rows):
    left, right = sides
    of_cell = {"pairs": F.count(F.lit(1)), "b": F.sum("b")}
    met = grid_join(left, right, {"k": "key"}, edge=edge, salt_factor=20, totals=of_cell)
    found = met.groupBy("k").agg(F.sum("pairs").alias("pairs"), F.countDistinct("a").alias("a"), F.sum("b").alias("b"))
    pairs = plain(left, right).groupBy("k").agg(F.count(F.lit(1)).alias("pairs"), F.countDistinct("a").alias("a"), F.sum("b").alias("b"))
    same_rows(found, pairs)
    assert met.count() <= edge * left.count()  # the pairs of key 0 alone are 30,000
    even = left.filter("k <> 0").limit(40), right.filter("key = 5")
    assert grid_join(*even, {"k": "key"}, totals=of_cell).agg(F.sum("pairs")).first()[0] == (plain(*even).count() or None)


def test_buckets_join_without_a_shuffle_and_split_a_hot_key(spark, sides, same_rows, plan, settings):
    settings("spark.sql.autoBroadcastJoinThreshold", "-1")
    tables = ("bucketed_left", "bucketed_right")
    try:
        for _ in range(2):  # may be run again
            bucketed_sides(*sides, {"k": "key"}, tables, 8, salt_factor=40)
        joined = bucketed_join(spark, tables, ["k"])
        same_rows(joined, plain(*sides))
        text = plan(joined)
        assert "Exchange" not in text and "SortMergeJoin" in text and "Bucketed: true" in text
        of_hot = spark.table(tables[0]).filter("k = 0").select(F.col("_metadata.file_name")).distinct().count()
        assert of_hot > 3
    finally:
        for name in tables:
            spark.sql(f"DROP TABLE IF EXISTS {name}")


def test_bloom_filter_keeps_all_partners_and_little_else(spark):
    keys = spark.range(0, 3_000, 1, 3).selectExpr("id * 7 AS k", "concat('t', id % 5) AS t")
    rows = spark.range(0, 60_000, 1, 8).selectExpr("IF(id % 1000 = 0, null, id) AS k", "concat('t', id DIV 7 % 5) AS t")
    kept = bloom_filtered(rows, ["k", "t"], keys)
    partners = rows.join(keys, ["k", "t"], "left_semi")
    assert partners.join(kept, ["k", "t"], "left_anti").count() == 0
    assert partners.count() <= kept.count() < partners.count() + 0.02 * rows.count()
    assert bloom_filtered(rows, ["k"], keys, max_words=8) is rows  # too many keys: nothing is filtered
    assert bloom_filtered(rows, ["k"], keys.limit(0)).count() == 0


def test_selective_join_filters_before_the_shuffle(spark, sides, same_rows, plan, settings):
    settings("spark.sql.autoBroadcastJoinThreshold", "-1")
    left, right = sides
    chosen = right.filter("key = 5")
    joined = selective_join(left, chosen, {"k": "key"})
    same_rows(joined, plain(left, chosen))
    text = plan(joined).split("Initial Plan")[0]
    assert text.index("SortMergeJoin") < text.index("hashpartitioning(k") < text.index("BroadcastHashJoin")


def test_shuffled_rows_with_and_without_the_filter(spark, folder):
    """What the filter spares of the shuffle of the large side."""
    items = spark.read.parquet(f"{folder}/lineitem.parquet").select(F.col("l_partkey").alias("k"))
    chosen = spark.read.parquet(f"{folder}/part.parquet").filter("p_size = 7").select(F.col("p_partkey").alias("k"))
    partners = items.join(chosen, "k", "left_semi").count()
    assert partners <= bloom_filtered(items, ["k"], chosen).count() < partners + 0.05 * items.count() < 0.2 * items.count()


def test_masks_have_their_bits(spark):
    bits = spark.range(1000).select(F.bit_count(bloom._mask(F.xxhash64("id"))).alias("n")).agg(F.min("n"), F.max("n"), F.avg("n")).first()
    assert 1 <= bits[0] and bits[1] <= bloom.BITS_PER_KEY and bits[2] > 4.5
