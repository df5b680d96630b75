"""Every query against its SQL in another engine."""

import pytest

import __spark_entry__ as entry_point
from skewloom.plans.oracles import ORACLES
from skewloom.plans.queries import QUERIES
from skewloom.sources.readers import list_files

from .compare import connect, differences


@pytest.fixture(scope="module")
def duck(folder):
    return connect(folder)


def test_every_oracle_has_its_query():
    assert set(QUERIES) == set(ORACLES)
    assert set(QUERIES) <= set(entry_point.queries()) and set(ORACLES) <= set(entry_point.oracle_sql())
    assert set(entry_point.oracle_sql()) <= set(entry_point.queries())


@pytest.mark.parametrize("name", ORACLES)
def test_same_as_sql(name, spark, folder, duck):
    assert differences(QUERIES[name](spark, folder), duck, ORACLES[name]) is None


def test_list_files(spark, folder):
    rows = list_files(spark, f"{folder}/*.parquet").collect()
    assert {row.path.rsplit("/", 1)[1] for row in rows} >= {"lineitem.parquet", "orders.parquet"}
    assert all(row.length > 0 for row in rows)


def test_entry(spark):
    result = entry_point.entry(spark)
    assert result.columns[:4] == ["PU_Borough", "PU_Zone", "DO_Borough", "DO_Zone"]
    assert result.count() > 0
