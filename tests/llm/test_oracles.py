"""The queries of this package that SQL can express, against their SQL."""

import pytest

from skewloom.llm.queries import ORACLES, QUERIES

from ..compare import connect, differences


@pytest.mark.parametrize("name", ORACLES)
def test_same_as_sql(name, spark, folder):
    assert differences(QUERIES[name](spark, folder), connect(folder), ORACLES[name]) is None
