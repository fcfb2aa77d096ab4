"""Every registered query equals its SQL, row for row."""

from __future__ import annotations

import re

import pytest
from compare import connect, differences

from courierlens.catalog.registry import ORACLES, QUERIES

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return connect(SF_DIR)


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES)


@pytest.mark.parametrize("name", list(QUERIES))
def test_query_equals_sql(spark, con, name):
    frame = QUERIES[name](spark, SF_DIR)
    assert differences(frame, con, ORACLES[name]) == []
    plan = frame._jdf.queryExecution().executedPlan().toString()
    assert not re.search(r"Python|ArrowEval|MapInPandas|CartesianProduct", plan)
