"""Every registered query against its SQL twin, and the shape of its plan."""

import os

import pytest

import compare
from contractflow.queries import ORACLES, QUERIES

FOLDER = os.path.join(compare.TESTDATA, "sf0.001")


@pytest.fixture(scope="module")
def con():
    return compare.duck(FOLDER)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql(spark, con, name):
    df = QUERIES[name](spark, FOLDER)
    plan = df._jdf.queryExecution().executedPlan().toString()
    for forbidden in ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython", "MapInPandas"):
        assert forbidden not in plan
    assert not compare.compare(df, con, ORACLES[name])


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES)
