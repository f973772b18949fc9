"""Every registered query against its check SQL."""

from __future__ import annotations

import os

import pytest

from granary.catalog import ORACLE, QUERIES
from tests.compare import connect, differences

FOLDER = os.environ.get("QUERY_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def duck():
    connection = connect(FOLDER)
    yield connection
    connection.close()


def test_every_query_has_check_sql():
    assert set(ORACLE) == set(QUERIES)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, duck, name):
    frame = QUERIES[name](spark, FOLDER)
    assert differences(frame, duck, ORACLE[name]) == []
    plan = frame._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
    assert "BatchEvalPython" not in plan and "ArrowEvalPython" not in plan
