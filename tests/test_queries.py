"""Every query against its SQL on the smallest tables, and the shape of every plan."""

import pytest

from fitloom.plans import ORACLES, QUERIES
from tests.oracle import compare, connect

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return connect(FOLDER)


@pytest.mark.parametrize("name", list(QUERIES))
def test_query(spark, con, name):
    df = QUERIES[name](spark, FOLDER)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "NestedLoopJoin" not in plan
    if name in ORACLES:
        assert compare(df, con, ORACLES[name]) == ""
    else:
        assert df.count() > 0


def test_entry(spark):
    import __spark_entry__ as e

    assert e.entry(spark).columns == ["name", "n", "percent"]
    assert set(e.oracle_sql()) <= set(e.queries())
