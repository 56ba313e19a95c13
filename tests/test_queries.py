"""Every registered query agrees with its SQL on the smallest data."""

import re

import pytest

import oracle
from acceptance.queries import ORACLES, QUERIES

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    return oracle.connect(SMALL)


@pytest.mark.parametrize("name", QUERIES)
def test_query_agrees_with_sql(spark, duck, name):
    df = QUERIES[name](spark, SMALL)
    plan = df._jdf.queryExecution().executedPlan().toString()
    # Nothing is paired, and nothing leaves the JVM.
    assert not re.findall(r"CartesianProduct|BroadcastNestedLoopJoin|PythonUDF|EvalPython|InPandas", plan)
    assert oracle.differences(df, duck, ORACLES[name]) is None


def test_entry_has_rows(spark):
    import __spark_entry__

    assert __spark_entry__.entry(spark).count() == 126
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())
