"""Every registered query against its oracle on the smallest tables."""

from __future__ import annotations

import pytest
from oracle_check import compare, connect

from __spark_entry__ import FLAGSHIP, entry, oracle_sql, queries

NAMES = sorted(queries())


@pytest.fixture(scope="module")
def con(sf):
    return connect(sf)


@pytest.mark.parametrize("name", NAMES)
def test_query(spark, sf, con, name):
    df = queries()[name](spark, sf)
    plan = df._jdf.queryExecution().executedPlan().toString()
    for node in ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython"):
        assert node not in plan
    sql = oracle_sql().get(name)
    if sql is None:
        assert df.count() > 0
    else:
        assert compare(df, con, sql) is None


def test_entry_runs(spark):
    assert FLAGSHIP in NAMES
    assert entry(spark).count() > 0


def test_every_oracle_has_a_query():
    assert set(oracle_sql()) <= set(NAMES)
