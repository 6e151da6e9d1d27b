"""Each registered query against its SQL, and what no plan may contain."""

import pytest

import __spark_entry__ as driver
import check
from tidemark.queries import REGISTRY


@pytest.fixture(scope="module")
def con(sf):
    return check.connect(sf)


@pytest.mark.parametrize("name", list(REGISTRY))
def test_query_matches_sql(spark, sf, con, name):
    q = REGISTRY[name]
    df = q.run(spark, sf)
    assert check.type_differences(df, con.execute(q.sql)) == []
    assert check.compare(df, con, q.sql) is None
    plan = df._jdf.queryExecution().executedPlan().toString()
    for slow in ("CartesianProduct", "BroadcastNestedLoopJoin", "EvalPython", "MapInPandas"):
        assert slow not in plan, f"{slow} in {name}"


def test_entry_points(spark):
    assert set(driver.oracle_sql()) <= set(driver.queries())
    row = driver.entry(spark).first()
    assert row.rows_read == row.rows_accepted + row.rows_rejected > 0
