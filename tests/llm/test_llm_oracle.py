"""Each query with SQL against it, and what the plans of native operators may not contain."""

import re

import pytest

import check
from tidemark.llm.queries import QUERIES


@pytest.fixture(scope="module")
def con(sf):
    return check.connect(sf)


@pytest.mark.parametrize("name", [n for n, q in QUERIES.items() if q.sql])
def test_query_matches_sql(spark, sf, con, name):
    q = QUERIES[name]
    df = q.run(spark, sf)
    assert check.type_differences(df, con.execute(q.sql)) == []
    assert check.compare(df, con, q.sql) is None
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert not re.search("CartesianProduct|BroadcastNestedLoopJoin", plan)
    if re.match("op[1579]_", name):
        assert not re.search("Python|Pandas|Arrow", plan)


def test_all_are_there():
    assert sorted(int(re.match(r"op(\d+)_", n)[1]) for n in QUERIES) == list(range(1, 14))
