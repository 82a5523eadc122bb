"""Every registered query against its SQL, on whole tables."""

import pytest
from oracle import connect, differences

from starwright.queries import REGISTRY

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def connection():
    return connect(FOLDER)


def test_every_query_has_sql():
    assert [name for name, query in REGISTRY.items() if query.sql is None] == []


# A query may bring rows together in one task only to count them, or for a top-k report.
ONE_TASK = {"non_empty_check", "serial_append", "upsert_star_twice", "warehouse_star_serials"}


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", list(REGISTRY))
def test_query(spark, connection, name):
    query = REGISTRY[name]
    result = query.run(spark, FOLDER)
    assert differences(result, connection, query.sql) is None

    plan = plan_of(result)
    for operator in ("CartesianProduct", "NestedLoopJoin", "EvalPython", "InPandas", "InArrow"):
        assert operator not in plan
    if "SinglePartition" in plan and name not in ONE_TASK:
        # Row counts per partition, on the way to the offsets of ids.
        assert "_part" in plan[plan.index("SinglePartition") :]
