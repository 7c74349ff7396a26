"""Plan checks over every registered query: no Python evaluation in the plan,
no cartesian or nested-loop joins, and the category pivot in three aggregations
without joins."""

import pytest

import __spark_entry__ as E
from scriptorium import bindings as B
from conftest import SF_SMALL

SLOW = ("BatchEvalPython", "ArrowEvalPython", "CartesianProduct", "BroadcastNestedLoopJoin")


@pytest.mark.parametrize("name", sorted(B.QUERIES))
def test_no_slow_path(spark, name):
    plan = E.queries()[name](spark, SF_SMALL)._jdf.queryExecution().executedPlan().toString()
    assert not [s for s in SLOW if s in plan]


def test_scan_prunes_columns(spark):
    plan = E.queries()["table_scan_project"](spark, SF_SMALL)._jdf.queryExecution() \
        .executedPlan().toString()
    schema = plan[plan.index("ReadSchema: "):].split("\n")[0]
    assert "o_orderkey" in schema and "o_orderpriority" in schema
    assert "o_custkey" not in schema and "o_totalprice" not in schema


def test_pivot_is_one_aggregation_on_paper(spark):
    from pyspark.sql import functions as F
    from scriptorium.operators.mode import category_pivot
    votes = spark.createDataFrame([(1, "A", "x", 2), (1, "B", "y", 1)], "p int, l string, e string, w int")
    plan = category_pivot(votes, "p", "l", "e", "w", ["A", "B"])._jdf.queryExecution() \
        .executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 3
    assert "Join" not in plan
    assert F is not None
