"""Physical-plan properties: JVM-only expressions, no cross joins, pruned
and filtered scans, and no shuffle between the as-of join and its pick."""

import datetime as dt

import pytest

from acctlens.plans.queries import QUERIES
from acctlens.operators.asof import asof_latest
from acctlens.plans.common import records
from tests.conftest import SF_SMALL



def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(n for n in QUERIES if not n.startswith("stream_")))
def test_no_python_and_no_cross_join(spark, name):
    plan = _plan(QUERIES[name](spark, SF_SMALL))
    for bad in ("EvalPython", "CartesianProduct", "BroadcastNestedLoopJoin"):
        assert bad not in plan, f"{name}: {bad}"


def test_parse_prunes_and_pushes(spark):
    df = records(spark, SF_SMALL).select("acctStatusType")
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<value:string>" in plan
    assert "DataFilters: [isnotnull(value" in plan
    assert "regexp_extract" not in plan          # access node not computed when unused


def test_asof_no_exchange_after_join(spark):
    prev = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        base = dt.datetime(2024, 1, 1)
        left = spark.createDataFrame([("k", base, 1)], "k string, t timestamp, v long")
        right = spark.createDataFrame([("k", base, 2.0)], "k string, rt timestamp, x double")
        plan = _plan(asof_latest(left, right, ["k"], "t", "rt", 3600, 600))
        join_at = plan.index("SortMergeJoin")
        assert "Exchange" not in plan[:join_at]     # aggregate reuses the join partitioning
        assert plan.count("Exchange hashpartitioning") == 2
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", prev)
