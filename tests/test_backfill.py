"""Rows find their run without being gathered by run."""

from smeltery.plans.catalog import QUERIES


def test_runs_are_broadcast(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "5000")
    try:
        plan = QUERIES["backfill_keys"](spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "BroadcastHashJoin" in plan and "hashpartitioning(run_id" not in plan
