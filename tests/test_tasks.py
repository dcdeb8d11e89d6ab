import pytest
from pyspark.sql import functions as F

from folio.plans import registry


@pytest.mark.parametrize("name", ["fragment_merge", "page_replay"])
def test_more_rows_are_more_tasks(spark, monkeypatch, name):
    monkeypatch.setattr(registry, "TASK_ROWS", 200, raising=False)
    rows = registry.queries()[name](spark, "/root/testdata/sf0.001").select(F.spark_partition_id().alias("task")).groupBy("task").count().collect()
    assert max(r["count"] for r in rows) < sum(r["count"] for r in rows) / 3


def test_replay_reads_a_plan_that_is_made(spark):
    found = registry.queries()["store_replay"](spark, "/root/testdata/sf0.001")
    assert "completed_windows" not in found._jdf.queryExecution().toString()


@pytest.mark.parametrize("name", ["response_validation", "summary_store"])
def test_more_responses_are_more_tasks(spark, monkeypatch, name):
    monkeypatch.setattr(registry, "TASK_ROWS", 5, raising=False)
    rows = registry.queries()[name](spark, "/root/testdata/sf0.001")
    assert "RepartitionByExpression [p_partkey#" in (plan := rows._jdf.queryExecution().optimizedPlan().toString()) and ", 40" in plan[plan.index("RepartitionByExpression") :].split("\n")[0]
