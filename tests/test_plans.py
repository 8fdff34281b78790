"""Physical-plan checks for every registered query.

The plans must stay distributed and JVM-side: no Cartesian or nested-loop
joins, no Python evaluation, no driver-side data, and scans that read only
the columns the query needs.
"""

import pytest

from mercato.plans import registry

SF = "/root/testdata/sf0.001"
QUERIES = registry.queries()

FORBIDDEN = ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython",
             "FlatMapGroupsInPandas", "MapInPandas", "LocalTableScan", "REPARTITION_BY_NUM")


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_plan_is_distributed_and_jvm_side(spark, name):
    plan = _plan(QUERIES[name](spark, SF))
    for op in FORBIDDEN:
        assert op not in plan, f"{name} plans {op}"


def test_category_report_expands_nothing(spark):
    assert "Expand" not in _plan(QUERIES["gold_category_performance"](spark, SF))


def test_preview_takes_its_rows_without_a_shuffle(spark):
    plan = _plan(QUERIES["preview_orders"](spark, SF))
    assert "TakeOrderedAndProject" in plan and "Exchange" not in plan


def test_state_report_reads_only_needed_columns(spark):
    plan = _plan(QUERIES["gold_state_performance"](spark, SF))
    # lineitem is read for key, quantity and price columns only.
    for unused in ("l_shipdate", "l_returnflag", "l_linestatus", "l_suppkey", "l_linenumber"):
        assert unused not in plan


def test_state_report_aggregates_items_before_joining(spark):
    df = QUERIES["gold_state_performance"](spark, SF)
    text = df._jdf.queryExecution().optimizedPlan().toString()
    # The item-level aggregate (per order) sits below the order/customer join.
    join_at = text.find("Join LeftOuter")
    per_order_at = text.find("Aggregate [order_id")
    assert join_at != -1 and per_order_at > join_at


def test_quality_aggregates_order_keys_once(spark):
    from mercato.plans import quality, registry

    df = quality.run_guards(registry.bronze_for(spark, SF))
    df.collect()
    plan = df._jdf.queryExecution().executedPlan().toString()
    # The uniqueness rule and the orphan check share one order-key shuffle.
    assert "ReusedExchange" in plan


def test_report_filters_reach_the_parquet_scan(spark, tmp_path):
    """In the job, reports read silver Parquet: their filters and column
    choices must reach the scan."""
    from mercato.plans import gold, registry

    silver_orders = registry.silver_for(spark, SF)["orders"]
    path = str(tmp_path / "orders")
    silver_orders.write.parquet(path)
    payments_path = str(tmp_path / "payments")
    registry.silver_for(spark, SF)["order_payments"].write.parquet(payments_path)
    df = gold.sales_trends({"orders": spark.read.parquet(path),
                            "order_payments": spark.read.parquet(payments_path)})
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(is_completed_transaction,true)" in plan
    # Only the needed order columns are read.
    assert "order_delivered_customer_date" not in plan and "order_status" not in plan
