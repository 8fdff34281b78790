"""Registered queries: one per table-valued operator of the pipeline.

Each query takes ``(spark, sf_dir)``, derives the bronze tables from the
test tables in ``sf_dir`` and returns the lazy result DataFrame of one
silver table, gold report, quality suite or audit.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from mercato.plans import activity, gold, insight, layers, quality, silver, verify
from mercato.session import input_bytes, scratch_dir, shared_partitions
from mercato.sources import bronze as bronze_src
from mercato.sources import testdata
from mercato.sources.lazy import LazyTables

Query = Callable[[SparkSession, str], DataFrame]


# Bronze and silver DataFrames are lazy plans over read-only test tables, so
# a session defines them once per folder and every query derives from them
# (no data is cached: each action reads the files).  The key includes the
# settings that analysis binds into a plan.
# The cache hangs on the session and goes with it.


def _defined(spark: SparkSession, sf_dir: str) -> dict:
    key = (sf_dir.rstrip("/"), spark.conf.get("spark.sql.session.timeZone"),
           spark.conf.get("spark.sql.ansi.enabled"))
    per_session = spark.__dict__.setdefault("_mercato_defined", {})
    if key not in per_session:
        b = testdata.bronze_tables(spark, sf_dir)
        s = silver.build_silver(b, testdata.DEDUPE_ORDER).with_table("geo", lambda: b["geo"])

        def dealt() -> DataFrame:
            size = input_bytes(spark, [testdata.path(sf_dir, t) for t in ("lineitem", "orders")])
            return silver.clean_order_items(b["order_items"], b["orders"], shared_partitions(spark, size))

        per_session[key] = {"bronze": b, "silver": s, "by_order": s.with_table("order_items", dealt),
                            "derived": LazyTables({"guards": lambda: quality.run_guards(b)})}
    return per_session[key]


def bronze_for(spark: SparkSession, sf_dir: str) -> LazyTables:
    return _defined(spark, sf_dir)["bronze"]


def silver_for(spark: SparkSession, sf_dir: str) -> LazyTables:
    return _defined(spark, sf_dir)["silver"]


#: Reports that sort and aggregate the items by order in the tasks of silver's join.
BY_ORDER = ("state_performance", "product_reviews")


def _report(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return gold.REPORTS[name](_defined(spark, sf_dir)["by_order" if name in BY_ORDER else "silver"])


def _silver_query(name: str) -> Query:
    return lambda spark, sf_dir: silver_for(spark, sf_dir)[name]


def _gold_query(name: str) -> Query:
    return lambda spark, sf_dir: _report(spark, sf_dir, name)


_GUARDS: dict[str, Callable[[dict[str, DataFrame]], DataFrame]] = {
    "orders": lambda b: quality.guard_orders(b["orders"]),
    "customer": lambda b: quality.guard_customers(b["customers"]),
    "payments": lambda b: quality.guard_payments(b["order_payments"]),
    "product": lambda b: quality.guard_products(b["products"]),
    "relational": lambda b: quality.guard_relational_integrity(b["order_items"], b["orders"]),
}


def _guard_query(name: str) -> Query:
    guard = _GUARDS[name]
    return lambda spark, sf_dir: guard(bronze_for(spark, sf_dir))


def _guards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _defined(spark, sf_dir)["derived"]["guards"]


def quality_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.summary(_guards(spark, sf_dir))


def quality_detail(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.detail(_guards(spark, sf_dir))


def verify_silver_case(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = silver_for(spark, sf_dir)
    return verify.case_counts({t: s[t] for t in silver.SILVER_TABLES})


def verify_silver_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = silver_for(spark, sf_dir)
    return verify.row_counts({t: s[t] for t in silver.SILVER_TABLES})


def preview_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bronze_src.preview(spark, bronze_for(spark, sf_dir)["orders"], 5, order_by=("order_id",))


def quality_row_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Q6 over every bronze table."""
    return quality.guard_row_counts(bronze_for(spark, sf_dir))


def verify_gold_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return verify.row_counts({name: _report(spark, sf_dir, name) for name in gold.REPORTS})


def _events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return testdata.table(spark, sf_dir, "events")


ACTIVITY: dict[str, Query] = {
    "activity_visits": lambda spark, sf_dir: activity.visits(_events(spark, sf_dir)),
    "activity_last_touch": lambda spark, sf_dir: activity.last_touch(_events(spark, sf_dir)),
    "activity_last_order": lambda spark, sf_dir: activity.last_order(
        _events(spark, sf_dir), silver_for(spark, sf_dir)["orders"]),
    "activity_orders_during_delivery": lambda spark, sf_dir: activity.orders_during_delivery(
        silver_for(spark, sf_dir)["orders"]),
    "activity_incidents": lambda spark, sf_dir: activity.incidents(_events(spark, sf_dir)),
    "activity_streamed_hours": lambda spark, sf_dir: activity.streamed_hours(
        spark, f"{sf_dir}/events.parquet", scratch_dir(spark, f"stream-{uuid.uuid4().hex}")),
}


def _insight_query(report: Callable[[LazyTables], DataFrame]) -> Query:
    return lambda spark, sf_dir: report(silver_for(spark, sf_dir))


INSIGHT: dict[str, Query] = {
    "insight_payment_totals": _insight_query(insight.payment_totals),
    "insight_category_calendar": _insight_query(insight.category_calendar),
    "insight_top_products": _insight_query(insight.top_products),
    "insight_moving_revenue": _insight_query(insight.moving_revenue),
    "insight_distinct_customers": _insight_query(insight.distinct_customers),
    "insight_price_quantiles": _insight_query(insight.price_quantiles),
    "insight_cleaned_away": lambda spark, sf_dir: insight.cleaned_away(
        bronze_for(spark, sf_dir), silver_for(spark, sf_dir)),
    "insight_item_balance": lambda spark, sf_dir: insight.item_balance(
        bronze_for(spark, sf_dir), silver_for(spark, sf_dir)),
}


def queries() -> dict[str, Query]:
    out: dict[str, Query] = {}
    for name in silver.SILVER_TABLES:
        out[f"silver_{name}"] = _silver_query(name)
    for name in gold.REPORTS:
        out[f"gold_{name}"] = _gold_query(name)
    for name in _GUARDS:
        out[f"quality_{name}"] = _guard_query(name)
    out["quality_summary"] = quality_summary
    out["quality_detail"] = quality_detail
    out["verify_silver_case"] = verify_silver_case
    out["verify_silver_counts"] = verify_silver_counts
    out["preview_orders"] = preview_orders
    out["quality_row_counts"] = quality_row_counts
    out["verify_gold_counts"] = verify_gold_counts
    return out | ACTIVITY | INSIGHT | layers.QUERIES
