"""Every registered query against its DuckDB twin on the smallest tables."""

import pytest

import __spark_entry__ as entry
from mercato.plans import registry
from mercato.plans import oracle
from tests.oracle_check import duck_connection, in_order_duck, in_order_spark, rows_of_duck, rows_of_spark

SF = "/root/testdata/sf0.001"
QUERIES = registry.queries()
SQL = oracle.oracle_queries()


@pytest.fixture(scope="module")
def duck():
    return duck_connection(SF)


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_matches_oracle(spark, duck, name):
    s_cols, s_rows, _ = rows_of_spark(QUERIES[name](spark, SF))
    d_cols, d_rows, _ = rows_of_duck(duck, SQL[name])
    assert s_cols == d_cols
    assert len(s_rows) == len(d_rows)
    assert s_rows == d_rows


@pytest.mark.parametrize("name", sorted(oracle.SORTED))
def test_result_is_in_the_order_of_its_sort_keys(spark, duck, name):
    keys = oracle.SORTED[name]
    if name == "quality_summary":  # ordered by a column it does not return
        assert [r.dataset for r in QUERIES[name](spark, SF).collect()] == [
            "Orders", "Customer", "Payments", "Product", "Relational"]
        return
    assert in_order_spark(QUERIES[name](spark, SF), keys) == in_order_duck(duck, SQL[name], keys)


def test_every_query_of_the_registry_has_an_oracle():
    assert set(registry.queries()) == set(oracle.oracle_queries())
    assert set(SQL) <= set(QUERIES)


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.count() > 0
    assert df.columns == ["customer_state", "total_revenue", "total_orders", "avg_freight_cost"]


def test_preview_rows(spark):
    assert QUERIES["preview_orders"](spark, SF).count() == 5


@pytest.mark.parametrize("zone", ["America/New_York", "Asia/Kolkata"])
def test_results_do_not_depend_on_session_zone(spark, duck, zone):
    old = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        for name in ("silver_orders", "silver_closed_deals", "gold_order_seasonality",
                     "gold_sales_trends", "gold_delivery_reliability"):
            s_cols, s_rows, _ = rows_of_spark(QUERIES[name](spark, SF))
            d_cols, d_rows, _ = rows_of_duck(duck, SQL[name])
            assert (s_cols, s_rows) == (d_cols, d_rows), name
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)
