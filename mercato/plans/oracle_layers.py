"""DuckDB twins of the queries on written layers (``plans/layers.py``): the
tables as they must come back from CSV, JSON and Parquet files."""

from __future__ import annotations

from collections.abc import Mapping

NOTE = ("'for customer ' || customer_id || ',' || chr(10) || 'order \"' || order_id || '\"' || chr(10) || 'end'")
RAW_TABLES = ("customers", "orders", "order_items", "products", "product_category_name_translation", "sellers",
              "order_payments", "order_reviews", "marketing_leads", "closed_deals")
SILVER_TABLES = ("orders", "customers", "sellers", "products", "marketing_leads", "closed_deals", "order_items",
                 "order_payments", "order_reviews")

_ORDER_IDS = "CAST(order_id AS VARCHAR) AS order_id, CAST(customer_id AS VARCHAR) AS customer_id"
_ITEM_IDS = ", ".join(f"CAST({c} AS VARCHAR) AS {c}" for c in ("order_id", "order_item_id", "product_id", "seller_id"))


def _all(parts) -> str:
    return " UNION ALL ".join(parts)


def layer_sql(gold: Mapping[str, str]) -> dict[str, str]:
    """The twins; ``gold``: the reports' own texts."""
    found = [f"SELECT 'silver' AS layer, '{t}' AS table_name, 'exists' AS \"check\", 'OK' AS severity, "
             f"'table found' AS detail, count(*) AS rows FROM silver_{t}" for t in SILVER_TABLES]
    found += [f"SELECT 'gold', '{name}', 'not_empty', CASE WHEN count(*) = 0 THEN 'WARN' ELSE 'OK' END, "
              f"CASE WHEN count(*) = 0 THEN 'report has 0 rows' ELSE 'report has rows' END, count(*) FROM ({sql})"
              for name, sql in gold.items()]
    found.append("SELECT 'all', NULL, 'verdict', 'OK', 'audit passed', NULL")
    return {
        "layer_ingest": _all(f"SELECT '{t}' AS table_name, true AS ok, count(*) AS rows, CAST(0 AS BIGINT) AS bad_values "
                             f"FROM raw_{t}" for t in RAW_TABLES),
        "layer_bronze_orders": f"SELECT * REPLACE ({_ORDER_IDS}), {NOTE} AS note FROM raw_orders",
        "layer_silver_orders": f"SELECT * REPLACE ({_ORDER_IDS}), {NOTE} AS note FROM silver_orders",
        "layer_silver_order_items": f"SELECT * REPLACE ({_ITEM_IDS}) FROM silver_order_items",
        "layer_gold_state_performance": gold["state_performance"],
        "layer_gold_product_reviews": gold["product_reviews"],
        "layer_states": "SELECT state_id, state_name FROM raw_geo_states",
        "layer_findings": _all(found),
    }
