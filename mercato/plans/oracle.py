"""DuckDB twins of the registered queries (the correctness oracle).

Each query is a ``WITH`` chain: the bronze stand-in views (same SQL text the
Spark side runs), then silver, then the report.  The texts restate the
pipeline's rules in SQL of their own: characters, layouts and sums are stated
here again (money as decimals), not taken from the Spark code.
"""

from __future__ import annotations

from mercato.plans.oracle_activity import ACTIVITY_SQL
from mercato.plans.oracle_insight import INSIGHT_SQL
from mercato.plans.oracle_layers import layer_sql
from mercato.sources.testdata import raw_ctes

# The Unicode White_Space code points.
WHITE_SPACE = (9, 10, 11, 12, 13, 32, 133, 160, 5760, 8192, 8193, 8194, 8195, 8196, 8197, 8198, 8199, 8200, 8201,
               8202, 8232, 8233, 8239, 8287, 12288)
WS = "(" + " || ".join(f"chr({c})" for c in WHITE_SPACE) + ")"
# Layouts of dates whose layout is not given.
LAYOUTS = [f"%Y{d}%m{d}%d{t}" for d in "-/" for t in (
    " %H:%M:%S.%f", "T%H:%M:%S.%f", " %H:%M:%S", "T%H:%M:%S", " %H:%M", "T%H:%M", "")]


def _strip(c: str) -> str:
    return f"trim({c}, {WS})"


def _parse(c: str) -> str:
    return f"try_strptime({c}, '%Y-%m-%d %H:%M:%S')"


def _parse_inferred(c: str) -> str:
    return f"try_strptime({c}, {LAYOUTS})"


def _days(a: str, b: str) -> str:
    return f"date_sub('day', {a}, {b})"


def _mean(c: str) -> str:
    return f"(CAST(sum({c}) AS DOUBLE) / count({c}))"


def _money_sum(c: str) -> str:
    return f"CAST(coalesce(sum(CAST({c} AS DECIMAL(18, 2))), 0) AS DOUBLE)"


def _money_mean(c: str) -> str:
    return f"({_money_sum(c)} / nullif(count({c}), 0))"


def _n_unique(c: str) -> str:
    return f"CAST(count(DISTINCT {c}) + max(CASE WHEN {c} IS NULL THEN 1 ELSE 0 END) AS BIGINT)"


def _pct(a: str, b: str) -> str:
    return f"(CAST({a} AS DOUBLE) / nullif({b}, 0) * 100)"


SILVER_CTES: dict[str, str] = {
    "silver_orders": f"""
        SELECT order_id, customer_id, order_status,
               {_parse(f"nullif({_strip('order_purchase_timestamp')}, '')")} AS order_purchase_timestamp,
               {_parse(f"nullif({_strip('order_delivered_customer_date')}, '')")} AS order_delivered_customer_date,
               {_parse(f"nullif({_strip('order_estimated_delivery_date')}, '')")} AS order_estimated_delivery_date,
               order_status = 'delivered' AS is_completed_transaction,
               order_status IN ('canceled', 'unavailable') AS is_failed
        FROM raw_orders""",
    "silver_customers": f"""
        SELECT customer_id, customer_unique_id,
               upper({_strip('customer_city')}) AS customer_city,
               upper({_strip('customer_state')}) AS customer_state
        FROM (SELECT *, row_number() OVER (PARTITION BY customer_unique_id
                                           ORDER BY customer_id NULLS FIRST) AS rn
              FROM raw_customers)
        WHERE rn = 1""",
    "silver_sellers": f"""
        SELECT seller_id, upper({_strip('seller_city')}) AS seller_city,
               upper({_strip('seller_state')}) AS seller_state
        FROM raw_sellers""",
    "silver_products": """
        SELECT p.product_id, p.product_category_name, p.product_weight_g, p.product_length_cm,
               p.product_height_cm, p.product_width_cm,
               coalesce(t.product_category_name_english, p.product_category_name)
                   AS product_category_name_english
        FROM (SELECT * FROM raw_products
              WHERE product_category_name IS NOT NULL AND product_weight_g BETWEEN 1 AND 50000) p
        LEFT JOIN raw_product_category_name_translation t
               ON p.product_category_name = t.product_category_name""",
    "silver_marketing_leads": f"""
        SELECT mql_id, {_parse_inferred('first_contact_date')} AS first_contact_date, origin, event_id
        FROM (SELECT *, row_number() OVER (PARTITION BY mql_id ORDER BY event_id NULLS FIRST) AS rn
              FROM raw_marketing_leads)
        WHERE rn = 1""",
    "silver_closed_deals": f"""
        SELECT mql_id, {_parse_inferred('won_date')} AS won_date, event_id
        FROM (SELECT *, row_number() OVER (PARTITION BY mql_id ORDER BY event_id NULLS FIRST) AS rn
              FROM raw_closed_deals)
        WHERE rn = 1""",
    "silver_order_items": """
        SELECT i.order_id, i.order_item_id, i.product_id, i.seller_id, i.price, i.freight_value
        FROM raw_order_items i JOIN (SELECT order_id FROM raw_orders) o ON i.order_id = o.order_id
        WHERE i.price > 0""",
    "silver_order_payments": """
        SELECT order_id, payment_sequential, lower(payment_type) AS payment_type,
               payment_installments, payment_value
        FROM raw_order_payments WHERE payment_value > 0""",
    "silver_order_reviews": f"""
        SELECT review_id, order_id,
               coalesce(CAST(review_score AS DOUBLE),
                        (SELECT median(CAST(review_score AS DOUBLE)) FROM raw_order_reviews)) AS review_score,
               {_parse_inferred('review_creation_date')} AS review_creation_date,
               {_parse_inferred('review_answer_timestamp')} AS review_answer_timestamp
        FROM raw_order_reviews""",
}

SILVER_SQL = {name[len("silver_"):]: f"SELECT * FROM {name}" for name in SILVER_CTES}

GOLD_SQL: dict[str, str] = {
    "delivery_reliability": f"""
        SELECT customer_id, avg_delay_days, total_late_orders, total_orders,
               {_pct('total_late_orders', 'total_orders')} AS late_rate_pct
        FROM (SELECT customer_id, {_mean('delay_days')} AS avg_delay_days,
                     CAST(count_if(delay_days > 0) AS BIGINT) AS total_late_orders,
                     CAST(count(*) AS BIGINT) AS total_orders
              FROM (SELECT customer_id,
                           {_days('order_estimated_delivery_date', 'order_delivered_customer_date')} AS delay_days
                    FROM silver_orders
                    WHERE order_delivered_customer_date IS NOT NULL
                      AND order_estimated_delivery_date IS NOT NULL)
              GROUP BY customer_id)""",
    "regional_logistics_performance": f"""
        SELECT customer_state, {_mean('actual_days')} AS avg_actual_delivery_time,
               {_mean('estimated_days')} AS avg_forecasting_estimate,
               {_mean('actual_days - estimated_days')} AS prediction_error_days
        FROM (SELECT c.customer_state,
                     {_days('o.order_purchase_timestamp', 'o.order_delivered_customer_date')} AS actual_days,
                     {_days('o.order_purchase_timestamp', 'o.order_estimated_delivery_date')} AS estimated_days
              FROM silver_orders o JOIN silver_customers c ON o.customer_id = c.customer_id
              WHERE o.order_delivered_customer_date IS NOT NULL AND o.order_purchase_timestamp IS NOT NULL)
        GROUP BY customer_state
        ORDER BY avg_actual_delivery_time DESC NULLS FIRST""",
    "marketing_performance": f"""
        SELECT origin, total_leads, converted_deals, avg_days_to_close,
               {_pct('converted_deals', 'total_leads')} AS conversion_rate_pct
        FROM (SELECT l.origin, CAST(count(l.mql_id) AS BIGINT) AS total_leads,
                     CAST(count_if(d.won_date IS NOT NULL) AS BIGINT) AS converted_deals,
                     {_mean(_days('l.first_contact_date', 'd.won_date'))} AS avg_days_to_close
              FROM silver_marketing_leads l LEFT JOIN silver_closed_deals d ON l.mql_id = d.mql_id
              GROUP BY l.origin)
        ORDER BY conversion_rate_pct DESC NULLS FIRST""",
    "state_performance": f"""
        SELECT c.customer_state, {_money_sum('i.price')} AS total_revenue,
               {_n_unique('i.order_id')} AS total_orders,
               {_money_mean('i.freight_value')} AS avg_freight_cost
        FROM silver_order_items i
        LEFT JOIN silver_orders o ON i.order_id = o.order_id
        LEFT JOIN silver_customers c ON o.customer_id = c.customer_id
        GROUP BY c.customer_state
        ORDER BY total_revenue DESC NULLS FIRST""",
    "category_performance": f"""
        SELECT p.product_category_name_english, {_money_sum('i.price')} AS total_revenue,
               {_n_unique('i.order_id')} AS order_count,
               {_mean('r.review_score')} AS average_review_score,
               {_n_unique('i.product_id')} AS product_count
        FROM silver_order_items i
        JOIN silver_products p ON i.product_id = p.product_id
        LEFT JOIN silver_order_reviews r ON i.order_id = r.order_id
        GROUP BY p.product_category_name_english
        ORDER BY total_revenue DESC NULLS FIRST""",
    "seller_rankings": f"""
        SELECT seller_id, {_money_sum('price')} AS total_sales_value,
               {_n_unique('product_id')} AS unique_products_offered,
               CAST(count(order_id) AS BIGINT) AS total_orders_handled
        FROM silver_order_items GROUP BY seller_id
        ORDER BY total_sales_value DESC NULLS FIRST""",
    "sales_trends": f"""
        SELECT year, month, month_year, total_revenue, order_count,
               total_revenue / nullif(order_count, 0) AS average_order_value
        FROM (SELECT CAST(year(o.order_purchase_timestamp) AS INTEGER) AS year,
                     CAST(month(o.order_purchase_timestamp) AS INTEGER) AS month,
                     CAST(date_trunc('month', o.order_purchase_timestamp) AS TIMESTAMP) AS month_year,
                     {_money_sum('p.payment_value')} AS total_revenue,
                     {_n_unique('o.order_id')} AS order_count
              FROM silver_orders o JOIN silver_order_payments p ON o.order_id = p.order_id
              WHERE o.is_completed_transaction = true
              GROUP BY ALL)
        ORDER BY month_year""",
    "product_reviews": f"""
        SELECT p.product_category_name_english, {_mean('r.review_score')} AS avg_score,
               CAST(count(r.review_id) AS BIGINT) AS review_count
        FROM silver_order_items i
        JOIN silver_products p ON i.product_id = p.product_id
        JOIN silver_order_reviews r ON i.order_id = r.order_id
        GROUP BY p.product_category_name_english
        HAVING count(r.review_id) > 50
        ORDER BY avg_score DESC NULLS FIRST""",
    "payment_behavior": f"""
        SELECT p.payment_type, {_money_mean('p.payment_value')} AS avg_value,
               {_mean('p.payment_installments')} AS avg_installments,
               {_n_unique('p.order_id')} AS transaction_count
        FROM silver_order_payments p JOIN silver_orders o ON p.order_id = o.order_id
        GROUP BY p.payment_type
        ORDER BY avg_value DESC NULLS FIRST""",
    "order_seasonality": """
        SELECT CAST(isodow(order_purchase_timestamp) AS INTEGER) AS weekday,
               CAST(hour(order_purchase_timestamp) AS INTEGER) AS hour,
               CAST(count(order_id) AS BIGINT) AS order_volume
        FROM silver_orders GROUP BY ALL ORDER BY weekday NULLS FIRST, hour NULLS FIRST""",
    "geo_distribution": """
        SELECT c.customer_state, g.state_name, CAST(count(c.customer_id) AS BIGINT) AS customer_count
        FROM silver_customers c JOIN raw_geo_states g ON c.customer_state = g.state_id
        GROUP BY ALL""",
    "geolocation_lookup": "SELECT state_id, state_name FROM raw_geo_states",
    "full_product_analysis": """
        SELECT i.*, p.product_category_name, p.product_weight_g, p.product_length_cm,
               p.product_height_cm, p.product_width_cm, p.product_category_name_english
        FROM silver_order_items i JOIN silver_products p ON i.product_id = p.product_id""",
    "comprehensive_sales": """
        SELECT o.*, p.payment_sequential, p.payment_type, p.payment_installments, p.payment_value,
               c.customer_unique_id, c.customer_city, c.customer_state
        FROM silver_orders o
        JOIN silver_order_payments p ON o.order_id = p.order_id
        JOIN silver_customers c ON o.customer_id = c.customer_id""",
    "logistics_flow": """
        SELECT s.seller_state AS origin, c.customer_state AS destination,
               CAST(count(i.order_id) AS BIGINT) AS order_count
        FROM silver_order_items i
        JOIN silver_sellers s ON i.seller_id = s.seller_id
        JOIN silver_orders o ON i.order_id = o.order_id
        JOIN silver_customers c ON o.customer_id = c.customer_id
        GROUP BY ALL""",
}


def _rule_sql(dataset: str, dataset_order: int, rule_order: int, rule: str, column: str | None,
              failures: str, success: str, source: str, note: str | None = None) -> str:
    col = f"'{column}'" if column else "CAST(NULL AS VARCHAR)"
    nt = "'" + note.replace("'", "''") + "'" if note else "CAST(NULL AS VARCHAR)"
    return (f"SELECT '{dataset}' AS dataset, CAST({dataset_order} AS INTEGER) AS dataset_order, "
            f"CAST({rule_order} AS INTEGER) AS rule_order, '{rule}' AS rule, {col} AS column_name, "
            f"{success} AS success, CAST({failures} AS BIGINT) AS failures, {nt} AS note FROM {source}")


def _count_if(cond: str) -> str:
    return f"CAST(count_if({cond}) AS BIGINT)"


def _unique_sql(dataset: str, dso: int, ro: int, table: str, column: str) -> str:
    src = (f"(SELECT coalesce(sum(n), 0) AS f FROM (SELECT {column}, count(*) AS n FROM {table} "
           f"WHERE {column} IS NOT NULL GROUP BY {column} HAVING count(*) > 1))")
    return _rule_sql(dataset, dso, ro, "expect_column_values_to_be_unique", column, "f", "f = 0", src)


def _simple(dataset, dso, ro, rule, column, bad, table, note=None):
    return _rule_sql(dataset, dso, ro, rule, column, _count_if(bad), f"{_count_if(bad)} = 0", table, note)


# Fixed values (as in the quality plans): statuses and notes.
_STATUSES = "('delivered', 'shipped', 'canceled', 'invoiced', 'processing', 'approved', 'unavailable', 'created')"
_NOTE_CATEGORY = "Critical for downstream sales analysis by department."
_NOTE_DIMENSION = "Ensures logistics calculations do not divide by zero or negative."

QUALITY_SQL: dict[str, str] = {
    "orders": " UNION ALL ".join([
        _simple("Orders", 0, 0, "expect_column_values_to_not_be_null", "order_id",
                "order_id IS NULL", "raw_orders"),
        _unique_sql("Orders", 0, 1, "raw_orders", "order_id"),
        _simple("Orders", 0, 2, "expect_column_values_to_be_in_set", "order_status",
                f"order_status IS NOT NULL AND order_status NOT IN {_STATUSES}", "raw_orders"),
    ]),
    "customer": " UNION ALL ".join([
        _simple("Customer", 1, 0, "expect_column_values_to_not_be_null", "customer_id",
                "customer_id IS NULL", "raw_customers"),
        _unique_sql("Customer", 1, 1, "raw_customers", "customer_id"),
        _simple("Customer", 1, 2, "expect_column_value_lengths_to_be_between", "customer_state",
                "customer_state IS NOT NULL AND (length(customer_state) < 2 OR length(customer_state) > 2)",
                "raw_customers"),
    ]),
    "payments": " UNION ALL ".join([
        _simple("Payments", 2, 0, "expect_column_values_to_not_be_null", "payment_value",
                "payment_value IS NULL", "raw_order_payments"),
        _simple("Payments", 2, 1, "expect_column_values_to_be_between", "payment_value",
                "payment_value IS NOT NULL AND payment_value < 0", "raw_order_payments"),
    ]),
    "product": " UNION ALL ".join(
        [_simple("Product", 3, 0, "expect_column_values_to_not_be_null", "product_category_name",
                 "product_category_name IS NULL", "raw_products", _NOTE_CATEGORY)]
        + [_simple("Product", 3, i + 1, "expect_column_values_to_be_between", c,
                   f"{c} IS NOT NULL AND {c} < 0.1", "raw_products", _NOTE_DIMENSION)
           for i, c in enumerate(["product_weight_g", "product_length_cm",
                                  "product_height_cm", "product_width_cm"])]),
    "relational": _rule_sql(
        "Relational", 4, 0, "expect_table_row_count_to_be_between", None, "f", "f = 0",
        "(SELECT count(*) AS f FROM raw_order_items i WHERE i.order_id IS NULL OR NOT EXISTS "
        "(SELECT 1 FROM raw_orders o WHERE o.order_id = i.order_id))"),
}

_ALL_RULES = " UNION ALL ".join(f"({q})" for q in QUALITY_SQL.values())

QUALITY_SUMMARY_SQL = f"""
    SELECT dataset, CASE WHEN bool_and(success) THEN 'PASS' ELSE 'FAIL' END AS result,
           printf('%.1f%%', avg(CAST(success AS INTEGER)) * 100) AS success_rate,
           CAST(sum(failures) AS BIGINT) AS exceptions
    FROM ({_ALL_RULES}) GROUP BY dataset, dataset_order ORDER BY dataset_order"""

QUALITY_DETAIL_SQL = f"""
    SELECT dataset, dataset_order, rule_order,
           array_to_string(list_transform(string_split(replace(replace(rule, 'expect_', ''), '_', ' '), ' '),
                                          lambda w: upper(w[1]) || lower(w[2:])), ' ') AS expectation_rule,
           CASE WHEN success THEN 'VALID' ELSE 'INVALID' END AS status,
           coalesce(column_name, 'Table-Level') AS column_logic,
           failures,
           coalesce(note, 'Standard validation check.') AS business_impact
    FROM ({_ALL_RULES}) ORDER BY dataset_order, rule_order"""

VERIFY_CASE_SQL = " UNION ALL ".join(
    f"SELECT '{t}' AS table_name, '{c}' AS column_name, "
    f"CAST(count_if(regexp_matches({c}, '[a-z]')) AS BIGINT) AS lowercase_rows FROM silver_{t}"
    for t, c in [("customers", "customer_city"), ("customers", "customer_state"),
                 ("sellers", "seller_city"), ("sellers", "seller_state")])


VERIFY_COUNTS_SQL = " UNION ALL ".join(
    f"SELECT '{t}' AS table_name, CAST(count(*) AS BIGINT) AS rows FROM silver_{t}"
    for t in ("orders", "customers", "sellers", "products", "marketing_leads", "closed_deals",
              "order_items", "order_payments", "order_reviews"))


VERIFY_GOLD_COUNTS_SQL = " UNION ALL ".join(
    f"SELECT '{name}' AS table_name, CAST(count(*) AS BIGINT) AS rows FROM ({sql})" for name, sql in GOLD_SQL.items())

ROW_COUNTS_SQL = " UNION ALL ".join(
    _rule_sql(t, i, 0, "expect_table_row_count_to_be_between", None, "0", "n >= 1",
              f"(SELECT count(*) AS n FROM raw_{t})")
    for i, t in enumerate(("customers", "sellers", "orders", "order_items", "products",
                           "product_category_name_translation", "order_payments", "order_reviews", "marketing_leads",
                           "closed_deals")))


def with_ctes(body: str) -> str:
    ctes = {**raw_ctes(), **SILVER_CTES}
    return "WITH " + ",\n".join(f"{k} AS ({v})" for k, v in ctes.items()) + "\n" + body


def oracle_queries() -> dict[str, str]:
    out: dict[str, str] = {}
    for name, sql in SILVER_SQL.items():
        out[f"silver_{name}"] = with_ctes(sql)
    for name, sql in GOLD_SQL.items():
        out[f"gold_{name}"] = with_ctes(sql)
    for name, sql in QUALITY_SQL.items():
        out[f"quality_{name}"] = with_ctes(sql)
    out["quality_summary"] = with_ctes(QUALITY_SUMMARY_SQL)
    out["quality_detail"] = with_ctes(QUALITY_DETAIL_SQL)
    out["verify_silver_case"] = with_ctes(VERIFY_CASE_SQL)
    out["verify_silver_counts"] = with_ctes(VERIFY_COUNTS_SQL)
    out["verify_gold_counts"] = with_ctes(VERIFY_GOLD_COUNTS_SQL)
    out["quality_row_counts"] = with_ctes(ROW_COUNTS_SQL)
    for name, sql in (ACTIVITY_SQL | INSIGHT_SQL | layer_sql(GOLD_SQL)).items():
        out[name] = with_ctes(f"SELECT * FROM ({sql})")
    out["preview_orders"] = with_ctes("SELECT * FROM raw_orders ORDER BY order_id LIMIT 5")
    return out


# Sort keys of the ordered results: (column, descending).
SORTED: dict[str, list[tuple[str, bool]]] = {
    "gold_regional_logistics_performance": [("avg_actual_delivery_time", True)],
    "gold_marketing_performance": [("conversion_rate_pct", True)],
    "gold_state_performance": [("total_revenue", True)],
    "gold_category_performance": [("total_revenue", True)],
    "gold_seller_rankings": [("total_sales_value", True)],
    "gold_sales_trends": [("month_year", False)],
    "gold_product_reviews": [("avg_score", True)],
    "gold_payment_behavior": [("avg_value", True)],
    "gold_order_seasonality": [("weekday", False), ("hour", False)],
    "quality_summary": [("dataset", False)],
    "quality_detail": [("dataset_order", False), ("rule_order", False)],
    "preview_orders": [("order_id", False)],
}
