"""DuckDB twins of the further reports (``plans/insight.py``)."""

from __future__ import annotations

_SALES = """(
  SELECT o.*, p.payment_type, p.payment_value, c.customer_state
  FROM silver_orders o JOIN silver_order_payments p ON o.order_id = p.order_id
  JOIN silver_customers c ON o.customer_id = c.customer_id)"""
_SOLD = """(
  SELECT i.*, p.product_category_name_english AS category
  FROM silver_order_items i JOIN silver_products p ON i.product_id = p.product_id)"""
_CENTS = "CAST(sum(CAST(round({} * 100) AS BIGINT)) AS BIGINT)"
_ITEM = "order_id, order_item_id, product_id, seller_id, price, freight_value"

_BALANCE = f"""
SELECT {_ITEM}, sum(l)::BIGINT AS n_left, sum(r)::BIGINT AS n_right FROM (
  SELECT {_ITEM}, 1 AS l, 0 AS r FROM raw_order_items
  UNION ALL SELECT {_ITEM}, 0, 1 FROM silver_order_items) GROUP BY ALL"""

INSIGHT_SQL = {
    "insight_payment_totals": f"""
SELECT customer_state, year, payment_type,
  CAST(grouping_id(customer_state, year, payment_type) AS INTEGER) AS grouping_level,
  {_CENTS.format('payment_value')} AS revenue_cents, count(*) AS payments, max(payment_value) AS largest_payment
FROM (SELECT *, CAST(year(order_purchase_timestamp) AS INTEGER) AS year FROM {_SALES})
GROUP BY CUBE (customer_state, year, payment_type)""",
    "insight_category_calendar": f"""
SELECT year, month, category, CAST(grouping_id(year, month, category) AS INTEGER) AS grouping_level,
  count(*) AS items, {_CENTS.format('price')} AS revenue_cents
FROM (SELECT s.*, CAST(year(order_purchase_timestamp) AS INTEGER) AS year,
        CAST(month(order_purchase_timestamp) AS INTEGER) AS month
      FROM {_SOLD} s JOIN silver_orders o ON s.order_id = o.order_id)
GROUP BY GROUPING SETS ((year, category), (year, month), (year), ())""",
    "insight_top_products": f"""
SELECT seller_id, product_id, {_CENTS.format('price')} AS revenue_cents, count(*) AS items,
  CAST(row_number() OVER (PARTITION BY seller_id ORDER BY sum(CAST(round(price * 100) AS BIGINT)) DESC, product_id)
       AS INTEGER) AS rank
FROM silver_order_items GROUP BY seller_id, product_id QUALIFY rank <= 3""",
    "insight_moving_revenue": f"""
SELECT customer_state, day, revenue_cents, payments,
  CAST(sum(revenue_cents) OVER w AS BIGINT) AS week_revenue_cents, CAST(sum(payments) OVER w AS BIGINT) AS week_payments
FROM (SELECT customer_state, CAST(order_purchase_timestamp AS DATE) AS day,
        {_CENTS.format('payment_value')} AS revenue_cents, count(*) AS payments
      FROM {_SALES} WHERE order_purchase_timestamp IS NOT NULL GROUP BY ALL)
WINDOW w AS (PARTITION BY customer_state ORDER BY day RANGE BETWEEN INTERVAL 6 DAYS PRECEDING AND CURRENT ROW)""",
    "insight_distinct_customers": f"""
SELECT CAST(date_trunc('month', order_purchase_timestamp) AS DATE) AS month, count(DISTINCT customer_id) AS n_customers,
  true AS within_bound
FROM {_SALES} GROUP BY 1""",
    "insight_price_quantiles": f"""
SELECT category, count(*) AS items, true AS within_50, true AS within_90 FROM {_SOLD} GROUP BY category""",
    "insight_cleaned_away": f"SELECT * FROM ({_BALANCE}) WHERE n_left <> n_right",
    "insight_item_balance": f"""
SELECT sum(n_left)::BIGINT AS rows_left, sum(n_right)::BIGINT AS rows_right, sum(least(n_left, n_right))::BIGINT AS in_both,
  sum(greatest(n_left - n_right, 0))::BIGINT AS only_left, sum(greatest(n_right - n_left, 0))::BIGINT AS only_right
FROM ({_BALANCE})""",
}
