"""DuckDB twins of the activity queries (``plans/activity.py``), written with
DuckDB's own means: gaps and islands, ``ASOF JOIN`` and inequality joins."""

from __future__ import annotations

VISITS_SQL = """
SELECT user_id, min(ts) AS session_start, max(ts) AS session_end, count(*) AS n_rows,
  CAST(sum(CASE WHEN event_type = 'purchase' THEN 1 ELSE 0 END) AS BIGINT) AS n_purchases,
  min(value) AS least_value, max(value) AS largest_value
FROM (
  SELECT *, sum(CASE WHEN apart THEN 1 ELSE 0 END) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS visit
  FROM (
    SELECT *, ts - lag(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id) >= INTERVAL 6 HOUR AS apart
    FROM events))
GROUP BY user_id, visit"""

LAST_TOUCH_SQL = """
WITH clicks AS (
  SELECT user_id, ts AS clicked, max(event_id) AS click_id FROM events WHERE event_type = 'click' GROUP BY ALL),
touched AS (
  SELECT p.event_id, p.user_id, p.ts, p.value, c.click_id, c.clicked
  FROM (SELECT * FROM events WHERE event_type = 'purchase') p
  ASOF LEFT JOIN clicks c ON p.user_id = c.user_id AND p.ts > c.clicked)
SELECT event_id, user_id, ts, value, CASE WHEN ts - clicked <= INTERVAL 7 DAY THEN click_id END AS click_id,
  CASE WHEN ts - clicked <= INTERVAL 7 DAY THEN clicked END AS clicked
FROM touched"""

LAST_ORDER_SQL = """
SELECT e.event_id, e.user_id, e.ts, o.order_id, o.ordered
FROM events e ASOF LEFT JOIN (
  SELECT customer_id, order_purchase_timestamp AS ordered, max(order_id) AS order_id
  FROM silver_orders WHERE order_purchase_timestamp IS NOT NULL GROUP BY ALL) o
ON e.user_id = o.customer_id AND e.ts >= o.ordered"""

DURING_DELIVERY_SQL = """
SELECT a.customer_id, a.order_id, a.order_purchase_timestamp AS ordered,
  a.order_delivered_customer_date AS delivered, b.order_id AS other_order_id,
  b.order_purchase_timestamp AS other_ordered
FROM silver_orders a JOIN silver_orders b ON a.customer_id = b.customer_id AND a.order_id <> b.order_id
  AND b.order_purchase_timestamp BETWEEN a.order_purchase_timestamp AND a.order_delivered_customer_date"""

INCIDENTS_SQL = """
SELECT i.event_id AS incident_id, i.ts AS opened, count(*) AS n_events, count(DISTINCT e.user_id) AS n_users
FROM (SELECT event_id, ts, ts + INTERVAL 1 SECOND * CAST(floor(value) AS BIGINT) AS closed
      FROM events WHERE event_type = 'error') i
JOIN events e ON e.ts >= i.ts AND e.ts <= i.closed AND e.event_id <> i.event_id
GROUP BY i.event_id, i.ts"""

HOURS_SQL = """
SELECT date_trunc('hour', ts) AS window_start, event_type, count(*) AS n_events, max(value) AS largest_value
FROM events GROUP BY ALL"""

ACTIVITY_SQL = {
    "activity_visits": VISITS_SQL,
    "activity_last_touch": LAST_TOUCH_SQL,
    "activity_last_order": LAST_ORDER_SQL,
    "activity_orders_during_delivery": DURING_DELIVERY_SQL,
    "activity_incidents": INCIDENTS_SQL,
    "activity_streamed_hours": HOURS_SQL,
}
