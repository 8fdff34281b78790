"""Activity along time: visits, touch points, deliveries and incidents.

These tables are derived from the raw events (event_id, ts, user_id,
event_type, value) and the silver orders; a user is the customer of the same
number.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from mercato.operators.temporal import PLACE, asof_join, interval_join, micros, session_windows, without_zone
from mercato.streaming import event_stream

VISIT_GAP = 6 * 3600  # seconds without an event that end a visit
TOUCH_DAYS = 7  # a click counts for a purchase this long
STREAM_WINDOW, STREAM_LATE = "1 hour", "2 hours"


def _of_type(events: DataFrame, kind: str) -> DataFrame:
    return events.where(F.col("event_type") == kind)


def visits(events: DataFrame) -> DataFrame:
    """Visits of each user: events less than six hours apart."""
    marked = events.select("user_id", "ts", "value", (F.col("event_type") == "purchase").cast("int").alias("purchase"))
    return session_windows(marked, "user_id", "ts", VISIT_GAP, {
        "n_purchases": ("purchase", "sum"), "least_value": ("value", "min"), "largest_value": ("value", "max")})


def last_touch(events: DataFrame) -> DataFrame:
    """Each purchase with the user's latest click before it, of at most seven
    days ago."""
    purchases = _of_type(events, "purchase").select("event_id", "user_id", "ts", "value")
    clicks = _of_type(events, "click").select("user_id", F.col("event_id").alias("click_id"),
                                              F.col("ts").alias("clicked"))
    return asof_join(purchases, clicks, "user_id", "ts", "clicked", tie=["click_id"], strict=True,
                     tolerance_seconds=TOUCH_DAYS * 86_400)


def last_order(events: DataFrame, orders: DataFrame) -> DataFrame:
    """Each event with the customer's latest order placed until then."""
    placed = orders.select(F.col("customer_id").alias("user_id"), "order_id",
                           F.col("order_purchase_timestamp").alias("ordered"))
    return asof_join(events.select("event_id", "user_id", "ts"), placed, "user_id", "ts", "ordered",
                     tie=["order_id"], bucket_seconds=30 * 86_400)


def orders_during_delivery(orders: DataFrame) -> DataFrame:
    """Pairs of an order under way and another one that its customer places
    meanwhile."""
    spans = orders.select("customer_id", "order_id", F.col("order_purchase_timestamp").alias("ordered"),
                          F.col("order_delivered_customer_date").alias("delivered"))
    placed = orders.select("customer_id", F.col("order_id").alias("other_order_id"),
                           F.col("order_purchase_timestamp").alias("other_ordered"))
    pairs = interval_join(spans, placed, "ordered", "delivered", "other_ordered", by="customer_id")
    return pairs.where("order_id <> other_order_id")


def incidents(events: DataFrame) -> DataFrame:
    """An error opens an incident of as many seconds as its value; per
    incident, the other events that fall into it, of whichever user, and how
    many users they have."""
    opened = _of_type(events, "error").select(
        F.col("event_id").alias("incident_id"), F.col("ts").alias("opened"),
        (F.col("ts") + F.make_dt_interval(secs=F.floor("value").cast("decimal(18,6)"))).alias("closed"))
    # An incident that comes in several rows is one: they meet the events at one place.
    rows = opened.where("incident_id is not null and closed >= opened").groupBy("incident_id", "opened", "closed").agg(
        F.count(F.lit(1)).alias("times"))
    same = Window.partitionBy("incident_id", "opened")
    spans = rows.withColumn("until", F.max("closed").over(same))
    inside = interval_join(spans, events.select("event_id", "user_id", "ts"), "opened", "closed", "ts", until="until")
    per_user = inside.where("event_id <> incident_id").groupBy(*PLACE, "incident_id", "opened", "user_id").agg(
        F.sum("times").alias("n"))
    return per_user.groupBy(*PLACE, "incident_id", "opened").agg(
        F.sum("n").alias("n_events"), F.count(F.lit(1)).alias("n_users")).drop(*PLACE)


def streamed_hours(spark: SparkSession, events_path: str, folder: str) -> DataFrame:
    """Events per hour and type, kept up by a stream in ``folder``."""
    events = event_stream.read_events(spark, events_path, spark.read.parquet(events_path).schema)
    # Watermarks need instants; zone-free times are taken as instants and back.
    events = events.withColumn("ts", F.timestamp_micros(micros(events, "ts")))
    hours = event_stream.table(
        event_stream.windowed(events, "ts", STREAM_WINDOW, STREAM_LATE, ["event_type"],
                              n_events=F.count(F.lit(1)), largest_value=F.max("value")),
        folder, ["window_start", "event_type"])
    return hours.select(without_zone(F.col("window_start")).alias("window_start"), "event_type", "n_events",
                        "largest_value")
