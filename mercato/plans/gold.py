"""Gold layer: fifteen business reports over the silver tables.

Every builder has the signature ``builder(tables) -> DataFrame`` where
``tables`` maps silver table names (and ``geo`` for the state document) to
DataFrames, so reports are testable without files.  Joins, group-bys and
sorts are plain DataFrame operations; Catalyst prunes every scan to the
columns a report needs and AQE picks broadcast or sort-merge joins from the
real sizes at runtime.

Descending sorts put nulls first, as the original reports did.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mercato.functions import (
    iso_weekday,
    mean,
    money_mean,
    money_mean_of,
    money_merged,
    money_parts,
    money_sum,
    money_total,
    month_start,
    n_unique,
    ratio_pct,
    whole_days,
)
from mercato.operators import join_on_columns, join_suffixed, left_join_split_nulls

Tables = Mapping[str, DataFrame]

# Fixed value: categories with at most this many reviews are left out of the
# review report.
MIN_REVIEWS = 50


def _desc(c: str):
    return F.col(c).desc_nulls_first()


def explode_states(geo_doc: DataFrame) -> DataFrame:
    """State features of a GeoJSON-like document: (state_id, state_name).

    ``features`` is ``array<struct<id, properties: struct<name>>>``; an empty
    or null list gives one null row, like an outer explode.
    """
    f = geo_doc.select(F.explode_outer("features").alias("f"))
    return f.select(F.col("f.id").alias("state_id"), F.col("f.properties.name").alias("state_name"))


def delivery_reliability(t: Tables) -> DataFrame:
    """G1: per customer, mean delay in whole days, late orders, late rate."""
    orders = t["orders"]
    delivered, estimated = F.col("order_delivered_customer_date"), F.col("order_estimated_delivery_date")
    per_customer = (
        orders.where(delivered.isNotNull() & estimated.isNotNull())
        .withColumn("delay_days", whole_days(estimated, delivered))
        .groupBy("customer_id")
        .agg(mean("delay_days").alias("avg_delay_days"),
             F.count_if(F.col("delay_days") > 0).alias("total_late_orders"),
             F.count(F.lit(1)).alias("total_orders")))
    return per_customer.withColumn("late_rate_pct", ratio_pct("total_late_orders", "total_orders"))


def regional_logistics_performance(t: Tables) -> DataFrame:
    """Per customer state, actual and estimated delivery days and the error."""
    joined = join_suffixed(t["orders"], t["customers"], "customer_id", "inner")
    purchase = F.col("order_purchase_timestamp")
    delivered = F.col("order_delivered_customer_date")
    return (
        joined.where(delivered.isNotNull() & purchase.isNotNull())
        .withColumns({
            "actual_days": whole_days(purchase, delivered),
            "estimated_days": whole_days(purchase, "order_estimated_delivery_date"),
        })
        .groupBy("customer_state")
        .agg(mean("actual_days").alias("avg_actual_delivery_time"),
             mean("estimated_days").alias("avg_forecasting_estimate"),
             mean(F.col("actual_days") - F.col("estimated_days")).alias("prediction_error_days"))
        .orderBy(_desc("avg_actual_delivery_time")))


def marketing_performance(t: Tables) -> DataFrame:
    """Per lead origin, leads, closed deals, days to close, conversion rate."""
    joined = join_suffixed(t["marketing_leads"], t["closed_deals"], "mql_id", "left")
    return (
        joined.withColumns({
            "is_converted": F.col("won_date").isNotNull(),
            "days_to_close": whole_days("first_contact_date", "won_date"),
        })
        .groupBy("origin")
        .agg(F.count("mql_id").alias("total_leads"),
             F.count_if(F.col("is_converted")).alias("converted_deals"),
             mean("days_to_close").alias("avg_days_to_close"))
        .withColumn("conversion_rate_pct", ratio_pct("converted_deals", "total_leads"))
        .orderBy(_desc("conversion_rate_pct")))


def _order_customer(t: Tables, how: str) -> DataFrame:
    """(order_id, customer_state) at order grain.

    Joining orders to customers before the items come in keeps the
    customer-key shuffle at order grain; item rows then move once, by
    order_id.  For chains of left joins this is the same result because the
    customer join only reads order columns and never matches a null key.
    In the left form, orders without a customer id bypass the join instead
    of all landing in one shuffle partition.
    """
    orders = t["orders"].select("order_id", "customer_id")
    customers = t["customers"].select("customer_id", "customer_state")
    if how == "left":
        joined = left_join_split_nulls(orders, customers, "customer_id")
    else:
        joined = join_suffixed(orders, customers, "customer_id", how)
    return joined.select("order_id", "customer_state")


def state_performance(t: Tables) -> DataFrame:
    """Per customer state, revenue, distinct orders, mean freight.

    Items whose order or customer is unknown fall into the null state.
    Items are first reduced to one row per order (partial sums and
    counts, combined map-side), which is exact: every item of an order meets the
    same order and customer rows, so sums scale with the same multiplicity.
    """
    per_order = t["order_items"].groupBy("order_id").agg(
        *money_parts("price", "price"), *money_parts("freight_value", "freight"))
    joined = join_suffixed(per_order, _order_customer(t, "left"), "order_id", "left")
    return (joined.groupBy("customer_state")
            .agg(money_total("price").alias("total_revenue"),
                 n_unique("order_id").alias("total_orders"),
                 money_mean_of("freight").alias("avg_freight_cost"))
            .orderBy(_desc("total_revenue")))


def _order_products(t: Tables, *parts) -> DataFrame:
    """Items reduced to one row per (order, product), combined map-side, so an
    order that holds very many items meets its reviews in few rows."""
    return t["order_items"].groupBy("order_id", "product_id").agg(F.count(F.lit(1)).alias("items"), *parts)


def _order_reviews(t: Tables) -> DataFrame:
    """Reviews per order: rows, score sum and number of scores, review ids."""
    return t["order_reviews"].groupBy("order_id").agg(
        F.count(F.lit(1)).alias("reviews"), F.sum("review_score").alias("score_sum"),
        F.count("review_score").alias("score_n"), F.count("review_id").alias("review_n"))


def category_performance(t: Tables) -> DataFrame:
    """Per English category, revenue, distinct orders, mean review score,
    distinct products.  An item is repeated once per review of its order, and
    its revenue with it.

    Items meet their product, move once, by order, become one row per
    (category, order) and meet their order's reviews there, of which there is
    one row; the repetition is a factor.  Distinct orders are row counts of
    that table; distinct products come from the product ids alone, which are
    reduced map-side before they move.
    """
    by = "product_category_name_english"
    products = t["products"].select("product_id", by)
    per_order = (t["order_items"].join(products, "product_id", "inner").select(by, "order_id", "price")
                 .repartition("order_id").groupBy(by, "order_id")
                 .agg(F.count(F.lit(1)).alias("items"), *money_parts("price", "price")))
    rows = per_order.join(_order_reviews(t), "order_id", "left").withColumn(
        "times", F.greatest(F.coalesce("reviews", F.lit(1)), F.lit(1)))
    sums = rows.groupBy(by).agg(
        *money_merged("price", "times"),
        F.sum(F.col("score_sum") * F.col("items")).alias("score_sum"),
        F.sum(F.col("score_n") * F.col("items")).alias("score_n"),
        F.count(F.lit(1)).alias("orders")).groupBy(by).agg(
        money_total("price").alias("total_revenue"), F.sum("orders").alias("order_count"),
        F.try_divide(F.sum("score_sum"), F.sum("score_n")).alias("average_review_score"))
    sold = t["order_items"].select("product_id").distinct().join(products.distinct(), "product_id", "inner")
    counts = sold.groupBy(F.col(by).alias("of")).agg(F.count(F.lit(1)).alias("product_count"))
    return (sums.join(counts, F.col(by).eqNullSafe(F.col("of")), "inner")
            .select(by, "total_revenue", "order_count", "average_review_score", "product_count")
            .orderBy(_desc("total_revenue")))


def seller_rankings(t: Tables) -> DataFrame:
    """Per seller, sales value, distinct products, item rows handled.

    The sums are combined map-side to a row per seller; only the distinct
    (seller, product) pairs, bare of sums, move as they are.
    """
    sums = t["order_items"].groupBy("seller_id").agg(
        money_sum("price").alias("total_sales_value"), F.count("order_id").alias("total_orders_handled"))
    offered = (t["order_items"].select(F.col("seller_id").alias("of"), "product_id").distinct()
               .groupBy("of").agg(F.count(F.lit(1)).alias("unique_products_offered")))
    return (sums.join(offered, F.col("seller_id").eqNullSafe(F.col("of")), "inner")
            .select("seller_id", "total_sales_value", "unique_products_offered", "total_orders_handled")
            .orderBy(_desc("total_sales_value")))


def sales_trends(t: Tables) -> DataFrame:
    """Per calendar month of completed orders, revenue, orders, mean order value."""
    orders = t["orders"].where(F.col("is_completed_transaction") == F.lit(True))
    joined = join_suffixed(orders, t["order_payments"], "order_id", "inner")
    ts = F.col("order_purchase_timestamp")
    return (
        joined.withColumns({
            "year": F.year(ts).cast("int"),
            "month": F.month(ts).cast("int"),
            "month_year": month_start(ts),
        })
        .groupBy("year", "month", "month_year")
        .agg(money_sum("payment_value").alias("total_revenue"),
             n_unique("order_id").alias("order_count"))
        .withColumn("average_order_value", F.try_divide(F.col("total_revenue"), F.col("order_count")))
        .orderBy("month_year"))


def product_reviews(t: Tables) -> DataFrame:
    """Per English category with more than 50 reviews, mean score and count.

    Same result as joining items, products and reviews row by row, with
    reductions before the wide shuffles: reviews become one row per order and
    items one per (order, product).  Every item of an order meets the same
    reviews, so sums and counts carry over; the rows, joined with their
    product, are combined map-side to one per category.
    """
    rows = (_order_products(t).join(_order_reviews(t), "order_id", "inner")
            .select("product_id", *[(F.col(c) * F.col("items")).alias(c) for c in ("score_sum", "score_n", "review_n")]))
    joined = rows.join(t["products"].select("product_id", "product_category_name_english"), "product_id", "inner")
    return (joined.groupBy("product_category_name_english")
            .agg(F.try_divide(F.sum("score_sum"), F.sum("score_n")).alias("avg_score"),
                 F.sum("review_n").cast("bigint").alias("review_count"))
            .where(F.col("review_count") > MIN_REVIEWS)
            .orderBy(_desc("avg_score")))


def payment_behavior(t: Tables) -> DataFrame:
    """Per payment type, mean value, mean installments, distinct orders."""
    joined = join_suffixed(t["order_payments"], t["orders"], "order_id", "inner")
    return (joined.groupBy("payment_type")
            .agg(money_mean("payment_value").alias("avg_value"),
                 mean("payment_installments").alias("avg_installments"),
                 n_unique("order_id").alias("transaction_count"))
            .orderBy(_desc("avg_value")))


def order_seasonality(t: Tables) -> DataFrame:
    """Orders per ISO weekday (Monday = 1) and hour of purchase."""
    ts = F.col("order_purchase_timestamp")
    return (t["orders"].withColumns({"weekday": iso_weekday(ts), "hour": F.hour(ts)})
            .groupBy("weekday", "hour")
            .agg(F.count("order_id").alias("order_volume"))
            .orderBy("weekday", "hour"))


def geo_distribution(t: Tables) -> DataFrame:
    """Customers per state that appears in the state document.

    Spark broadcasts the states when their measured size allows; otherwise
    both sides are plain shuffles, so a state holding many customers is split.
    """
    joined = join_on_columns(t["customers"], explode_states(t["geo"]), "customer_state", "state_id", "inner")
    return (joined.groupBy("customer_state", "state_name")
            .agg(F.count("customer_id").alias("customer_count")))


def geolocation_lookup(t: Tables) -> DataFrame:
    """The state document as a (state_id, state_name) dimension."""
    return explode_states(t["geo"])


def full_product_analysis(t: Tables) -> DataFrame:
    """Items with their product attributes, item grain (wide)."""
    return join_suffixed(t["order_items"], t["products"], "product_id", "inner")


def comprehensive_sales(t: Tables) -> DataFrame:
    """Orders with payments and customers, payment grain (wide)."""
    return join_suffixed(
        join_suffixed(t["orders"], t["order_payments"], "order_id", "inner"),
        t["customers"], "customer_id", "inner")


def logistics_flow(t: Tables) -> DataFrame:
    """Item rows per (seller state, customer state) pair.

    Inner joins commute, so orders meet customers first (order grain) and
    item rows are shuffled once, by order_id; sellers are a dimension that
    Spark broadcasts when its measured size allows.
    """
    origin = join_suffixed(t["order_items"].select("order_id", "seller_id"),
                           t["sellers"].select("seller_id", "seller_state"), "seller_id", "inner")
    joined = join_suffixed(origin, _order_customer(t, "inner"), "order_id", "inner")
    return (joined.select(F.col("seller_state").alias("origin"),
                          F.col("customer_state").alias("destination"),
                          F.col("order_id"))
            .groupBy("origin", "destination")
            .agg(F.count("order_id").alias("order_count")))


# G16 -- fixed values: the report output names, in build order.
REPORTS: dict[str, Callable[[Tables], DataFrame]] = {
    "state_performance": state_performance,
    "category_performance": category_performance,
    "seller_rankings": seller_rankings,
    "sales_trends": sales_trends,
    "order_seasonality": order_seasonality,
    "regional_logistics_performance": regional_logistics_performance,
    "logistics_flow": logistics_flow,
    "delivery_reliability": delivery_reliability,
    "marketing_performance": marketing_performance,
    "payment_behavior": payment_behavior,
    "product_reviews": product_reviews,
    "geo_distribution": geo_distribution,
    "geolocation_lookup": geolocation_lookup,
    "full_product_analysis": full_product_analysis,
    "comprehensive_sales": comprehensive_sales,
}
