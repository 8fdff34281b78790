"""Reports beyond the fifteen: subtotals, top products, moving sums, sketches
and the reconciliation of raw and clean items."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mercato.operators import reconcile, sketches
from mercato.operators.totals import moving, subtotals, top_rows
from mercato.plans.gold import comprehensive_sales

Tables = Mapping[str, DataFrame]

TOP_PRODUCTS = 3
WEEK = 7
QUANTILES = (0.5, 0.9)


def cents(c: str) -> Column:
    return F.round(F.col(c) * 100).cast("bigint")


def payment_totals(t: Tables) -> DataFrame:
    """Payments by customer state, year and payment type, with all subtotals."""
    rows = comprehensive_sales(t).withColumn("year", F.year("order_purchase_timestamp"))
    return subtotals(rows, ["customer_state", "year", "payment_type"], {
        "revenue_cents": (F.sum(cents("payment_value")), F.sum("revenue_cents")),
        "payments": (F.count(F.lit(1)), F.sum("payments")),
        "largest_payment": (F.max("payment_value"), F.max("largest_payment"))})


def category_calendar(t: Tables) -> DataFrame:
    """Items by category within year, and by month within year, with the years
    and the whole (grouping sets)."""
    placed = t["orders"].select("order_id", F.year("order_purchase_timestamp").alias("year"),
                                F.month("order_purchase_timestamp").alias("month"))
    kinds = t["products"].select("product_id", F.col("product_category_name_english").alias("category"))
    rows = t["order_items"].join(kinds, "product_id").join(placed, "order_id")
    return subtotals(rows, ["year", "month", "category"], {
        "items": (F.count(F.lit(1)), F.sum("items")), "revenue_cents": (F.sum(cents("price")), F.sum("revenue_cents"))},
        sets=[["year", "category"], ["year", "month"], ["year"], []])


def top_products(t: Tables) -> DataFrame:
    """The three products that bring each seller most, by revenue, then id."""
    sold = t["order_items"].groupBy("seller_id", "product_id").agg(
        F.sum(cents("price")).alias("revenue_cents"), F.count(F.lit(1)).alias("items"))
    return top_rows(sold, ["seller_id"], [F.col("revenue_cents").desc(), F.col("product_id")], TOP_PRODUCTS)


def moving_revenue(t: Tables) -> DataFrame:
    """Revenue per customer state and day of purchase, and of the seven days up
    to it."""
    daily = comprehensive_sales(t).groupBy("customer_state", F.col("order_purchase_timestamp").cast("date").alias("day")).agg(
        F.sum(cents("payment_value")).alias("revenue_cents"), F.count(F.lit(1)).alias("payments"))
    return moving(daily.where(F.col("day").isNotNull()), ["customer_state"], "day", WEEK,
                  {"week_revenue_cents": F.sum("revenue_cents"), "week_payments": F.sum("payments")})


def customer_sketches(t: Tables) -> DataFrame:
    """Distinct customers of each state and month as sketches."""
    rows = comprehensive_sales(t).withColumn("month", F.trunc(F.col("order_purchase_timestamp").cast("date"), "month"))
    return sketches.with_distinct(rows, ["customer_state", "month"], "customers", F.col("customer_id").cast("string"))


def distinct_customers(t: Tables) -> DataFrame:
    """Per month, merged from the states' sketches: the exact number of
    customers, and whether the estimate keeps its bound."""
    merged = sketches.merged_distinct(customer_sketches(t), ["month"], "customers")
    exact = comprehensive_sales(t).withColumn("month", F.trunc(F.col("order_purchase_timestamp").cast("date"), "month")
                                              ).select("month", "customer_id").distinct().groupBy(
        F.col("month").alias("of")).agg(F.count("customer_id").alias("n_customers"))
    off = F.abs(sketches.distinct_estimate("customers") - F.col("n_customers"))
    return merged.join(exact, F.col("month").eqNullSafe(F.col("of"))).select(
        "month", "n_customers",
        (off <= F.greatest(F.lit(1.0), F.lit(sketches.DISTINCT_BOUND) * F.col("n_customers"))).alias("within_bound"))


def price_quantiles(t: Tables) -> DataFrame:
    """Per category: items, and whether the sketched quantiles of the price
    keep their rank bound, counted over all items."""
    kinds = t["products"].select("product_id", F.col("product_category_name_english").alias("category"))
    rows = t["order_items"].join(kinds, "product_id").select("category", "product_id", "price")
    fine = sketches.with_quantiles(rows, ["category", "product_id"], "prices", F.col("price"))
    found = sketches.merged_quantiles(fine, ["category"], "prices").select(
        F.col("category").alias("of"), *(sketches.quantile("prices", q).alias(f"q{i}") for i, q in enumerate(QUANTILES)))
    counted = rows.join(found, F.col("category").eqNullSafe(F.col("of"))).groupBy("category").agg(
        F.count(F.lit(1)).alias("items"),
        *(F.avg((F.col("price") <= F.col(f"q{i}")).cast("double")).alias(f"upto{i}") for i in range(len(QUANTILES))),
        *(F.avg((F.col("price") < F.col(f"q{i}")).cast("double")).alias(f"below{i}") for i in range(len(QUANTILES))))
    bound = F.greatest(F.lit(sketches.RANK_BOUND), 1 / F.col("items"))
    return counted.select("category", "items", *(
        ((F.col(f"below{i}") - bound <= q) & (F.col(f"upto{i}") + bound >= q)).alias(f"within_{round(100 * q)}")
        for i, q in enumerate(QUANTILES)))


ITEM = ("order_id", "order_item_id", "product_id", "seller_id", "price", "freight_value")


def cleaned_away(bronze: Tables, silver: Tables) -> DataFrame:
    """Item rows that the raw and the clean table hold in different number."""
    return reconcile.differences(bronze["order_items"], silver["order_items"], ITEM)


def item_balance(bronze: Tables, silver: Tables) -> DataFrame:
    return reconcile.summary(bronze["order_items"], silver["order_items"], ITEM)
