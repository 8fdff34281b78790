"""Silver layer: cleaning rules, one pure function per table.

Every function maps bronze DataFrames to a silver DataFrame.  Columns the
rules do not name pass through untouched (``SELECT *`` semantics); the
rules are expressed with built-in functions only, so each table compiles to
one whole-stage-codegen pipeline plus, where a rule needs it, one shuffle
(keep-one-per-key, the orphan join, the products/translation join).
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mercato.functions import (
    blank_to_null,
    datetime_columns,
    parse_datetime,
    parse_datetime_inferred,
    strip_ws,
    upper_strip,
)
from mercato.operators import join_suffixed, keep_one_per_key
from mercato.sources.lazy import LazyTables

# Statuses that mark a finished and a failed order.
COMPLETED_STATUS = "delivered"
FAILED_STATUSES = ("canceled", "unavailable")
# The product weight range kept, in grams, inclusive.
MIN_WEIGHT_G = 1
MAX_WEIGHT_G = 50000


def clean_customers(customers: DataFrame, order_by: Sequence[str] | None = ("customer_id",)) -> DataFrame:
    """One row per ``customer_unique_id``; city and state trimmed, upper case."""
    kept = keep_one_per_key(customers, "customer_unique_id", order_by)
    return kept.withColumns({
        "customer_city": upper_strip("customer_city"),
        "customer_state": upper_strip("customer_state"),
    })


def clean_orders(orders: DataFrame) -> DataFrame:
    """Keep every row, flag completed and failed orders, parse the dates.

    Dates are the columns whose name mentions ``timestamp`` or ``date``:
    trimmed, the empty string made null, parsed with the order layout; text
    that does not parse is null.  All expressions see the input row.
    """
    status = F.col("order_status")
    exprs = {
        "is_completed_transaction": status == F.lit(COMPLETED_STATUS),
        "is_failed": status.isin(*FAILED_STATUSES),
    }
    for c in datetime_columns(orders.columns):
        exprs[c] = parse_datetime(blank_to_null(strip_ws(c)))
    return orders.withColumns(exprs)


def clean_order_items(items: DataFrame, orders: DataFrame, partitions: int | None = None) -> DataFrame:
    """Drop items of unknown orders, keep positive prices.

    An inner join (not a semi join): a repeated ``order_id`` in orders
    repeats its items.  Catalyst infers ``order_id IS NOT NULL`` on both
    sides, so null keys are dropped before the shuffle.

    ``partitions`` is for large tables and reports that go on by ``order_id``
    in the tasks of this join, with several sorts and hash tables over a
    partition: adaptive execution would merge partitions by their compressed
    size.  (Nor can it split a hot order there; elsewhere it can, without them.)
    """
    known = orders.select("order_id")
    if partitions:
        items, known = (t.repartition(partitions, "order_id") for t in (items, known))
    joined = items.join(known, on="order_id", how="inner")
    return joined.where(F.col("price") > 0).select(*items.columns)


def clean_products(products: DataFrame, translation: DataFrame) -> DataFrame:
    """C4: category present and weight within range; add the English name,
    falling back to the original name."""
    kept = products.where(
        F.col("product_category_name").isNotNull()
        & F.col("product_weight_g").between(MIN_WEIGHT_G, MAX_WEIGHT_G))
    joined = join_suffixed(kept, translation, "product_category_name", "left")
    return joined.withColumn(
        "product_category_name_english",
        F.coalesce(F.col("product_category_name_english"), F.col("product_category_name")))


def clean_marketing_leads(leads: DataFrame, order_by: Sequence[str] | None = None) -> DataFrame:
    """One row per ``mql_id``; first contact date parsed, bad text null."""
    kept = keep_one_per_key(leads, "mql_id", order_by)
    return kept.withColumn("first_contact_date", parse_datetime_inferred("first_contact_date"))


def clean_closed_deals(deals: DataFrame, order_by: Sequence[str] | None = None) -> DataFrame:
    """One row per ``mql_id``; won date parsed, bad text null."""
    kept = keep_one_per_key(deals, "mql_id", order_by)
    return kept.withColumn("won_date", parse_datetime_inferred("won_date"))


def clean_sellers(sellers: DataFrame) -> DataFrame:
    """City and state trimmed and upper case; no dedupe."""
    return sellers.withColumns({
        "seller_city": upper_strip("seller_city"),
        "seller_state": upper_strip("seller_state"),
    })


def clean_order_payments(payments: DataFrame) -> DataFrame:
    """Positive payment values only; payment type lower case."""
    return (payments.where(F.col("payment_value") > 0)
            .withColumn("payment_type", F.lower(F.col("payment_type"))))


def clean_order_reviews(reviews: DataFrame) -> DataFrame:
    """Parse both dates; a missing score becomes the median score.

    The median is an uncorrelated scalar subquery: Spark runs it once and
    substitutes the value -- no join, nothing collected by the caller.  An
    exact median keeps one counter per distinct score, which is bounded by
    the score scale.
    """
    median = reviews.select(F.median(F.col("review_score").cast("double"))).scalar()
    return reviews.withColumns({
        "review_creation_date": parse_datetime_inferred("review_creation_date"),
        "review_answer_timestamp": parse_datetime_inferred("review_answer_timestamp"),
        "review_score": F.coalesce(F.col("review_score").cast("double"), median),
    })


# The silver table names, in the order they are built
# (dependencies first within the stage: items read the silver orders).
SILVER_TABLES = (
    "orders", "customers", "sellers", "products", "marketing_leads",
    "closed_deals", "order_items", "order_payments", "order_reviews",
)


def build_silver(bronze: Mapping[str, DataFrame],
                 dedupe_order: Mapping[str, Sequence[str]] | None = None,
                 silver_orders: DataFrame | None = None) -> LazyTables:
    """All silver tables from bronze ones, each built on first use.

    ``dedupe_order`` names the columns that choose the kept row per key, by
    table; absent tables fall back to the defaults.  Items are checked
    against ``silver_orders`` when given, else against bronze orders (the
    same order ids: cleaning keeps every order).
    """
    order = dict(dedupe_order or {})
    b = bronze
    return LazyTables({
        "orders": lambda: clean_orders(b["orders"]),
        "customers": lambda: clean_customers(b["customers"], order.get("customers", ("customer_id",))),
        "sellers": lambda: clean_sellers(b["sellers"]),
        "products": lambda: clean_products(b["products"], b["product_category_name_translation"]),
        "marketing_leads": lambda: clean_marketing_leads(b["marketing_leads"], order.get("marketing_leads")),
        "closed_deals": lambda: clean_closed_deals(b["closed_deals"], order.get("closed_deals")),
        "order_items": lambda: clean_order_items(
            b["order_items"], silver_orders if silver_orders is not None else b["orders"]),
        "order_payments": lambda: clean_order_payments(b["order_payments"]),
        "order_reviews": lambda: clean_order_reviews(b["order_reviews"]),
    })
