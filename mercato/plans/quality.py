"""Quality stage: rule suites over the bronze tables and the health report.

Results are data (a DataFrame, one row per rule); failing rules never stop
the run unless the caller opts in with ``fail_on``.  Each suite costs one
aggregation pass over its table, plus one group-by per uniqueness rule and
one anti join for referential integrity.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from datetime import datetime
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mercato.operators import expectations as ex

# The order statuses a raw order may carry.
VALID_STATUSES = ("delivered", "shipped", "canceled", "invoiced", "processing",
                  "approved", "unavailable", "created")
# Notes attached to the product rules, and the text printed
# for a rule without a note.
NOTE_CATEGORY = "Critical for downstream sales analysis by department."
NOTE_DIMENSION = "Ensures logistics calculations do not divide by zero or negative."
DEFAULT_NOTE = "Standard validation check."
# The product dimension columns and their lower bound.
DIMENSION_COLUMNS = ("product_weight_g", "product_length_cm", "product_height_cm", "product_width_cm")
MIN_DIMENSION = 0.1

# Report wording -- the label of a table-level rule, the
# verdict words, and the Markdown headings and table headers.
TABLE_LEVEL = "Table-Level"
PASS, FAIL, VALID, INVALID = "PASS", "FAIL", "VALID", "INVALID"
REPORT_TITLE = "# DATA QUALITY AUDIT"
SUMMARY_HEADING = "## 1. Executive Summary"
SUMMARY_HEADER = ("| Dataset | Result | Success Rate | Exceptions |", "| :--- | :--- | :--- | :--- |")
DETAIL_HEADING = "## 2. Detailed Validation Logs"
DETAIL_HEADER = ("| Expectation Rule | Status | Column / Logic | Failures | Business Impact |",
                 "| :--- | :--- | :--- | :--- | :--- |")

# The datasets' display names, in run order.
DATASETS = ("Orders", "Customer", "Payments", "Product", "Relational")


BRONZE_TABLES = ("customers", "sellers", "orders", "order_items", "products", "product_category_name_translation",
                 "order_payments", "order_reviews", "marketing_leads", "closed_deals")


def guard_orders(orders: DataFrame, order_keys: DataFrame | None = None) -> DataFrame:
    """Order ids present and unique; status within the known set."""
    name = "Orders"
    return ex.validate(orders, name, [
        ex.not_null("order_id"),
        ex.unique("order_id"),
        ex.in_set("order_status", VALID_STATUSES),
    ], DATASETS.index(name), counts={"order_id": order_keys} if order_keys is not None else None)


def guard_customers(customers: DataFrame) -> DataFrame:
    """Customer ids present and unique; state codes of two characters."""
    name = "Customer"
    return ex.validate(customers, name, [
        ex.not_null("customer_id"),
        ex.unique("customer_id"),
        ex.length_between("customer_state", 2, 2),
    ], DATASETS.index(name))


def guard_payments(payments: DataFrame) -> DataFrame:
    """Payment values present and not negative."""
    name = "Payments"
    return ex.validate(payments, name, [
        ex.not_null("payment_value"),
        ex.between("payment_value", 0, None),
    ], DATASETS.index(name))


def guard_products(products: DataFrame) -> DataFrame:
    """Q7d: category present; weight and dimensions at least 0.1."""
    name = "Product"
    rules = [ex.not_null("product_category_name", note=NOTE_CATEGORY)]
    rules += [ex.between(c, MIN_DIMENSION, None, note=NOTE_DIMENSION) for c in DIMENSION_COLUMNS]
    return ex.validate(products, name, rules, DATASETS.index(name))


def guard_relational_integrity(items: DataFrame, orders: DataFrame,
                               order_keys: DataFrame | None = None) -> DataFrame:
    """Q8: every order item points at a known order."""
    name = "Relational"
    return ex.orphan_rule(items, orders, "order_id", name, DATASETS.index(name), parent_keys=order_keys)


def guard_row_counts(bronze: Mapping[str, DataFrame], tables: Iterable[str] = BRONZE_TABLES) -> DataFrame:
    """Q6 for each bronze table: at least one row."""
    parts = [ex.validate(bronze[t], t, [ex.row_count_between(1, None)], i) for i, t in enumerate(tables)]
    return reduce(DataFrame.unionByName, parts)


def run_guards(bronze: Mapping[str, DataFrame]) -> DataFrame:
    """Q12: all suites, one row per rule (lazy).

    The per-order-id row counts serve both the uniqueness rule and the orphan
    check, so the order keys are aggregated (and shuffled) once.
    """
    order_keys = ex.key_counts(bronze["orders"], "order_id")
    parts = [
        guard_orders(bronze["orders"], order_keys),
        guard_customers(bronze["customers"]),
        guard_payments(bronze["order_payments"]),
        guard_products(bronze["products"]),
        guard_relational_integrity(bronze["order_items"], bronze["orders"], order_keys),
    ]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def summary(results: DataFrame) -> DataFrame:
    """Q10: per dataset, PASS/FAIL, share of rules passed, total failures."""
    return (results.groupBy("dataset", "dataset_order")
            .agg(F.when(F.bool_and("success"), F.lit(PASS)).otherwise(F.lit(FAIL)).alias("result"),
                 F.format_string("%.1f%%", F.avg(F.col("success").cast("int")) * 100).alias("success_rate"),
                 F.sum("failures").cast("bigint").alias("exceptions"))
            .orderBy("dataset_order")
            .select("dataset", "result", "success_rate", "exceptions"))


def detail(results: DataFrame) -> DataFrame:
    """Q11: per rule, readable rule name, VALID/INVALID, column, failures, note."""
    readable = F.initcap(F.replace(F.replace(F.col("rule"), F.lit("expect_"), F.lit("")),
                                   F.lit("_"), F.lit(" ")))
    return (results.select(
        "dataset", "dataset_order", "rule_order",
        readable.alias("expectation_rule"),
        F.when(F.col("success"), F.lit(VALID)).otherwise(F.lit(INVALID)).alias("status"),
        F.coalesce(F.col("column_name"), F.lit(TABLE_LEVEL)).alias("column_logic"),
        F.col("failures"),
        F.coalesce(F.col("note"), F.lit(DEFAULT_NOTE)).alias("business_impact"))
        .orderBy("dataset_order", "rule_order"))


class QualityGateError(RuntimeError):
    pass


def check_gate(results: DataFrame, fail_on: Iterable[str] = ()) -> None:
    """Opt-in gate: raise if a listed dataset has a failing rule."""
    names = list(fail_on)
    if not names:
        return
    failing = (results.where(F.col("dataset").isin(names) & ~F.col("success"))
               .select("dataset").distinct().collect())
    if failing:
        raise QualityGateError("quality gate failed for: " + ", ".join(sorted(r[0] for r in failing)))


def render_report(summary_rows, detail_rows, when: datetime | None = None) -> str:
    """Markdown health report from the collected summary and detail rows
    (one row per rule: a few dozen rows at most)."""
    when = when or datetime.now()
    lines = [REPORT_TITLE, f"Report Timestamp: {when.strftime('%Y-%m-%d %H:%M:%S')}", "",
             SUMMARY_HEADING, *SUMMARY_HEADER]
    for r in summary_rows:
        lines.append(f"| {r['dataset']} | {r['result']} | {r['success_rate']} | {r['exceptions']} |")
    lines += ["", DETAIL_HEADING]
    current = None
    for r in detail_rows:
        if r["dataset"] != current:
            current = r["dataset"]
            lines += ["", f"### {current}", *DETAIL_HEADER]
        lines.append(f"| {r['expectation_rule']} | {r['status']} | {r['column_logic']} | "
                     f"{r['failures']} | {r['business_impact']} |")
    return "\n".join(lines) + "\n"
