"""Expectation rules, guards and the health report format."""

import pytest

from mercato.operators import expectations as ex
from mercato.plans import quality


def _one(df):
    rows = df.collect()
    assert len(rows) == 1
    return rows[0]


def test_unique_rule_counts_every_repeated_row(spark):
    df = spark.createDataFrame([("a",), ("a",), ("b",), (None,), (None,)], "v string")
    r = _one(ex.validate(df, "T", [ex.unique("v")]))
    assert r.failures == 2 and r.success is False


def test_between_rule_skips_nulls(spark):
    df = spark.createDataFrame([(0.05,), (0.1,), (None,)], "v double")
    r = _one(ex.validate(df, "T", [ex.between("v", 0.1, None)]))
    assert r.failures == 1 and not r.success


def test_length_rule(spark):
    df = spark.createDataFrame([("SP",), ("SPX",), (None,)], "v string")
    r = _one(ex.validate(df, "T", [ex.length_between("v", 2, 2)]))
    assert r.failures == 1


def test_set_rule(spark):
    df = spark.createDataFrame([("delivered",), ("lost",), (None,)], "v string")
    r = _one(ex.validate(df, "T", [ex.in_set("v", quality.VALID_STATUSES)]))
    assert r.failures == 1


def test_not_null_and_row_count(spark):
    df = spark.createDataFrame([("a",), (None,)], "v string")
    rows = ex.validate(df, "T", [ex.not_null("v"), ex.row_count_between(1, 1)]).orderBy("rule_order").collect()
    assert (rows[0].failures, rows[0].success) == (1, False)
    assert (rows[1].failures, rows[1].success) == (0, False)


def test_orphans_include_null_keys(spark):  # T7, Q8
    items = spark.createDataFrame([(1,), (9,), (None,)], "order_id int")
    orders = spark.createDataFrame([(1,), (2,)], "order_id int")
    r = _one(quality.guard_relational_integrity(items, orders))
    assert r.failures == 2 and r.success is False
    assert r.column_name is None


def test_no_orphans_pass(spark):
    items = spark.createDataFrame([(1,), (2,)], "order_id int")
    orders = spark.createDataFrame([(1,), (2,)], "order_id int")
    r = _one(quality.guard_relational_integrity(items, orders))
    assert r.failures == 0 and r.success


def test_guard_products_counts_and_notes(spark):
    products = spark.createDataFrame(
        [(None, 0.05, 1.0, 1.0, 1.0), ("toys", 5.0, 1.0, 1.0, 1.0), (None, 200.0, 1.0, 1.0, 1.0)],
        "product_category_name string, product_weight_g double, product_length_cm double, "
        "product_height_cm double, product_width_cm double")
    rows = quality.guard_products(products).orderBy("rule_order").collect()
    assert [r.failures for r in rows] == [2, 1, 0, 0, 0]
    assert rows[0].note == quality.NOTE_CATEGORY and rows[1].note == quality.NOTE_DIMENSION
    assert all(r.dataset == "Product" for r in rows)


def _published_results(spark):
    """Rule results with the counts of the published run: only two product
    rules fail, with 610 and 4 failures."""
    spec = [
        ("Orders", 0, [("expect_column_values_to_not_be_null", "order_id", 0, None),
                       ("expect_column_values_to_be_unique", "order_id", 0, None),
                       ("expect_column_values_to_be_in_set", "order_status", 0, None)]),
        ("Customer", 1, [("expect_column_values_to_not_be_null", "customer_id", 0, None),
                         ("expect_column_values_to_be_unique", "customer_id", 0, None),
                         ("expect_column_value_lengths_to_be_between", "customer_state", 0, None)]),
        ("Payments", 2, [("expect_column_values_to_not_be_null", "payment_value", 0, None),
                         ("expect_column_values_to_be_between", "payment_value", 0, None)]),
        ("Product", 3, [("expect_column_values_to_not_be_null", "product_category_name", 610, None),
                        ("expect_column_values_to_be_between", "product_weight_g", 4, None),
                        ("expect_column_values_to_be_between", "product_length_cm", 0, None),
                        ("expect_column_values_to_be_between", "product_height_cm", 0, None),
                        ("expect_column_values_to_be_between", "product_width_cm", 0, None)]),
        ("Relational", 4, [("expect_table_row_count_to_be_between", None, 0, None)]),
    ]
    rows = [(ds, o, i, rule, col, fails == 0, fails, note)
            for ds, o, rules in spec for i, (rule, col, fails, note) in enumerate(rules)]
    return spark.createDataFrame(rows, ex.RESULT_SCHEMA)


def test_published_report_format(spark):  # Q10, Q11
    res = _published_results(spark)
    summary = [(r.dataset, r.result, r.success_rate, r.exceptions) for r in quality.summary(res).collect()]
    assert summary == [("Orders", "PASS", "100.0%", 0), ("Customer", "PASS", "100.0%", 0),
                       ("Payments", "PASS", "100.0%", 0), ("Product", "FAIL", "60.0%", 614),
                       ("Relational", "PASS", "100.0%", 0)]
    detail = quality.detail(res).collect()
    text = quality.render_report(quality.summary(res).collect(), detail)
    assert "| Product | FAIL | 60.0% | 614 |" in text
    assert "| Column Values To Not Be Null | INVALID | product_category_name | 610 | Standard validation check. |" in text
    assert "| Column Values To Be Between | INVALID | product_weight_g | 4 | Standard validation check. |" in text
    assert "| Table Row Count To Be Between | VALID | Table-Level | 0 | Standard validation check. |" in text
    assert "| Column Value Lengths To Be Between | VALID | customer_state | 0 | Standard validation check. |" in text


def test_gate_is_opt_in(spark):  # F2
    res = _published_results(spark)
    quality.check_gate(res)  # default: results only, no exception
    quality.check_gate(res, ["Orders"])
    with pytest.raises(quality.QualityGateError):
        quality.check_gate(res, ["Product"])


def test_datasets():
    assert list(quality.DATASETS) == [
        "Orders", "Customer", "Payments", "Product", "Relational"]
