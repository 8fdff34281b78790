"""Report-level facts on small literal tables."""

import datetime as dt

import pytest

from mercato.plans import gold, silver
from mercato.sources import parquet


def test_review_fanout_repeats_revenue(spark):  # F5
    items = spark.createDataFrame([(1, 10, 7, 10.0, 2.0)],
                                  "order_id int, product_id int, seller_id int, price double, freight_value double")
    products = spark.createDataFrame([(10, "toys", "toys_en")],
                                     "product_id int, product_category_name string, product_category_name_english string")
    reviews = spark.createDataFrame([(100, 1, 1.0), (101, 1, 4.0)], "review_id int, order_id int, review_score double")
    r = gold.category_performance({"order_items": items, "products": products, "order_reviews": reviews}).collect()[0]
    assert (r.total_revenue, r.order_count, r.average_review_score, r.product_count) == (20.0, 1, 2.5, 1)


def test_seller_rows_not_orders(spark):  # F8
    items = spark.createDataFrame([(1, 10, 7, 1.0), (1, 11, 7, 2.0), (1, 10, 7, 3.0)],
                                  "order_id int, product_id int, seller_id int, price double")
    r = gold.seller_rankings({"order_items": items}).collect()[0]
    assert (r.total_orders_handled, r.unique_products_offered, r.total_sales_value) == (3, 2, 6.0)


def test_empty_report_is_written_then_raises(spark, tmp_path):  # F9
    items = spark.createDataFrame([], "order_id int, product_id int, seller_id int, price double")
    with pytest.raises(parquet.EmptyReportError):
        parquet.write_gold(gold.seller_rankings({"order_items": items}), str(tmp_path), "seller_rankings")
    assert parquet.try_read(spark, parquet.gold_path(str(tmp_path), "seller_rankings")).count() == 0


def test_orders_flags_and_open_columns(spark):  # C2, F6
    df = spark.createDataFrame(
        [(1, "delivered", "2018-01-01 10:00:00", " ", "x"), (2, "canceled", "bad", "", "y"),
         (3, None, None, None, "z")],
        "order_id int, order_status string, order_purchase_timestamp string, "
        "order_delivered_customer_date string, note string")
    out = {r.order_id: r for r in silver.clean_orders(df).collect()}
    assert out[1].is_completed_transaction and not out[1].is_failed
    assert out[2].is_failed and not out[2].is_completed_transaction
    assert out[3].is_failed is None
    assert out[1].order_purchase_timestamp == dt.datetime(2018, 1, 1, 10)
    assert out[2].order_purchase_timestamp is None and out[1].order_delivered_customer_date is None
    assert out[1].note == "x"  # unnamed columns pass through


def test_items_join_is_not_semi(spark):  # C3
    items = spark.createDataFrame([(1, 5.0), (2, 0.0), (3, 1.0)], "order_id int, price double")
    orders = spark.createDataFrame([(1,), (1,), (2,)], "order_id int")
    out = silver.clean_order_items(items, orders)
    assert sorted(r.order_id for r in out.collect()) == [1, 1]


def test_products_weight_range_and_fallback(spark):  # C4, F7
    products = spark.createDataFrame(
        [(1, "a", 1.0), (2, "b", 50000.0), (3, "a", 0.5), (4, None, 10.0), (5, "c", None), (6, "b", 50001.0)],
        "product_id int, product_category_name string, product_weight_g double")
    trans = spark.createDataFrame([("a", "A")], "product_category_name string, product_category_name_english string")
    out = {r.product_id: r.product_category_name_english
           for r in silver.clean_products(products, trans).collect()}
    assert out == {1: "A", 2: "b"}


def test_reviews_median_fill(spark):  # C9
    df = spark.createDataFrame([(1, 1, 1, "2018-01-01", ""), (2, 1, 4, "x", None), (3, 2, None, None, None),
                                (4, 2, 5, None, None)],
                               "review_id int, order_id int, review_score bigint, review_creation_date string, "
                               "review_answer_timestamp string")
    out = {r.review_id: r for r in silver.clean_order_reviews(df).collect()}
    assert out[3].review_score == 4.0 and out[1].review_score == 1.0
    assert out[1].review_creation_date == dt.datetime(2018, 1, 1) and out[2].review_creation_date is None


def test_payments_and_sellers(spark):  # C7, C8
    pay = spark.createDataFrame([(1, "Boleto", 10.0), (2, "X", 0.0), (3, "Y", -1.0)],
                                "order_id int, payment_type string, payment_value double")
    assert [(r.order_id, r.payment_type) for r in silver.clean_order_payments(pay).collect()] == [(1, "boleto")]
    sellers = spark.createDataFrame([(1, "\tsao paulo ", " sp\n")], "seller_id int, seller_city string, seller_state string")
    r = silver.clean_sellers(sellers).collect()[0]
    assert (r.seller_city, r.seller_state) == ("SAO PAULO", "SP")


def test_geo_explode_outer(spark):  # G12
    doc = spark.createDataFrame(
        [([{"id": "SP", "properties": {"name": "Sao Paulo"}}, {"id": "RJ", "properties": {"name": "Rio"}}],),
         ([],)],
        "features array<struct<id string, properties struct<name string>>>")
    rows = sorted(gold.geolocation_lookup({"geo": doc}).collect(), key=lambda r: (r.state_id or ""))
    assert [(r.state_id, r.state_name) for r in rows] == [(None, None), ("RJ", "Rio"), ("SP", "Sao Paulo")]


def test_reviews_median_of_even_count_interpolates(spark):  # C9
    df = spark.createDataFrame([(1, 1, 1), (2, 1, 2), (3, 2, 3), (4, 2, 4), (5, 3, None)],
                               "review_id int, order_id int, review_score bigint")
    df = df.selectExpr("*", "CAST(NULL AS STRING) AS review_creation_date",
                       "CAST(NULL AS STRING) AS review_answer_timestamp")
    out = {r.review_id: r.review_score for r in silver.clean_order_reviews(df).collect()}
    assert out == {1: 1.0, 2: 2.0, 3: 3.0, 4: 4.0, 5: 2.5}


def test_audit_findings(spark, tmp_path):  # V4-V6, F10, F11
    from mercato.plans import verify

    gold_dir = str(tmp_path / "gold")
    spark.range(3).write.parquet(parquet.gold_path(gold_dir, "seller_rankings"))
    spark.range(0).write.parquet(parquet.gold_path(gold_dir, "sales_trends"))
    found = {(f[1], f[3]): f for f in verify.verify_gold(spark, gold_dir)}
    assert found[("seller_rankings", "OK")][5] == 3
    assert found[("sales_trends", "WARN")][5] == 0
    assert ("geolocation_lookup", "MISSING") in found  # all fifteen are checked
    passed, findings = verify.run_verification(spark, str(tmp_path / "silver"), gold_dir)
    assert not passed and findings.where("severity = 'MISSING'").count() == 9 + 13


def test_item_partitions_grow_with_the_input(spark, tmp_path):
    """Adaptive execution merges partitions by their compressed size, whatever
    the reports build on them; large tables get a count in proportion."""
    from mercato import session

    assert session.shared_partitions(spark, 1 << 20) is None
    few, many = (session.shared_partitions(spark, gb << 30) for gb in (1, 6))
    assert many == 6 * few and (6 << 30) / many <= session.SHARED_PARTITION_BYTES
    spark.range(10).write.parquet(f"{tmp_path}/t")
    files = [f for f in (tmp_path / "t").iterdir() if f.name.startswith("part-")]
    assert session.input_bytes(spark, [f"{tmp_path}/t"]) == sum(f.stat().st_size for f in files)
    assert session.input_bytes(spark, [str(f) for f in files]) == sum(f.stat().st_size for f in files)


def test_reports_go_on_in_the_partitions_of_the_items(spark):
    items = spark.createDataFrame([(i % 40 or None, i % 7, 1, float(i % 5), 1.0) for i in range(300)],
                                  "order_id int, product_id int, seller_id int, price double, freight_value double")
    orders = spark.createDataFrame([(i, i % 9 or None) for i in [*range(35), 3, 3]], "order_id int, customer_id int")
    customers = spark.createDataFrame([(i, f"S{i % 3}") for i in range(7)], "customer_id int, customer_state string")
    reviews = spark.createDataFrame([(i, i % 30, float(i % 6)) for i in range(90)],
                                    "review_id int, order_id int, review_score double")
    products = spark.createDataFrame([(i, f"en_{i % 2}") for i in range(6)],
                                     "product_id int, product_category_name_english string")
    rest = {"orders": orders, "customers": customers, "order_reviews": reviews, "products": products}
    for report in (gold.state_performance, gold.product_reviews):
        plain = report({**rest, "order_items": silver.clean_order_items(items, orders)})
        dealt = report({**rest, "order_items": silver.clean_order_items(items, orders, 16)})
        assert sorted(map(str, dealt.collect())) == sorted(map(str, plain.collect()))
        plan = dealt._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[-1]
        assert plan.count("16), REPARTITION_BY_NUM") == 2


def test_items_move_once_and_without_sums(spark):
    """Pairs of seller and product, and items by order, are not moved with
    partial sums, nor a second time to meet their order's reviews."""
    items = spark.createDataFrame([(1, 2, 3, 4.0), (1, 2, 3, 5.0), (1, None, 3, None), (2, 2, None, 1.5), (None, 7, None, 2.0)],
                                  "order_id int, product_id int, seller_id int, price double")
    reviews = spark.createDataFrame([(i, i % 3, float(i % 5)) for i in range(9)],
                                    "review_id int, order_id int, review_score double")
    products = spark.createDataFrame([(2, "a"), (7, "b")], "product_id int, product_category_name_english string")
    t = {"order_items": items, "order_reviews": reviews, "products": products}
    sellers = gold.seller_rankings(t)
    assert {tuple(r) for r in sellers.collect()} == {(3, 9.0, 2, 3), (None, 3.5, 2, 1)}
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        by_seller = gold.seller_rankings(t)._jdf.queryExecution().executedPlan().toString()
        by_category = gold.category_performance(t)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
    for line in by_seller.splitlines():
        assert not ("product_id" in line and "sum(" in line), line
    exchanges = [line for line in by_category.splitlines() if "hashpartitioning(product_category_name_english" in line]
    assert not [line for line in exchanges if "order_id" in line]
