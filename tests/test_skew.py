"""Reports under heavy key skew, with sort-merge joins and AQE skew splitting
forced on, against a brute force in plain Python."""

import random
from collections import defaultdict
from decimal import Decimal

import pytest

from mercato.plans import gold

FORCED = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "1024",
}


@pytest.fixture
def skew_conf(spark):
    old = {k: spark.conf.get(k, None) for k in FORCED}
    for k, v in FORCED.items():
        spark.conf.set(k, v)
    yield
    for k, v in old.items():
        if v is None:
            spark.conf.unset(k)
        else:
            spark.conf.set(k, v)


def _tables(spark):
    rnd = random.Random(11)
    customers = [(c, f"S{c % 4}") for c in range(60)]
    # Customer 0 places a third of all orders; some orders name no customer.
    orders = [(o, 0 if o % 3 == 0 else (None if o % 17 == 0 else rnd.randrange(1, 80))) for o in range(600)]
    sellers = [(s, f"T{s % 3}") for s in range(10)]
    # Seller 0 handles a third of all items; some items have no order.
    items = [(rnd.randrange(0, 650) if i % 29 else None, rnd.randrange(0, 40), 0 if i % 3 == 0 else rnd.randrange(1, 12),
              round(rnd.uniform(1, 300), 2), round(rnd.uniform(0, 30), 2)) for i in range(3000)]
    t = {
        "customers": spark.createDataFrame(customers, "customer_id int, customer_state string").repartition(4),
        "orders": spark.createDataFrame(orders, "order_id int, customer_id int").repartition(4),
        "sellers": spark.createDataFrame(sellers, "seller_id int, seller_state string"),
        "order_items": spark.createDataFrame(
            items, "order_id int, product_id int, seller_id int, price double, freight_value double").repartition(6),
    }
    return t, customers, orders, sellers, items


def test_state_performance_under_skew(spark, skew_conf):
    t, customers, orders, _, items = _tables(spark)
    df = gold.state_performance(t)
    got = {r.customer_state: (r.total_revenue, r.total_orders, r.avg_freight_cost) for r in df.collect()}
    final_plan = df._jdf.queryExecution().executedPlan().toString()
    assert "skew=true" in final_plan and "BroadcastHashJoin" not in final_plan
    state_of = dict(customers)
    order_rows = defaultdict(list)
    for o, c in orders:
        order_rows[o].append(c)
    acc = defaultdict(lambda: [Decimal(0), set(), Decimal(0), 0])
    for o, _, _, price, freight in items:
        for c in (order_rows.get(o) or [None]):
            a = acc[state_of.get(c) if c is not None else None]
            a[0] += Decimal(str(price))
            a[1].add(o)
            a[2] += Decimal(str(freight))
            a[3] += 1
    want = {k: (float(v[0]), len(v[1]), float(v[2]) / v[3]) for k, v in acc.items()}
    assert set(got) == set(want)
    for k in want:
        assert got[k][0] == pytest.approx(want[k][0], abs=1e-6)
        assert got[k][1] == want[k][1]
        assert got[k][2] == pytest.approx(want[k][2], rel=1e-12)


def test_logistics_flow_under_skew(spark, skew_conf):
    t, customers, orders, sellers, items = _tables(spark)
    got = {(r.origin, r.destination): r.order_count for r in gold.logistics_flow(t).collect()}
    state_of, seller_state = dict(customers), dict(sellers)
    want = defaultdict(int)
    for o, _, s, _, _ in items:
        if o is None or s not in seller_state:
            continue
        for oo, c in orders:
            if oo == o and c in state_of:
                want[(seller_state[s], state_of[c])] += 1
    assert got == dict(want)


def test_seller_rankings_under_skew(spark, skew_conf):
    t, _, _, _, items = _tables(spark)
    got = {r.seller_id: (r.total_orders_handled, r.unique_products_offered)
           for r in gold.seller_rankings(t).collect()}
    want = defaultdict(lambda: [0, set()])
    for o, p, s, _, _ in items:
        want[s][0] += o is not None
        want[s][1].add(p)
    assert got == {k: (v[0], len(v[1])) for k, v in want.items()}


def _hot_order(spark):
    rnd = random.Random(5)
    # Order 0 holds a third of all items and of all reviews.
    items = [(0 if i % 3 == 0 else rnd.randrange(1, 300), rnd.randrange(0, 40), round(rnd.uniform(1, 300), 2))
             for i in range(3000)]
    reviews = [(i, 0 if i % 3 == 0 else rnd.randrange(1, 300), float(rnd.randrange(1, 6)) if i % 7 else None)
               for i in range(300)]
    products = [(p, f"c{p % 5}") for p in range(38)]
    return items, reviews, products, {
        "order_items": spark.createDataFrame(items, "order_id int, product_id int, price double").repartition(6),
        "order_reviews": spark.createDataFrame(
            reviews, "review_id int, order_id int, review_score double").repartition(4),
        "products": spark.createDataFrame(products, "product_id int, product_category_name_english string")}


@pytest.mark.parametrize("report", ["category_performance", "product_reviews"])
def test_review_reports_with_a_hot_order(spark, skew_conf, report):
    items, reviews, products, t = _hot_order(spark)
    # At most one row per product of an order meets the reviews.
    assert gold._order_products(t).groupBy("order_id").count().agg({"count": "max"}).first()[0] <= 40
    got = {r[0]: tuple(r)[1:] for r in gold.REPORTS[report](t).collect()}
    of = defaultdict(list)
    for r, o, s in reviews:
        of[o].append((r, s))
    category = dict(products)
    acc = defaultdict(lambda: [Decimal(0), set(), [], set(), 0])
    for o, p, price in items:
        if p not in category:
            continue
        a = acc[category[p]]
        a[1].add(o)
        a[3].add(p)
        a[0] += Decimal(str(price)) * max(1, len(of[o]))
        a[2] += [s for _, s in of[o] if s is not None]
        a[4] += len(of[o])
    if report == "category_performance":
        want = {k: (float(a[0]), len(a[1]), sum(a[2]) / len(a[2]), len(a[3])) for k, a in acc.items()}
    else:
        want = {k: (sum(a[2]) / len(a[2]), a[4]) for k, a in acc.items() if a[4] > 50}
    assert set(got) == set(want)
    for k in want:
        assert got[k] == pytest.approx(want[k], rel=1e-9)


def test_orphans_with_a_hot_key(spark, skew_conf):
    from mercato.operators import expectations as ex

    keys = [0 if i % 3 == 0 else (None if i % 5 == 0 else i) for i in range(3000)]
    items = spark.createDataFrame([(k,) for k in keys], "order_id int").repartition(6)
    orders = spark.createDataFrame([(k,) for k in range(1, 2000)], "order_id int").repartition(4)
    want = sum(k is None or not 1 <= k < 2000 for k in keys)
    for parents in (None, ex.key_counts(orders, "order_id")):
        df = ex.orphan_rule(items, orders, "order_id", "T", parent_keys=parents)
        assert df.collect()[0].failures == want
        # One row per key meets the join, however hot the key.
        assert ex.key_counts(items, "order_id").count() == len(set(keys))
