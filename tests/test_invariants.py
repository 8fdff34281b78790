"""
brute-force checks of the core operators on random small inputs."""

import datetime as dt
import random
from decimal import Decimal

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from mercato.functions import money_sum, n_unique, whole_days
from mercato.operators import keep_one_per_key
from mercato.plans import gold, registry

SF = "/root/testdata/sf0.001"


def test_silver_row_count_invariants(spark):
    b = registry.bronze_for(spark, SF)
    s = registry.silver_for(spark, SF)
    # Kept whole: orders, sellers, reviews.
    for t in ("orders", "sellers", "order_reviews"):
        assert s[t].count() == b[t].count()
    # One row per key (null counts as a key).
    assert s["customers"].count() == b["customers"].select("customer_unique_id").distinct().count()
    for t in ("marketing_leads", "closed_deals"):
        assert s[t].count() == b[t].select("mql_id").distinct().count()
    # Payments: exactly the positive ones.
    assert s["order_payments"].count() == b["order_payments"].where("payment_value > 0").count()


def test_revenue_is_conserved(spark):
    s = registry.silver_for(spark, SF)
    orders_unique = s["orders"].count() == s["orders"].select("order_id").distinct().count()
    customers_unique = s["customers"].count() == s["customers"].select("customer_id").distinct().count()
    assert orders_unique and customers_unique
    total = gold.state_performance(s).agg(F.sum("total_revenue")).collect()[0][0]
    items = s["order_items"].agg(money_sum("price")).collect()[0][0]
    assert round(total, 2) == round(items, 2)
    flows = gold.logistics_flow(s).agg(F.sum("order_count")).collect()[0][0]
    assert flows <= s["order_items"].count()


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.sampled_from(["a", "b", "c", None]), st.integers(0, 50)), min_size=1, max_size=40))
def test_keep_one_per_key_matches_brute_force(spark, rows):
    rows = [(i, k, v) for i, (k, v) in enumerate(rows)]
    df = spark.createDataFrame(rows, "id int, key string, v int")
    got = {r.key: (r.id, r.v) for r in keep_one_per_key(df, "key", ["v", "id"]).collect()}
    want = {}
    for i, k, v in rows:
        if k not in want or (v, i) < (want[k][1], want[k][0]):
            want[k] = (i, v)
    assert got == want


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.sampled_from(["g1", "g2"]), st.one_of(st.none(), st.integers(0, 5)),
                          st.one_of(st.none(), st.integers(0, 99999).map(lambda c: c / 100))),
                min_size=1, max_size=60))
def test_group_aggregates_match_brute_force(spark, rows):
    df = spark.createDataFrame(rows, "g string, x int, price double").repartition(3)
    got = {r.g: (r.n, r.s) for r in df.groupBy("g").agg(n_unique("x").alias("n"),
                                                         money_sum("price").alias("s")).collect()}
    want = {}
    for g in {r[0] for r in rows}:
        xs = [x for gg, x, _ in rows if gg == g]
        total = sum((Decimal(str(p)) for gg, _, p in rows if gg == g and p is not None), Decimal(0))
        want[g] = (len(set(xs)), float(total))
    assert got == want


def test_whole_days_matches_python(spark):
    rnd = random.Random(7)
    base = dt.datetime(2018, 6, 1)
    rows = [(base + dt.timedelta(seconds=rnd.randint(-10**7, 10**7)),
             base + dt.timedelta(seconds=rnd.randint(-10**7, 10**7))) for _ in range(300)]
    df = spark.createDataFrame(rows, "a timestamp_ntz, b timestamp_ntz")
    got = [r.d for r in df.select(whole_days("a", "b").alias("d")).collect()]
    want = [int((b - a).total_seconds() / 86400) for a, b in rows]  # truncates toward zero
    assert got == want


def test_parse_datetime_matches_strptime(spark):
    from mercato.functions import parse_datetime

    rnd = random.Random(3)

    def two(lo, hi):
        return f"{rnd.randint(lo, hi):02d}"

    texts = []
    for _ in range(400):
        kind = rnd.random()
        if kind < 0.6:  # right shape, sometimes impossible values
            texts.append(f"{rnd.randint(1990, 2030)}-{two(0, 13)}-{two(0, 32)} {two(0, 25)}:{two(0, 60)}:{two(0, 60)}")
        elif kind < 0.8:
            texts.append(f"{rnd.randint(1990, 2030)}-{two(1, 12)}-{two(1, 28)}")
        else:
            texts.append(rnd.choice(["", "bad", "2018-01-01T10:00:00", "2018/01/01 10:00:00", " 2018-01-01 10:00:00"]))
    df = spark.createDataFrame([(t,) for t in texts], "s string")
    got = [r.t for r in df.select(parse_datetime("s").alias("t")).collect()]

    def want(t):
        if len(t) != 19:
            return None
        try:
            return dt.datetime.strptime(t, "%Y-%m-%d %H:%M:%S")
        except ValueError:
            return None

    assert got == [want(t) for t in texts]


def test_counts_documented_for_the_stand_ins(spark):
    """The sf0.001 counts listed in FIXTURES.md section 2."""
    b = registry.bronze_for(spark, SF)
    s = registry.silver_for(spark, SF)
    c = F.col
    assert (b["customers"].count(), s["customers"].count()) == (150, 135)
    raw_delivered = c("order_delivered_customer_date")
    assert b["orders"].where(raw_delivered == "").count() == 260
    assert b["orders"].where(raw_delivered.isNull()).count() == 491
    assert b["orders"].where(raw_delivered == "not a date").count() == 256
    status = {r[0]: r[1] for r in b["orders"].groupBy("order_status").count().collect()}
    assert status["delivered"] == 493
    assert status.get("canceled", 0) + status.get("unavailable", 0) == 199
    assert sum(status.values()) - 493 - 199 == 808
    items, orders = b["order_items"], b["orders"]
    assert items.join(orders.select("order_id"), "order_id", "left_anti").count() == 67
    assert items.where(c("price") == 0).count() == 17
    products = b["products"]
    assert products.where(c("product_category_name").isNull()).count() == 4
    assert products.where(~c("product_weight_g").between(1, 50000)).count() == 14
    assert products.where(c("product_weight_g") < 0.1).count() == 7
    leads, deals = b["marketing_leads"], b["closed_deals"]
    assert (leads.count(), s["marketing_leads"].count()) == (199, 15)
    assert leads.where(c("origin").isNull()).count() == 42
    assert (deals.count(), s["closed_deals"].count()) == (202, 15)
    assert deals.where(c("won_date") == "not a date").count() == 12
    pay = b["order_payments"]
    assert (pay.count(), pay.where(c("payment_value") == 0).count()) == (1800, 30)
    rev = b["order_reviews"]
    assert rev.where(c("review_score").isNull()).count() == 137
    assert (rev.count(), rev.select("order_id").distinct().count()) == (1667, 1500)
    assert s["order_reviews"].where(c("review_score") == 3.0).count() == (
        rev.where(c("review_score") == 3).count() + 137)  # median 3.0 fills the nulls
    late = gold.delivery_reliability(s).agg(F.sum("total_late_orders")).collect()[0][0]
    after = s["orders"].where(c("order_delivered_customer_date") > c("order_estimated_delivery_date")).count()
    assert (after, late) == (165, 154)  # T1: after the estimate vs late by a whole day
