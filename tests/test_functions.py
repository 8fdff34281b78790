"""Edge tables for the semantic traps (FIXTURES.md section 3)."""

import datetime as dt

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from mercato.functions import (
    iso_weekday,
    money_mean,
    money_sum,
    month_start,
    n_unique,
    parse_datetime,
    parse_datetime_inferred,
    ratio_pct,
    strip_ws,
    sum0,
    whole_days,
)
from mercato.operators import join_on_columns, join_suffixed, keep_one_per_key
from mercato.plans import gold


def ts(s):
    return dt.datetime.fromisoformat(s)


def test_whole_days_truncate_toward_zero(spark):  # T1
    base = ts("2018-01-10 00:00:00")
    rows = [(1, base + dt.timedelta(hours=23)), (2, base - dt.timedelta(hours=23)),
            (3, base + dt.timedelta(hours=25)), (4, base - dt.timedelta(hours=49)), (5, None)]
    df = spark.createDataFrame([(i, d, base) for i, d in rows],
                               "id int, delivered timestamp_ntz, estimated timestamp_ntz")
    got = {r.id: r.d for r in df.select("id", whole_days("estimated", "delivered").alias("d")).collect()}
    assert got == {1: 0, 2: 0, 3: 1, 4: -2, 5: None}
    orders = df.select(F.lit(7).alias("customer_id"),
                       F.col("delivered").alias("order_delivered_customer_date"),
                       F.col("estimated").alias("order_estimated_delivery_date"))
    rep = gold.delivery_reliability({"orders": orders}).collect()[0]
    assert rep.total_orders == 4 and rep.total_late_orders == 1
    assert rep.avg_delay_days == (0 + 0 + 1 - 2) / 4
    assert rep.late_rate_pct == 25.0


def test_desc_sort_puts_nulls_first(spark):  # T2
    df = spark.createDataFrame([(3,), (None,), (5,)], "m int")
    assert [r.m for r in df.orderBy(F.col("m").desc_nulls_first()).collect()] == [None, 5, 3]


def test_n_unique_counts_null_once(spark):  # T3
    df = spark.createDataFrame([("a", None), ("a", 2), ("a", 2), ("b", 3)], "g string, x int")
    got = {r.g: r.n for r in df.groupBy("g").agg(n_unique("x").alias("n")).collect()}
    assert got == {"a": 2, "b": 1}


def test_keep_one_per_key(spark):  # T4
    df = spark.createDataFrame(
        [(1, "k1", "x"), (2, "k1", "y"), (3, "k2", "z"), (4, "k2", "w"), (5, None, "n1"), (6, None, "n2")],
        "id int, key string, v string")
    got = sorted(keep_one_per_key(df, "key", ["id"]).collect(), key=lambda r: r.id)
    assert [(r.id, r.key, r.v) for r in got] == [(1, "k1", "x"), (3, "k2", "z"), (5, None, "n1")]
    assert keep_one_per_key(df, "key").columns == df.columns
    # Without order columns the kept row is the smallest by the remaining
    # columns, in column order (id first here).
    default = {r.key: (r.id, r.v) for r in keep_one_per_key(df, "key").collect()}
    assert default == {"k1": (1, "x"), "k2": (3, "z"), None: (5, "n1")}
    by_v = {r.key: r.v for r in keep_one_per_key(df.select("key", "v", "id"), "key").collect()}
    assert by_v == {"k1": "x", "k2": "w", None: "n1"}


def test_keep_one_per_key_hot_key(spark):
    # One key holds most rows; the result is still one row per key.
    rows = [(i, "hot" if i % 3 else f"k{i}") for i in range(3000)]
    df = spark.createDataFrame(rows, "id int, key string").repartition(8)
    out = keep_one_per_key(df, "key", ["id"])
    assert out.count() == df.select("key").distinct().count()
    assert out.where("key = 'hot'").collect()[0].id == 1


def test_parse_order_dates(spark):  # T5
    df = spark.createDataFrame([(" 2018-01-01 10:00:00\n",), ("",), (" ",), ("bad",), (None,)], "s string")
    out = df.select(parse_datetime(F.nullif(strip_ws("s"), F.lit(""))).alias("t"))
    assert out.schema["t"].dataType == T.TimestampNTZType()
    assert [r.t for r in out.collect()] == [ts("2018-01-01 10:00:00"), None, None, None, None]


def test_parse_rejects_impossible_dates(spark):
    df = spark.createDataFrame([("2018-02-30 10:00:00",), ("2018-13-01 00:00:00",), ("2018-02-28 23:59:59",)],
                               "s string")
    assert [r.t for r in df.select(parse_datetime("s").alias("t")).collect()] == [
        None, None, ts("2018-02-28 23:59:59")]


def test_parse_inferred(spark):  # T6
    df = spark.createDataFrame([("2018-01-01",), ("2018",), (None,), ("2018-01-01 12:00:00",)], "s string")
    assert [r.t for r in df.select(parse_datetime_inferred("s").alias("t")).collect()] == [
        ts("2018-01-01 00:00:00"), None, None, ts("2018-01-01 12:00:00")]


def test_month_start(spark):  # T8
    df = spark.createDataFrame([(ts("2018-03-31 23:59:59"),)], "t timestamp_ntz")
    out = df.select(month_start("t").alias("m"))
    assert out.schema["m"].dataType == T.TimestampNTZType()
    assert out.collect()[0].m == ts("2018-03-01 00:00:00")


def test_iso_weekday(spark):  # T10
    df = spark.createDataFrame([(ts("2026-12-07 08:00:00"),), (ts("2026-12-06 08:00:00"),)], "t timestamp_ntz")
    assert [r.w for r in df.select(iso_weekday("t").alias("w")).collect()] == [1, 7]


def test_zero_leads_rate_is_null(spark):  # T12
    leads = spark.createDataFrame([(None, ts("2018-01-01 00:00:00"), "web")],
                                  "mql_id string, first_contact_date timestamp_ntz, origin string")
    deals = spark.createDataFrame([], "mql_id string, won_date timestamp_ntz")
    r = gold.marketing_performance({"marketing_leads": leads, "closed_deals": deals}).collect()[0]
    assert r.total_leads == 0 and r.converted_deals == 0 and r.conversion_rate_pct is None


def test_clashing_columns_get_suffix(spark):  # T13
    left = spark.createDataFrame([(1, "l")], "k int, x string")
    right = spark.createDataFrame([(1, "r")], "k int, x string")
    out = join_suffixed(left, right, "k")
    assert out.columns == ["k", "x", "x_right"]
    assert out.collect()[0].x_right == "r"
    other = spark.createDataFrame([(1, "r")], "kk int, x string")
    out2 = join_on_columns(left, other, "k", "kk")
    assert out2.columns == ["k", "x", "x_right"]


def test_all_null_sum_is_zero(spark):  # T14
    df = spark.createDataFrame([("a", None), ("a", None)], "g string, price double")
    r = df.groupBy("g").agg(money_sum("price").alias("s"), sum0("price").alias("s0"),
                            money_mean("price").alias("m")).collect()[0]
    assert r.s == 0.0 and r.s0 == 0 and r.m is None


def test_money_sum_is_exact(spark):  # T9
    vals = [(0.1,), (0.2,), (0.3,)] * 1000
    df = spark.createDataFrame(vals, "p double").repartition(7)
    r = df.agg(money_sum("p").alias("s"), money_mean("p").alias("m")).collect()[0]
    assert r.s == 600.0
    assert r.m == 600.0 / 3000


def test_ratio_pct(spark):
    df = spark.createDataFrame([(1, 4), (1, 0)], "a bigint, b bigint")
    assert [r.p for r in df.select(ratio_pct("a", "b").alias("p")).collect()] == [25.0, None]


def test_shuffle_sizing(spark, tmp_path):
    from mercato import session

    base = int(spark.conf.get("spark.sql.shuffle.partitions"))
    assert session.partitions_for(spark, 1000) == base
    # 100 TiB of Parquet: 4 x 100 TiB decoded at 128 MiB each, not clipped.
    assert session.partitions_for(spark, 100 * 1024 ** 4) == 4 * 8192 * 100
    for count in (320, 77):  # two jobs of one session each get their own
        with session.initial_partitions(spark, count):
            assert spark.conf.get(session.INITIAL_PARTITIONS) == str(count)
        assert spark.conf.get(session.INITIAL_PARTITIONS, None) in (None, "")
    spark.conf.set(session.INITIAL_PARTITIONS, "9")
    try:
        with session.initial_partitions(spark, 5):
            pass
        assert spark.conf.get(session.INITIAL_PARTITIONS) == "9"
    finally:
        spark.conf.unset(session.INITIAL_PARTITIONS)
    for name in ("a", "b"):
        spark.range(10).write.parquet(str(tmp_path / name))
    sizes = session.table_bytes(spark, {name: str(tmp_path / name) for name in ("a", "b")})
    assert set(sizes) == {"a", "b"} and min(sizes.values()) > 0


def test_scratch_needs_a_shared_folder_on_a_cluster(spark, tmp_path):
    from types import SimpleNamespace

    from mercato import session

    def cluster(warehouse, **conf):
        held = {"spark.sql.warehouse.dir": warehouse, **conf}
        return SimpleNamespace(conf=SimpleNamespace(get=lambda key, default=None: held.get(key, default)),
                               sparkContext=SimpleNamespace(master="spark://host:7077"))

    with pytest.raises(RuntimeError, match="checkpoint"):
        session.scratch_dir(cluster("file:/home/x/spark-warehouse"), "a")
    assert session.scratch_dir(cluster("hdfs://n/warehouse"), "a") == "hdfs://n/warehouse/_scratch/a"
    assert session.scratch_dir(cluster("file:/x", **{"spark.checkpoint.dir": "/shared/"}), "a") == "/shared/a"


def test_left_join_split_nulls(spark):
    from mercato.operators import left_join_split_nulls

    left = spark.createDataFrame([(1, "a"), (None, "b"), (2, "c"), (3, "d")], "k int, x string")
    right = spark.createDataFrame([(1, "r1"), (1, "r1b"), (3, "r3"), (None, "rn")], "k int, y string")
    def key(r):
        return tuple((v is None, v if v is not None else 0) for v in r)

    got = sorted((tuple(r) for r in left_join_split_nulls(left, right, "k").collect()), key=key)
    want = sorted((tuple(r) for r in join_suffixed(left, right, "k", "left").collect()), key=key)
    assert got == want and len(got) == 5
    assert left_join_split_nulls(left, right, "k").columns == ["k", "x", "y"]


NAN, INF = float("nan"), float("inf")


@pytest.mark.parametrize("values, total", [
    ([1.25, NAN, 2.5], NAN), ([1.25, INF], INF), ([1e18, 1.25], 1e18 + 1.25), ([1e300, 2.5], 1e300),
    ([0.004, 0.004, 0.005], 0.013), ([0.004, NAN, 1e18], NAN), ([0.1, 0.2, None], 0.3), ([None], 0.0),
    ([9e16, 9e16], 1.8e17)])
def test_money_loses_no_value(spark, values, total):  # T9
    from mercato.functions import money_mean_of, money_merged, money_parts, money_total

    df = spark.createDataFrame([(v, i % 2) for i, v in enumerate(values)], "p double, k int")
    n = sum(v is not None for v in values)
    r = df.agg(money_sum("p").alias("s"), money_mean("p").alias("m")).collect()[0]
    parts = df.groupBy("k").agg(*money_parts("p", "p"))
    by_part = parts.agg(money_total("p").alias("s"), money_mean_of("p").alias("m")).collect()[0]
    doubled = parts.groupBy().agg(*money_merged("p", F.lit(2))).agg(money_total("p").alias("s")).collect()[0]
    for got in (r.s, by_part.s, doubled.s / 2):
        assert got == pytest.approx(total, rel=1e-12, nan_ok=True)
    for got in (r.m, by_part.m):
        assert got is None if not n else got == pytest.approx(total / n, rel=1e-12, nan_ok=True)


def test_inferred_layouts(spark):
    texts = ["2018-01-01T10:00:00", "2018/01/01", "2018-01-01 10:00:00.123", "2018-01-01 10:00", "2018/02/03 04:05:06",
             "2018/01-01", "2018", "2018-1-1", "2018-13-01", "x"]
    df = spark.createDataFrame([(t,) for t in texts], "s string")
    got = [r.t for r in df.select(parse_datetime_inferred("s").alias("t")).collect()]
    assert got == [ts("2018-01-01 10:00:00"), ts("2018-01-01 00:00:00"), ts("2018-01-01 10:00:00.123"),
                   ts("2018-01-01 10:00:00"), ts("2018-02-03 04:05:06"), None, None, None, None, None]
