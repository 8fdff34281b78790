"""Sessions, as-of and interval joins against plain Python."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from mercato.operators import temporal

T0 = dt.datetime(2024, 1, 1)


def at(seconds):
    return None if seconds is None else T0 + dt.timedelta(seconds=seconds)


def events(rng, n, hot=0.35, span=20_000):
    """(user, second, id): one user holds a third, times repeat, some are null."""
    return [(0 if rng.random() < hot else rng.choice([None, *range(1, 9)]),
             None if rng.random() < 0.03 else rng.choice([rng.randrange(span), 100 * rng.randrange(span // 100)]), i)
            for i in range(n)]


def frame(spark, rows, names="user int, ts timestamp_ntz, id int"):
    return spark.createDataFrame([(u, at(s), i) for u, s, i in rows], names).repartition(5)


@pytest.mark.parametrize("gap", [1, 60, 500])
def test_sessions(spark, gap):
    rows = events(random.Random(gap), 700)
    got = temporal.session_windows(frame(spark, rows), "user", "ts", gap,
                                   {"ids": ("id", "sum"), "low": ("id", "min"), "known": ("id", "count")})
    assert got.columns == ["user", "session_start", "session_end", "n_rows", "ids", "low", "known"]
    expected = []
    for user in {r[0] for r in rows}:
        held = []
        for s, i in [*sorted((s, i) for u, s, i in rows if u == user and s is not None), (None, None)]:
            if held and (s is None or s - held[-1][0] >= gap):
                ids = [i for _, i in held]
                expected.append((user, at(held[0][0]), at(held[-1][0]), len(held), sum(ids), min(ids), len(ids)))
                held = []
            held.append((s, i))
    assert sorted(map(tuple, got.collect()), key=str) == sorted(expected, key=str)
    assert temporal.session_windows(frame(spark, rows).limit(0), "user", "ts", gap).count() == 0


def test_sessions_agree_with_session_window(spark):
    rows = [(u, s, i) for u, s, i in events(random.Random(5), 500) if u is not None and s is not None]
    df = frame(spark, rows)
    own = temporal.session_windows(df, "user", "ts", 60).select("user", "session_start", "n_rows")
    native = df.groupBy("user", F.session_window("ts", "60 seconds")).count().select(
        "user", "session_window.start", "count")
    assert sorted(map(tuple, own.collect())) == sorted(map(tuple, native.collect()))


def test_a_hot_key_is_reduced_before_the_window(spark):
    """A key's rows in the window are bounded by time, not by its events."""
    df = spark.range(20_000).select(F.lit(1).alias("user"), F.timestamp_seconds(F.col("id") % 50).alias("ts"), "id")
    plan = temporal.session_windows(df, "user", "ts", 10)
    assert plan.count() == 1
    reduced = plan._jdf.queryExecution().optimizedPlan().toString()
    assert reduced.index("Window") < reduced.rindex("Aggregate")  # the aggregate is below the window
    slots = df.groupBy("user", F.floor(temporal.micros(df, "ts") / 10_000_000)).count()
    assert slots.count() == 5


@pytest.mark.parametrize("strict", [False, True])
@pytest.mark.parametrize("tolerance", [None, 300])
@pytest.mark.parametrize("bucket", [50, 86_400])
def test_asof_join(spark, strict, tolerance, bucket):
    rng = random.Random(17)
    lefts, rights = events(rng, 500), events(rng, 300)
    left = frame(spark, lefts)
    right = frame(spark, rights).withColumnRenamed("id", "seen").withColumn("note", F.concat(F.lit("n"), "seen"))
    got = temporal.asof_join(left, right, "user", "ts", "ts", tie=["seen"], strict=strict,
                             tolerance_seconds=tolerance, bucket_seconds=bucket)
    assert got.columns == ["user", "ts", "id", "ts_right", "seen", "note"]
    expected = []
    for u, s, i in lefts:
        best = max(((t, j) for v, t, j in rights if u is not None and s is not None and v == u and t is not None
                    and (t < s if strict else t <= s)), default=None)
        if best and tolerance is not None and s - best[0] > tolerance:
            best = None
        expected.append((u, at(s), i, *((at(best[0]), best[1], f"n{best[1]}") if best else (None,) * 3)))
    assert sorted(map(tuple, got.collect()), key=str) == sorted(expected, key=str)


def test_asof_join_of_empty_tables(spark):
    left, right = frame(spark, events(random.Random(1), 20)), frame(spark, []).withColumnRenamed("id", "seen")
    got = temporal.asof_join(left, right, "user", "ts", "ts")
    assert got.count() == 20 and got.where("seen is not null or ts_right is not null").count() == 0
    assert temporal.asof_join(left.limit(0), right, "user", "ts", "ts").count() == 0


def test_asof_join_has_no_range_product_and_splits_a_hot_key(spark):
    left = spark.range(3000).select(F.lit(1).alias("user"), F.timestamp_seconds(F.col("id") * 60).alias("ts"), "id")
    right = left.select("user", "ts", F.col("id").alias("seen")).where("seen % 100 = 0")
    got = temporal.asof_join(left, right, "user", "ts", "ts", bucket_seconds=3600)
    assert got.where("seen <> id - id % 100").count() == 0 and got.count() == 3000
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan and "Join" not in plan
    assert "__bucket" in plan[plan.index("Window"):].split("\n")[0]  # cut by key and bucket


def span_rows(rng, n):
    out = []
    for i in range(n):
        start = rng.randrange(20_000)
        length = rng.choice([0, rng.randrange(50), rng.randrange(2000), rng.choice([15_000, -5]), None])
        out.append((0 if rng.random() < 0.35 else rng.choice([None, *range(1, 9)]), start if i % 31 else None,
                    None if length is None else start + length, i))
    return out


@pytest.mark.parametrize("by", [(), ("user",)])
@pytest.mark.parametrize("rare", [0.0, 0.3])
def test_interval_join(spark, by, rare):
    rng = random.Random(23)
    spans, points = span_rows(rng, 150), events(rng, 300)
    left = spark.createDataFrame([(u, at(a), at(b), i) for u, a, b, i in spans],
                                 "user int, opened timestamp_ntz, closed timestamp_ntz, id int").repartition(3)
    got = temporal.interval_join(left, frame(spark, points), "opened", "closed", "ts", by, rare)
    assert got.columns == ["user", "opened", "closed", "id", *([] if by else ["user_right"]), "ts", "id_right"]
    expected = [(u, at(a), at(b), i, *([] if by else [v]), at(s), j) for u, a, b, i in spans for v, s, j in points
                if None not in (a, b, s) and a <= s <= b and (not by or u is not None and u == v)]
    assert sorted(map(tuple, got.collect()), key=str) == sorted(expected, key=str)
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan
    assert temporal.interval_join(left.limit(0), frame(spark, points), "opened", "closed", "ts", by).count() == 0


def test_no_result_depends_on_the_zone(spark):
    """Around a change of clocks of the session's zone."""
    old = spark.conf.get("spark.sql.session.timeZone")
    rows = [(1, dt.datetime(2024, 3, 10, 1, 59), 1), (1, dt.datetime(2024, 3, 10, 2, 30), 2),
            (1, dt.datetime(2024, 3, 10, 3, 1), 3)]
    try:
        for zone in ("UTC", "America/New_York"):
            spark.conf.set("spark.sql.session.timeZone", zone)
            df = spark.createDataFrame(rows, "user int, ts timestamp_ntz, id int")
            assert temporal.session_windows(df, "user", "ts", 31 * 60 + 1).count() == 1
            assert temporal.session_windows(df, "user", "ts", 31 * 60).count() == 3
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)


def test_times_before_1970_and_with_a_zone(spark):
    rows = [(1, dt.datetime(1969, 12, 31, 23, 59, 50), 1), (1, dt.datetime(1970, 1, 1, 0, 0, 5), 2)]
    df = spark.createDataFrame(rows, "user int, ts timestamp_ntz, id int")
    assert temporal.session_windows(df, "user", "ts", 20).count() == 1
    assert temporal.session_windows(df.withColumn("ts", F.col("ts").cast("timestamp")), "user", "ts", 15).count() == 2
    spans = df.select("id", F.col("ts").alias("a"), (F.col("ts") + F.expr("interval 15 seconds")).alias("b"))
    assert sorted(tuple(r) for r in temporal.interval_join(spans, df, "a", "b", "ts").select("id", "id_right").collect()
                  ) == [(1, 1), (1, 2), (2, 2)]


def test_incidents_move_no_pairs(spark, monkeypatch):
    """A brute count, with incidents in several rows, and no exchange above the join."""
    from mercato.plans import activity

    monkeypatch.setattr(temporal, "TASK_COMPARISONS", 500)  # many partitions
    rng = random.Random(5)
    rows = [(rng.choice([None, i % 260]) if i % 9 == 0 else i % 260, T0 + dt.timedelta(seconds=rng.randrange(4000), microseconds=i % 3),
             rng.choice([None, *range(6)]), rng.choice(["error", "view"]), rng.choice([None, -3.0, 0.0, 1.5, 80.0, 900.0]))
            for i in range(300)]
    rows += rows[:20] + [(*r[:4], 40.0) for r in rows[:20]]
    df = spark.createDataFrame(rows, "event_id long, ts timestamp_ntz, user_id long, event_type string, value double")
    found = {}
    for i, t, _, kind, value in rows:
        if kind == "error" and value is not None and i is not None:
            end = t + dt.timedelta(seconds=value // 1)
            inside = [u for j, s, u, _, _ in rows if j is not None and j != i and t <= s <= end]
            n, users = found.get((i, t), (0, set()))
            if inside:
                found[i, t] = (n + len(inside), users | set(inside))
    got = activity.incidents(df)
    assert got.columns == ["incident_id", "opened", "n_events", "n_users"]
    assert sorted(map(tuple, got.collect())) == sorted((i, t, n, len(u)) for (i, t), (n, u) in found.items())
    plan = got._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[-1]
    assert "Exchange" not in plan[:plan.index("Join")] and plan.count("REPARTITION_BY_NUM") == 2


def test_interval_join_at_the_edges_of_buckets(spark):
    """Spans that begin and end around powers of two of microseconds."""
    base = spark.range(-3, 4).select(F.col("id").alias("d"))
    power = spark.createDataFrame([(k,) for k in (0, 1, 4, 20, 30)], "k int")
    shift = F.call_function("shiftleft", F.lit(1).cast("bigint"), F.col("k"))
    spans = base.crossJoin(power).select(
        F.expr("d * 10 + k * 100").alias("span"), F.timestamp_micros(F.col("d")).alias("a"),
        F.timestamp_micros(F.col("d") + shift).alias("b"))
    points = base.crossJoin(power).select(F.timestamp_micros(F.col("d") + shift).alias("t"), F.col("d"), "k")
    plain = temporal.interval_join(spans, points, "a", "b", "t")
    placed = temporal.interval_join(spans, points, "a", "b", "t", until="b").drop(*temporal.PLACE)
    brute = spans.join(points, F.expr("t between a and b"))
    rows = sorted(map(str, brute.collect()))
    assert sorted(map(str, placed.collect())) == rows and sorted(map(str, plain.collect())) == rows
