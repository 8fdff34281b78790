"""Subtotals, top rows, moving sums, sketches and reconciliation."""

import random
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from mercato.operators import reconcile, sketches
from mercato.operators.totals import moving, subtotals, top_rows


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def sales(spark):
    """(state, year, amount): nulls among the keys; one state holds half."""
    rng = random.Random(4)
    rows = [("A" if rng.random() < 0.5 else rng.choice(["B", "C", None]), rng.choice([2020, 2021, None]), rng.randrange(100))
            for _ in range(500)]
    return rows, spark.createDataFrame(rows, "state string, year int, amount int").repartition(4)


def grouped(rows, sets):
    out = {}
    for keep in sets:
        level = 2 * ("state" not in keep) + ("year" not in keep)
        for s, y, a in rows:
            key = (s if "state" in keep else None, y if "year" in keep else None, level)
            n, total = out.get(key, (0, 0))
            out[key] = (n + 1, total + a)
    return sorted(((*k, *v) for k, v in out.items()), key=str)


@pytest.fixture(scope="module")
def measures(spark):
    return {"n": (F.count(F.lit(1)), F.sum("n")), "total": (F.sum("amount"), F.sum("total"))}


@pytest.mark.parametrize("how", [
    {"kind": "cube"}, {"kind": "rollup"}, {"sets": [["year"], []]}, {"sets": [["state", "year"]]}])
def test_subtotals(sales, measures, how):
    rows, df = sales
    sets = how.get("sets") or [["state", "year"], ["state"], *([["year"]] if how.get("kind") == "cube" else []), []]
    got = subtotals(df, ["state", "year"], measures, **how)
    assert got.columns == ["state", "year", "grouping_level", "n", "total"]
    assert sorted(map(tuple, got.collect()), key=str) == grouped(rows, sets)


def test_only_reduced_rows_are_expanded(sales, measures):
    plan = plan_of(subtotals(sales[1], ["state", "year"], measures))
    assert plan.count("Expand") >= 1 and "partial_count" in plan[plan.index("Expand"):]  # the aggregate is below


def test_top_rows_are_limited_before_the_shuffle(spark):
    rng = random.Random(9)
    rows = [(0 if rng.random() < 0.5 else rng.randrange(1, 6), rng.randrange(40), i) for i in range(2000)]
    df = spark.createDataFrame(rows, "seller int, amount int, id int").repartition(6)
    got = top_rows(df, ["seller"], [F.col("amount").desc(), F.col("id")], 3)
    by = defaultdict(list)
    for s, a, i in rows:
        by[s].append((-a, i))
    expected = sorted((s, -a, i, k) for s, v in by.items() for k, (a, i) in enumerate(sorted(v)[:3], 1))
    assert sorted(map(tuple, got.collect())) == expected
    plan = plan_of(got)
    assert plan.count("WindowGroupLimit") >= 2 and "Partial" in plan


def test_moving_sums_are_over_days(spark):
    rows = [("A", "2024-01-01", 1), ("A", "2024-01-03", 2), ("A", "2024-01-08", 4), ("B", "2024-01-08", 8)]
    df = spark.createDataFrame(rows, "g string, day string, x int").withColumn("day", F.col("day").cast("date"))
    got = moving(df, ["g"], "day", 7, {"week": F.sum("x")})
    assert {(r.g, str(r.day)): r.week for r in got.collect()} == {
        ("A", "2024-01-01"): 1, ("A", "2024-01-03"): 3, ("A", "2024-01-08"): 6, ("B", "2024-01-08"): 8}


def test_distinct_sketches_merge_and_keep_their_bound(spark):
    df = spark.range(60_000).select((F.col("id") % 30).alias("day"), (F.col("id") * 7919 % 20_011).cast("string").alias("who"))
    daily = sketches.with_distinct(df, ["day"], "people", F.col("who"))
    whole = sketches.merged_distinct(daily, [], "people").select(sketches.distinct_estimate("people")).first()[0]
    exact = df.select("who").distinct().count()
    assert abs(whole - exact) <= sketches.DISTINCT_BOUND * exact
    at_once = df.agg(F.hll_sketch_estimate(F.hll_sketch_agg("who", F.lit(sketches.LG_K)))).first()[0]
    assert whole == at_once  # merging loses nothing
    empty = sketches.with_distinct(spark.createDataFrame([(1, None)], "day int, who string"), ["day"], "people", F.col("who"))
    assert empty.select(sketches.distinct_estimate("people")).first()[0] == 0


def test_quantile_sketches_merge_and_keep_their_bound(spark):
    df = spark.range(50_000).select((F.col("id") % 40).alias("day"), F.pow(F.col("id") % 9973, F.lit(2)).alias("x"))
    merged = sketches.merged_quantiles(sketches.with_quantiles(df, ["day"], "xs", F.col("x")), [], "xs")
    for q in (0.01, 0.25, 0.5, 0.9, 0.999):
        value, rank = merged.select(sketches.quantile("xs", q), sketches.rank_of("xs", F.lit(9973.0 ** 2 / 4))).first()
        below, upto = df.agg(F.avg((F.col("x") < value).cast("double")), F.avg((F.col("x") <= value).cast("double"))).first()
        assert below - sketches.RANK_BOUND <= q <= upto + sketches.RANK_BOUND
        assert abs(rank - 0.5) <= 2 * sketches.RANK_BOUND


def test_reconciliation_counts_duplicates(spark):
    rng = random.Random(6)
    sides = [[(rng.choice([1, 2, None]), rng.choice(["x", "y", None])) for _ in range(n)] for n in (40, 30)]
    left, right = (spark.createDataFrame(rows, "a int, b string").repartition(3) for rows in sides)
    l, r = map(Counter, sides)
    expected = sorted(((*k, l[k], r[k]) for k in l | r if l[k] != r[k]), key=str)
    assert sorted(map(tuple, reconcile.differences(left, right, ["a", "b"]).collect()), key=str) == expected
    assert tuple(reconcile.summary(left, right, ["a", "b"]).first()) == (
        40, 30, sum((l & r).values()), sum((l - r).values()), sum((r - l).values()))
    assert tuple(reconcile.summary(left.limit(0), right.limit(0), ["a", "b"]).first()) == (0, 0, 0, 0, 0)
    assert "Join" not in plan_of(reconcile.differences(left, right, ["a", "b"]))
