"""Streams over files that arrive one after the other, against batch results."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from mercato.streaming import event_stream

T0 = dt.datetime(2024, 1, 1)
SCHEMA = "ts timestamp, user long, value double, id long"


def arrive(spark, folder, name, rows):
    """One file of (minute, user, value) rows."""
    data = [(T0 + dt.timedelta(minutes=m), u, float(v), i) for i, (m, u, v) in enumerate(rows)]
    spark.createDataFrame(data, SCHEMA).coalesce(1).write.parquet(f"{folder}/{name}")


@pytest.fixture
def arrivals(spark, tmp_path):
    folder = tmp_path / "events"
    on_time = [(m, m % 3, 1) for m in range(0, 120, 2)]
    arrive(spark, folder, "day=1", on_time[:30])
    return str(folder), on_time


def windows(folder, spark, tmp_path, **kw):
    stream = event_stream.windowed(
        event_stream.read_events(spark, f"{folder}/*", spark.createDataFrame([], SCHEMA).schema, 1), "ts", "10 minutes", "15 minutes",
        ["user"], n=F.count(F.lit(1)), total=F.sum("value"), **kw)
    report = event_stream.run_available(stream, str(tmp_path / "log"), str(tmp_path / "checkpoint"))
    log = event_stream.change_log(spark, str(tmp_path / "log"), stream.schema)
    rows = event_stream.latest(log, ["window_start", "window_end", "user"]).collect()
    return report, {(r.window_start, r.user): (r.n, r.total) for r in rows}


def batch(rows):
    out = {}
    for m, u, v in rows:
        key = (T0 + dt.timedelta(minutes=m // 10 * 10), u)
        n, total = out.get(key, (0, 0.0))
        out[key] = (n + 1, total + v)
    return out


def test_available_now_equals_the_batch_result(spark, tmp_path, arrivals):
    folder, rows = arrivals
    report, got = windows(folder, spark, tmp_path)
    assert got == batch(rows[:30]) and report.late_rows == 0 and report.input_rows == 30
    arrive(spark, folder, "day=2", rows[30:])  # a second run goes on from the first one's state
    report, got = windows(folder, spark, tmp_path)
    assert got == batch(rows) and report.input_rows == 30
    report, got = windows(folder, spark, tmp_path)  # nothing new
    assert got == batch(rows) and report.input_rows == 0


def test_late_rows_are_counted_and_state_is_dropped(spark, tmp_path, arrivals):
    folder, rows = arrivals
    windows(folder, spark, tmp_path)
    arrive(spark, folder, "day=2", [(300, 0, 1), (301, 1, 1)])
    windows(folder, spark, tmp_path)
    arrive(spark, folder, "day=3", [(4, 0, 100), (5, 1, 100), (299, 2, 7)])  # two far behind, one within the allowance
    report, got = windows(folder, spark, tmp_path)
    assert got == batch(rows[:30] + [(300, 0, 1), (301, 1, 1), (299, 2, 7)])
    assert report.late_rows == 2
    assert report.state_rows == 3  # the windows of the first hour are gone


def test_a_batch_that_runs_again_replaces_its_rows(spark, tmp_path, arrivals):
    folder, rows = arrivals
    windows(folder, spark, tmp_path)
    log = spark.read.parquet(str(tmp_path / "log"))
    first = log.where("batch = 0")
    before = first.count()
    first.drop("batch").write.mode("overwrite").parquet(str(tmp_path / "again"))
    spark.read.parquet(str(tmp_path / "again")).write.mode("overwrite").parquet(str(tmp_path / "log" / "batch=0"))
    assert spark.read.parquet(str(tmp_path / "log")).where("batch = 0").count() == before


def test_sessions_close_and_merge(spark, tmp_path):
    folder = str(tmp_path / "events")
    arrive(spark, folder, "a", [(0, 1, 1), (8, 1, 1), (0, 2, 1)])
    arrive(spark, folder, "b", [(4, 1, 1), (200, 3, 1)])  # joins the two sessions of user 1
    arrive(spark, folder, "c", [(400, 3, 1)])
    stream = event_stream.sessions(
        event_stream.read_events(spark, f"{folder}/*", spark.createDataFrame([], SCHEMA).schema, 1), "ts", "5 minutes",
        "30 minutes", ["user"], n=F.count(F.lit(1)))
    event_stream.run_available(stream, str(tmp_path / "log"), str(tmp_path / "checkpoint"), mode="append")
    got = {tuple(r) for r in event_stream.change_log(spark, str(tmp_path / "log"), stream.schema).select(
        "user", "session_start", "session_end", "n").collect()}
    at = lambda m: T0 + dt.timedelta(minutes=m)
    assert got == {(1, at(0), at(13), 3), (2, at(0), at(5), 1), (3, at(200), at(205), 1)}


def test_repeats_are_dropped_once(spark, tmp_path):
    folder = str(tmp_path / "events")
    arrive(spark, folder, "a", [(0, 1, 1), (1, 1, 2), (2, 2, 3)])
    arrive(spark, folder, "b", [(3, 2, 4), (4, 3, 5)])
    stream = event_stream.first_of_each(
        event_stream.read_events(spark, f"{folder}/*", spark.createDataFrame([], SCHEMA).schema, 1), "ts", "1 hour", ["user"])
    report = event_stream.run_available(stream, str(tmp_path / "log"), str(tmp_path / "checkpoint"), mode="append")
    log = event_stream.change_log(spark, str(tmp_path / "log"), stream.schema)
    assert sorted(r.user for r in log.collect()) == [1, 2, 3] and report.state_rows == 3
