"""Joins and groupings along time: sessions, as-of join, interval join.

All three are compositions of aggregates, equi joins and windows whose window
partitions are bounded by a span of time instead of a key, so a key that
holds a third of all rows is worked on by many tasks.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from mercato.operators.joins import RIGHT_SUFFIX

# Partial and merging aggregate of a measure that can be added up.
MERGES = {"sum": (F.sum, F.sum), "min": (F.min, F.min), "max": (F.max, F.max), "count": (F.count, F.sum)}


def _names(c: str | Sequence[str]) -> list[str]:
    return [c] if isinstance(c, str) else list(c)


def micros(df: DataFrame, ts: str) -> Column:
    """Microseconds of a timestamp column; without zone, as it is written, so
    that no result depends on the session's zone."""
    at = F.col(ts)
    if not isinstance(df.schema[ts].dataType, T.TimestampNTZType):
        return F.unix_micros(at.cast("timestamp"))
    # differences of zone-free times go through the session's zone, their parts don't
    minutes = F.unix_date(at.cast("date")).cast("bigint") * 1440 + F.hour(at) * 60 + F.minute(at)
    return minutes * 60_000_000 + (F.extract(F.lit("SECOND"), at) * 1_000_000).cast("bigint")


def without_zone(instant: Column) -> Column:
    """The zone-free time of an instant made from ``micros``."""
    seconds = (F.unix_micros(instant) / F.lit(1_000_000).cast("decimal(8,0)")).cast("decimal(18,6)")
    return F.lit("1970-01-01").cast("timestamp_ntz") + F.make_dt_interval(secs=seconds)


def session_windows(df: DataFrame, by: str | Sequence[str], ts: str, gap_seconds: int,
                    measures: Mapping[str, tuple[str, str]] | None = None) -> DataFrame:
    """Sessions of each key: rows less than ``gap_seconds`` after the one
    before belong together.  One row per session: the keys, ``session_start``
    and ``session_end`` (first and last time), ``n_rows`` and the
    ``measures``, ``{name: (column, sum | min | max | count)}``.

    Rows of one key within one slot of the gap's width are always together,
    so they are reduced to one row by a map-side-combined aggregate first; the
    window that joins slots holds at most (time spanned / gap) rows of a key,
    however many rows the key has.  Rows without a time are in no session;
    null keys are a key.
    """
    keys, measures = _names(by), dict(measures or {})
    at, gap = micros(df, ts), gap_seconds * 1_000_000
    slot = F.floor(at / F.lit(gap)).alias("__slot")
    partial = [MERGES[how][0](c).alias(name) for name, (c, how) in measures.items()]
    slots = df.where(F.col(ts).isNotNull()).groupBy(*keys, slot).agg(
        F.min(ts).alias("__first"), F.max(ts).alias("__last"), F.min(at).alias("__from"), F.max(at).alias("__to"),
        F.count(F.lit(1)).alias("n_rows"), *partial)
    in_order = Window.partitionBy(*keys).orderBy("__slot")
    apart = F.col("__from") - F.lag("__to").over(in_order) >= gap
    number = F.sum(F.when(apart, 1).otherwise(0)).over(in_order)
    merged = [MERGES[how][1](name).alias(name) for name, (_, how) in measures.items()]
    return (slots.withColumn("__session", number).groupBy(*keys, "__session")
            .agg(F.min("__first").alias("session_start"), F.max("__last").alias("session_end"),
                 F.sum("n_rows").alias("n_rows"), *merged)
            .select(*keys, "session_start", "session_end", "n_rows", *measures))


def asof_join(left: DataFrame, right: DataFrame, by: str | Sequence[str], left_ts: str, right_ts: str,
              tie: Sequence[str] = (), strict: bool = False, tolerance_seconds: int | None = None,
              bucket_seconds: int = 86_400) -> DataFrame:
    """Every left row with the latest row of ``right`` that has its key and a
    time not after its own (``strict``: before it), nulls where there is none
    or where it is older than ``tolerance_seconds``.  Of right rows at one time
    the largest by ``tie`` counts.  Keys have one name on both sides; other
    clashing right columns get the suffix ``_right``.

    No range of pairs is built: both sides are one sorted stream in which the
    last right row is carried on.  The stream is cut by key *and* time bucket;
    what a bucket starts with is the latest right row of an earlier one, found
    by an aggregate per bucket (combined map-side) and a window over buckets.
    A hot key is spread over its buckets.  Null keys and null times match
    nothing.
    """
    keys = _names(by)
    taken = set(left.columns)
    others = [c for c in right.columns if c not in keys]
    renamed = {c: c + RIGHT_SUFFIX if c in taken else c for c in others}
    width = bucket_seconds * 1_000_000

    def stamped(df: DataFrame, ts: str) -> DataFrame:
        at = micros(df, ts)
        return df.withColumns({"__ts": at, "__bucket": F.floor(at / F.lit(width))})

    usable = F.lit(True)
    for c in keys:
        usable = usable & F.col(c).isNotNull()
    found = F.struct(F.col("__ts").alias("ts"), *(F.col(c).alias(f"t{i}") for i, c in enumerate(tie)),
                     F.struct(*(F.col(c).alias(c) for c in others)).alias("row"))
    rights = stamped(right.where(usable & F.col(right_ts).isNotNull()), right_ts).select(
        *keys, "__ts", "__bucket", found.alias("__right"))
    lefts = stamped(left, left_ts).withColumn("__left", F.struct(*(F.col(c).alias(c) for c in left.columns)))
    matched = lefts.where(usable & F.col(left_ts).isNotNull()).select(*keys, "__ts", "__bucket", "__left")
    unmatched = left.where(~usable | F.col(left_ts).isNull())

    # The last right row of every bucket, and what each bucket starts with.
    order = [F.col("__right")["ts"], *(F.col("__right")[f"t{i}"] for i in range(len(tie)))]
    last = rights.groupBy(*keys, "__bucket").agg(F.max_by("__right", F.struct(*order)).alias("__last"))
    buckets = last.unionByName(matched.select(*keys, "__bucket").distinct(), allowMissingColumns=True).groupBy(
        *keys, "__bucket").agg(F.first("__last", ignorenulls=True).alias("__last"))
    before = Window.partitionBy(*keys).orderBy("__bucket").rowsBetween(Window.unboundedPreceding, -1)
    carried = buckets.select(*keys, "__bucket", F.last("__last", ignorenulls=True).over(before).alias("__right")).where(
        F.col("__right").isNotNull()).withColumn("__ts", F.lit(None).cast("bigint"))

    stream = rights.unionByName(carried, allowMissingColumns=True).unionByName(matched, allowMissingColumns=True)
    first = F.when(F.col("__left").isNull(), 0).otherwise(1)  # at one time, right rows count for left rows
    if strict:
        first = 1 - first
    by_time = [F.col("__ts").asc_nulls_first(), first.asc(), *(c.asc_nulls_first() for c in order[1:])]
    so_far = Window.partitionBy(*keys, "__bucket").orderBy(*by_time).rowsBetween(
        Window.unboundedPreceding, Window.currentRow)
    joined = stream.withColumn("__found", F.last("__right", ignorenulls=True).over(so_far)).where(
        F.col("__left").isNotNull())
    match = F.col("__found")
    if tolerance_seconds is not None:
        match = F.when(F.col("__ts") - match["ts"] <= tolerance_seconds * 1_000_000, match)
    out = joined.select(F.col("__left").alias("l"), match["row"].alias("r")).select(
        "l.*", *(F.col("r").getField(c).alias(renamed[c]) for c in others))
    nothing = [F.lit(None).cast(right.schema[c].dataType).alias(renamed[c]) for c in others]
    return out.unionByName(unmatched.select("*", *nothing))


MAX_LEVEL = 62
#: Columns that name the place where a span meets its points.
PLACE = ("__level", "__bucket")
#: Comparisons that one task of a join by place is to make.
TASK_COMPARISONS = 4_000_000


def _comparisons(spans: DataFrame, points: DataFrame, at: list[str], finest: int, levels: Sequence[int]) -> int:
    """Pairs that meet at a place; ``points`` have one row per keys and bucket
    of the finest level, with their number."""
    here = points.withColumn("__level", F.explode(F.array(*(F.lit(n) for n in levels))))
    bucket = F.call_function("shiftright", F.col("__fine"), F.col("__level") - finest)
    here = here.withColumn("__bucket", F.explode(F.array(bucket, bucket - 1)))
    met = spans.groupBy(*at).agg(F.count(F.lit(1)).alias("__spans")).join(
        here.groupBy(*at).agg(F.sum("__n").alias("__points")), at)
    return int(met.agg(F.sum(F.col("__spans").cast("double") * F.col("__points"))).first()[0] or 0)


def interval_join(spans: DataFrame, points: DataFrame, start: str, end: str, ts: str,
                  by: str | Sequence[str] = (), rare: float = 0.01, until: str | None = None) -> DataFrame:
    """Pairs of spans and points with start <= time <= end, and equal keys
    where ``by`` names some: all columns of the span, then the point's (its
    keys are left out, clashing names get the suffix ``_right``).

    Time is cut into buckets of a width that fits the span: the power of two
    not below its length, so a span touches at most two.  A point is sent once
    to each width in use, and the join is on (keys, width, bucket) with the
    exact comparison on top; there is no nested loop, and very long spans do
    not widen the buckets of short ones.  Widths that fewer than ``rare`` of
    the spans have are merged upwards; which are in use is one aggregate of at
    most 63 rows.  Rows without key, start, end or time match nothing, nor do
    spans that end before they start.

    With ``until``, a span's column that is not before its end, all spans of
    one start and one such time meet their points at one place, and the columns
    ``PLACE`` that name it come last.  An aggregate by span and place, and by
    more columns, then runs in the tasks of the join: the pairs, which may be
    many times the input, are never moved.  For that a point is sent to two
    buckets of each width, and the partitions follow the comparisons to make,
    counted first.
    """
    keys = _names(by)
    placed = until is not None
    usable = F.lit(True)
    for c in keys:
        usable = usable & F.col(c).isNotNull()
    length = micros(spans, end) - micros(spans, start)
    wide = spans.where(usable & (length >= 0))
    if placed:  # wider than the span, so it ends in the bucket after its own at the latest
        level = F.length(F.bin(micros(spans, until) - micros(spans, start)))
    else:
        level = F.ceil(F.log2(length.cast("double") + 1)).cast("int") + 1
    wide = wide.withColumn("__level", F.least(F.lit(MAX_LEVEL), level))
    counts = dict(wide.groupBy("__level").count().collect())  # at most 63 rows
    kept: list[int] = []
    for n in sorted(counts, reverse=True):
        if not kept or counts[n] >= rare * sum(counts.values()):
            kept.append(n)
    kept.sort()
    kept = kept or [MAX_LEVEL]
    above = F.lit(kept[-1])
    for n in reversed(kept[:-1]):
        above = F.when(F.col("__level") <= n, n).otherwise(above)

    def bucket(c: Column) -> Column:
        return F.call_function("shiftright", c, F.col("__level"))

    at = [*keys, *PLACE]
    wide = wide.withColumn("__level", above).select(
        *(F.col(c).alias(f"__s{i}") for i, c in enumerate(spans.columns)), *keys, "__level",
        micros(spans, start).alias("__from"), micros(spans, end).alias("__to"))
    first, last = bucket(F.col("__from")), bucket(F.col("__to"))
    wide = wide.withColumn("__bucket", first if placed else F.explode(F.array_distinct(F.array(first, last))))
    others = [c for c in points.columns if c not in keys]
    seen = points.where(usable & F.col(ts).isNotNull())
    some = seen.select(
        *(F.col(c).alias(f"__p{i}") for i, c in enumerate(others)), *keys, micros(points, ts).alias("__at"),
        F.explode(F.array(*(F.lit(n) for n in kept))).alias("__level"))
    here = bucket(F.col("__at"))
    some = some.withColumn("__bucket", F.explode(F.array(here, here - 1)) if placed else here)
    if placed:
        fine = seen.groupBy(*keys, F.call_function("shiftright", micros(points, ts), F.lit(kept[0])).alias("__fine"))
        n = -(-_comparisons(wide, fine.agg(F.count(F.lit(1)).alias("__n")), at, kept[0], kept) // TASK_COMPARISONS)
        if n > 1:
            n = max(n, int(points.sparkSession.conf.get("spark.sql.shuffle.partitions")))
            wide, some = wide.repartition(n, *at), some.repartition(n, *at)
    joined = wide.join(some, at).where("__at between __from and __to")
    taken = set(spans.columns)
    return joined.select(*(F.col(f"__s{i}").alias(c) for i, c in enumerate(spans.columns)),
                         *(F.col(f"__p{i}").alias(c + RIGHT_SUFFIX if c in taken else c) for i, c in enumerate(others)),
                         *(PLACE if placed else ()))
