"""Subtotals, top rows of groups, and sums over ranges.

Each works on rows that were reduced before, so that what Spark expands, sorts
or keeps per group is bounded by groups and not by input rows.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

LEVEL = "grouping_level"


def _sets(by: Sequence[str], kind: str) -> list[list[str]]:
    if kind == "rollup":
        return [list(by[:n]) for n in range(len(by), -1, -1)]
    return [[c for i, c in enumerate(by) if not n >> (len(by) - 1 - i) & 1] for n in range(1 << len(by))]


def subtotals(df: DataFrame, by: Sequence[str], measures: Mapping[str, tuple[Column, Column]],
              kind: str = "cube", sets: Sequence[Sequence[str]] | None = None) -> DataFrame:
    """Groups by ``by`` with subtotals: ``cube`` (all subsets), ``rollup``
    (prefixes) or the given ``sets``.  ``measures``: name to (aggregate of
    input rows, aggregate of its results, named ``name``); it must add up, as
    sums, counts, minima and maxima do.  ``grouping_level`` has a bit for each
    column that a row sums over, the last column's lowest, as ``grouping_id``
    has; a null key is not a subtotal.

    The finest groups are made first, by an aggregate that combines map-side;
    only those rows are expanded into the grouping sets.
    """
    sets = [list(s) for s in sets] if sets is not None else _sets(by, kind)
    finest = df.groupBy(*by).agg(*(first.alias(name) for name, (first, _) in measures.items()))
    merged = [more.alias(name) for name, (_, more) in measures.items()]
    out = finest.groupingSets([[F.col(c) for c in s] for s in sets], *(F.col(c) for c in by)).agg(
        F.grouping_id().cast("int").alias(LEVEL), *merged)
    return out.select(*by, LEVEL, *measures)


def top_rows(df: DataFrame, by: Sequence[str], order: Sequence[Column], n: int, rank: str = "rank") -> DataFrame:
    """The first ``n`` rows of each group by ``order``, with their rank.  Tasks
    keep the first n of each group before the shuffle (Spark's window group
    limit), so a group with a third of all rows sends n rows from each task."""
    ranked = df.withColumn(rank, F.row_number().over(Window.partitionBy(*by).orderBy(*order)))
    return ranked.where(F.col(rank) <= n)


def moving(df: DataFrame, by: Sequence[str], day: str, days: int, measures: Mapping[str, Column]) -> DataFrame:
    """Measures of each group over the ``days`` days up to each of its days
    (a range of days, not of rows: days without rows count as empty).  ``df``
    has one row per group and day, so a group's window holds its days only."""
    number = F.unix_date(F.col(day).cast("date"))
    frame = Window.partitionBy(*by).orderBy(number).rangeBetween(1 - days, 0)
    return df.withColumns({name: m.over(frame) for name, m in measures.items()})
