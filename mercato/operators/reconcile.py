"""Comparing two tables as multisets of rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def differences(left: DataFrame, right: DataFrame, columns: Sequence[str]) -> DataFrame:
    """The distinct rows of ``columns`` that one side holds more often, with
    ``n_left`` and ``n_right``: both directions of EXCEPT ALL at once.  Nulls
    are equal.  One union and one aggregate that combines map-side, so a row
    that a side holds very often moves once for each task; no join."""
    def counted(df: DataFrame, l: int, r: int) -> DataFrame:
        return df.select(*columns, F.lit(l).alias("n_left"), F.lit(r).alias("n_right"))

    rows = counted(left, 1, 0).unionByName(counted(right, 0, 1))
    sums = rows.groupBy(*columns).agg(F.sum("n_left").alias("n_left"), F.sum("n_right").alias("n_right"))
    return sums.where("n_left <> n_right")


def summary(left: DataFrame, right: DataFrame, columns: Sequence[str]) -> DataFrame:
    """One row: rows of either side, rows in common (INTERSECT ALL), and rows
    that only one side has."""
    def counted(df: DataFrame, l: int, r: int) -> DataFrame:
        return df.select(*columns, F.lit(l).alias("n_left"), F.lit(r).alias("n_right"))

    rows = counted(left, 1, 0).unionByName(counted(right, 0, 1))
    sums = rows.groupBy(*columns).agg(F.sum("n_left").alias("l"), F.sum("n_right").alias("r"))
    total = [F.sum("l"), F.sum("r"), F.sum(F.least("l", "r")), F.sum(F.greatest(F.col("l") - F.col("r"), F.lit(0))),
             F.sum(F.greatest(F.col("r") - F.col("l"), F.lit(0)))]
    names = ("rows_left", "rows_right", "in_both", "only_left", "only_right")
    return sums.agg(*(F.coalesce(t, F.lit(0)).cast("bigint").alias(n) for t, n in zip(total, names)))
