"""Joins with dataframe-library naming rules.

* Equi-joins on same-named keys keep one key column, in the left position.
* A right column whose name clashes with a left column is renamed
  ``<name>_right`` before joining (two same-named columns would make later
  references ambiguous).
* Output columns: left columns in order, then the right's non-key columns.

The join strategy is left to Catalyst and AQE: a side whose measured size is
below ``spark.sql.autoBroadcastJoinThreshold`` is broadcast, larger sides are
shuffled and sort-merge joined, and skewed partitions are split at runtime.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

RIGHT_SUFFIX = "_right"


def _keys(on: str | Sequence[str]) -> list[str]:
    return [on] if isinstance(on, str) else list(on)


def join_suffixed(left: DataFrame, right: DataFrame, on: str | Sequence[str],
                  how: str = "inner", suffix: str = RIGHT_SUFFIX) -> DataFrame:
    """Join on same-named key columns, suffixing clashing right columns."""
    keys = _keys(on)
    if how in ("left_anti", "anti", "left_semi", "semi"):
        return left.join(right.select(*keys), on=keys, how=how)
    left_cols = set(left.columns)
    renamed = []
    for c in right.columns:
        if c in keys:
            continue
        renamed.append((c, c + suffix if c in left_cols else c))
    right_sel = right.select(*keys, *[F.col(src).alias(dst) for src, dst in renamed])
    joined = left.join(right_sel, on=keys, how=how)
    return joined.select(*left.columns, *[dst for _, dst in renamed])


def join_on_columns(left: DataFrame, right: DataFrame, left_on: str, right_on: str,
                    how: str = "inner", suffix: str = RIGHT_SUFFIX) -> DataFrame:
    """Join on differently named keys; the right key is dropped."""
    left_cols = set(left.columns)
    l = left.alias("__l")
    r = right.alias("__r")
    right_out = []
    for c in right.columns:
        if c == right_on:
            continue
        right_out.append(F.col(f"__r.`{c}`").alias(c + suffix if c in left_cols else c))
    cond = F.col(f"__l.`{left_on}`") == F.col(f"__r.`{right_on}`")
    return l.join(r, cond, how).select(*[F.col(f"__l.`{c}`") for c in left.columns], *right_out)


def left_join_split_nulls(left: DataFrame, right: DataFrame, on: str | Sequence[str],
                          suffix: str = RIGHT_SUFFIX) -> DataFrame:
    """Left join in which rows with a null key skip the join.

    A null key never matches, so those rows get null right columns directly
    instead of being shuffled -- all of them would hash to one partition.
    Use it when the left side is cheap to read twice (a scan with pushed
    filters), since each branch reads it once.
    """
    keys = _keys(on)
    has_null = F.lit(False)
    for k in keys:
        has_null = has_null | F.col(k).isNull()
    matched = join_suffixed(left.where(~has_null), right, keys, "left", suffix)
    extra = matched.schema.fields[len(left.columns):]
    unmatched = left.where(has_null).select(
        *left.columns, *[F.lit(None).cast(f.dataType).alias(f.name) for f in extra])
    return matched.unionByName(unmatched)
