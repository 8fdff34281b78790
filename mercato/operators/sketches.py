"""Mergeable sketches: distinct counts and quantiles kept as columns.

A sketch is a small binary column of a table at a fine grain (day and state,
say).  Coarser results merge the sketches of their groups and never read the
rows again; new days are added by writing their sketches.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

LG_K = 14  # 16,384 registers
#: Three relative standard errors of a HyperLogLog sketch, 1.04 / sqrt(registers).
DISTINCT_BOUND = 3 * 1.04 / (1 << LG_K) ** 0.5
QUANTILE_K = 400
#: Normalised rank error of a KLL sketch of that size, at 99 per cent confidence.
RANK_BOUND = 0.01


def with_distinct(df: DataFrame, by: Sequence[str], name: str, value: Column) -> DataFrame:
    """One distinct-count sketch of ``value`` for each group; nulls are not
    counted.  Tasks combine their rows into sketches before the shuffle."""
    return df.groupBy(*by).agg(F.hll_sketch_agg(value, F.lit(LG_K)).alias(name))


def merged_distinct(sketches: DataFrame, by: Sequence[str], name: str) -> DataFrame:
    """The sketches of finer groups as those of coarser ones (all, without
    ``by``)."""
    return sketches.groupBy(*by).agg(F.hll_union_agg(F.col(name)).alias(name))


def distinct_estimate(name: str) -> Column:
    return F.hll_sketch_estimate(F.col(name))


def with_quantiles(df: DataFrame, by: Sequence[str], name: str, value: Column) -> DataFrame:
    """One quantile sketch (KLL) of ``value`` for each group; nulls and NaN are
    left out."""
    number = F.nanvl(value.cast("double"), F.lit(None).cast("double"))
    return df.groupBy(*by).agg(F.kll_sketch_agg_double(number, F.lit(QUANTILE_K)).alias(name))


def quantile(name: str, q: float) -> Column:
    return F.kll_sketch_get_quantile_double(F.col(name), F.lit(float(q)))


def rank_of(name: str, value: Column) -> Column:
    """Share of the values not above ``value``."""
    return F.kll_sketch_get_rank_double(F.col(name), value.cast("double"))


def merged_quantiles(sketches: DataFrame, by: Sequence[str], name: str) -> DataFrame:
    return sketches.groupBy(*by).agg(F.kll_merge_agg_double(F.col(name), F.lit(QUANTILE_K)).alias(name))
