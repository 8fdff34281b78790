"""Declarative data-quality rules compiled to Spark aggregates.

Rule semantics (those of the expectation library the pipeline was modelled
on): column rules skip nulls, except the not-null rule; a rule passes only
with zero unexpected rows; the uniqueness rule counts *every* row of a
repeated value.

``validate`` evaluates all single-pass rules of a table in **one**
aggregation (one scan, partial aggregation before a single-row shuffle) and
each uniqueness rule as one group-by.  The result is a small DataFrame, one
row per rule -- the only thing that is ever brought to the driver.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Names of the expectation types, as printed in the report.
NOT_NULL = "expect_column_values_to_not_be_null"
UNIQUE = "expect_column_values_to_be_unique"
IN_SET = "expect_column_values_to_be_in_set"
BETWEEN = "expect_column_values_to_be_between"
LENGTH_BETWEEN = "expect_column_value_lengths_to_be_between"
ROW_COUNT_BETWEEN = "expect_table_row_count_to_be_between"

RESULT_SCHEMA = T.StructType([
    T.StructField("dataset", T.StringType()),
    T.StructField("dataset_order", T.IntegerType()),
    T.StructField("rule_order", T.IntegerType()),
    T.StructField("rule", T.StringType()),
    T.StructField("column_name", T.StringType()),
    T.StructField("success", T.BooleanType()),
    T.StructField("failures", T.LongType()),
    T.StructField("note", T.StringType()),
])


@dataclass(frozen=True)
class Rule:
    kind: str
    column: str | None = None
    note: str | None = None
    value_set: tuple = ()
    min_value: float | int | None = None
    max_value: float | int | None = None

    # -- single-pass rules: (failures, success) from one aggregate row ------
    def counters(self) -> tuple[Column, Column] | None:
        """Aggregate expressions (failures, observed) or None for group-by rules."""
        if self.kind == UNIQUE:
            return None
        if self.kind == ROW_COUNT_BETWEEN:
            return F.lit(0).cast("bigint"), F.count(F.lit(1))
        c = F.col(self.column)
        if self.kind == NOT_NULL:
            bad = c.isNull()
        elif self.kind == IN_SET:
            bad = ~c.isin(list(self.value_set))
        elif self.kind == BETWEEN:
            bad = _outside(c, self.min_value, self.max_value)
        elif self.kind == LENGTH_BETWEEN:
            bad = _outside(F.char_length(c), self.min_value, self.max_value)
        else:
            raise ValueError(f"unknown rule {self.kind}")
        if self.kind != NOT_NULL:
            bad = c.isNotNull() & bad
        return F.count_if(bad), F.lit(None)

    def success_of(self, failures: Column, observed: Column) -> Column:
        if self.kind == ROW_COUNT_BETWEEN:
            ok = F.lit(True)
            if self.min_value is not None:
                ok = ok & (observed >= self.min_value)
            if self.max_value is not None:
                ok = ok & (observed <= self.max_value)
            return ok
        return failures == 0


def _outside(c: Column, lo, hi) -> Column:
    cond = F.lit(False)
    if lo is not None:
        cond = cond | (c < F.lit(lo))
    if hi is not None:
        cond = cond | (c > F.lit(hi))
    return cond


# --- rule constructors --------------------------------------------------------

def not_null(column: str, note: str | None = None) -> Rule:
    return Rule(NOT_NULL, column, note)


def unique(column: str, note: str | None = None) -> Rule:
    return Rule(UNIQUE, column, note)


def in_set(column: str, values: Sequence, note: str | None = None) -> Rule:
    return Rule(IN_SET, column, note, value_set=tuple(values))


def between(column: str, min_value=None, max_value=None, note: str | None = None) -> Rule:
    return Rule(BETWEEN, column, note, min_value=min_value, max_value=max_value)


def length_between(column: str, min_value=None, max_value=None, note: str | None = None) -> Rule:
    return Rule(LENGTH_BETWEEN, column, note, min_value=min_value, max_value=max_value)


def row_count_between(min_value=None, max_value=None, note: str | None = None) -> Rule:
    return Rule(ROW_COUNT_BETWEEN, None, note, min_value=min_value, max_value=max_value)


# --- evaluation ---------------------------------------------------------------

def _result_row(dataset: str, dataset_order: int, i: int, rule: Rule,
                failures: Column, success: Column) -> Column:
    return F.struct(
        F.lit(dataset).alias("dataset"),
        F.lit(dataset_order).cast("int").alias("dataset_order"),
        F.lit(i).cast("int").alias("rule_order"),
        F.lit(rule.kind).alias("rule"),
        F.lit(rule.column).cast("string").alias("column_name"),
        success.alias("success"),
        failures.cast("bigint").alias("failures"),
        F.lit(rule.note).cast("string").alias("note"),
    )


def key_counts(df: DataFrame, column: str) -> DataFrame:
    """Rows per distinct value of ``column`` (one aggregation, combined
    map-side).  The same DataFrame can feed a uniqueness rule and an orphan
    check, and Spark then runs the aggregation's shuffle once."""
    return df.groupBy(column).agg(F.count(F.lit(1)).alias("n"))


def validate(df: DataFrame, dataset: str, rules: Sequence[Rule],
             dataset_order: int = 0, counts: dict[str, DataFrame] | None = None) -> DataFrame:
    """One row per rule: dataset, orders, rule, column_name, success, failures, note.

    ``counts`` may hold ``key_counts`` results by column, shared with other
    checks of the same table."""
    parts: list[DataFrame] = []
    single = [(i, r) for i, r in enumerate(rules) if r.counters() is not None]
    if single:
        aggs = []
        for i, r in single:
            failures, observed = r.counters()
            aggs += [failures.alias(f"f{i}"), observed.alias(f"o{i}")]
        row = df.agg(*aggs)
        structs = [
            _result_row(dataset, dataset_order, i, r, F.col(f"f{i}"),
                        r.success_of(F.col(f"f{i}"), F.col(f"o{i}")))
            for i, r in single
        ]
        parts.append(row.select(F.inline(F.array(*structs))))
    for i, r in enumerate(rules):
        if r.kind != UNIQUE:
            continue
        per_value = (counts or {}).get(r.column)
        if per_value is None:
            per_value = key_counts(df, r.column)
        repeated = (per_value.where(F.col(r.column).isNotNull() & (F.col("n") > 1))
                    .agg(F.coalesce(F.sum("n"), F.lit(0)).alias("f")))
        parts.append(repeated.select(F.inline(F.array(
            _result_row(dataset, dataset_order, i, r, F.col("f"), F.col("f") == 0)))))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def orphan_rule(children: DataFrame, parents: DataFrame, key: str, dataset: str,
                dataset_order: int = 0, note: str | None = None,
                parent_keys: DataFrame | None = None) -> DataFrame:
    """Referential integrity: child rows whose key has no parent row.

    The check is a table row-count rule whose upper bound is 0 when orphans
    exist, so it fails exactly when there is an orphan, and reports the
    orphan count as its failures.  The children are reduced to one row per
    key, combined map-side, so one scan counts them and neither a hot key nor
    a hot null key reaches the join; a null key never matches there and stays
    an orphan.  ``parent_keys`` (distinct parent keys, e.g. ``key_counts``)
    may replace the parent table.
    """
    k = F.col(key)
    if parent_keys is not None:
        # ``n > 0`` holds for every key; referencing the count keeps this
        # aggregation identical to the uniqueness rule's, so Spark reuses
        # its shuffle instead of aggregating the parent keys twice.
        known = parent_keys.where(F.col("n") > 0)
    else:
        known = parents
    orphans = key_counts(children, key).join(known.where(k.isNotNull()).select(key), on=key, how="left_anti")
    total = orphans.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("f"))
    rule = row_count_between(0, None, note)
    return total.select(F.inline(F.array(
        _result_row(dataset, dataset_order, 0, rule, F.col("f"), F.col("f") == 0))))
