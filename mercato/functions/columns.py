"""Column helpers.

Each helper is a built-in Spark expression (JVM side, whole-stage codegen),
chosen so that the pipeline keeps the semantics of the original dataframe
code it was modelled on.  Every helper documents the trap it handles.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

ColumnOrName = Column | str

# The Unicode White_Space characters, stripped from both ends
# of text by the cleaning rules (a plain SQL trim removes spaces only).
# U+0009-U+000D, U+0020, U+0085, U+00A0, U+1680, U+2000-U+200A, U+2028,
# U+2029, U+202F, U+205F, U+3000.
WHITESPACE = (
    "\t\n\x0b\x0c\r \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)

# Fixed value: the datetime layout of raw order dates.
ORDER_DATETIME_FORMAT = "yyyy-MM-dd HH:mm:ss"

# Shape of a date or datetime whose layout is not given: year, month and day
# parted by dashes or slashes, then, after a blank or T, hours and minutes,
# seconds and their fraction as far as present.
INFERRED_SHAPE = r"^[0-9]{4}([-/])[0-9]{2}\1[0-9]{2}([ T][0-9]{2}:[0-9]{2}(:[0-9]{2}([.][0-9]{1,9})?)?)?$"


def _col(c: ColumnOrName) -> Column:
    return F.col(c) if isinstance(c, str) else c


# --- text -------------------------------------------------------------------

def strip_ws(c: ColumnOrName) -> Column:
    """Trim all Unicode white space from both ends."""
    return F.btrim(_col(c), F.lit(WHITESPACE))


def upper_strip(c: ColumnOrName) -> Column:
    return F.upper(strip_ws(c))


def blank_to_null(c: ColumnOrName) -> Column:
    """The empty string becomes null; other values pass through."""
    return F.nullif(_col(c), F.lit(""))


def datetime_columns(columns: Iterable[str]) -> list[str]:
    """Columns treated as datetimes: their name mentions timestamp or date."""
    return [c for c in columns if "timestamp" in c or "date" in c]


# --- datetimes --------------------------------------------------------------

# Layouts that have an exact shape check: text of that shape is cast
# directly (zone-free, no per-row exception for bad text).
_LAYOUT_SHAPES = {
    "yyyy-MM-dd HH:mm:ss": r"^[0-9]{4}-[0-9]{2}-[0-9]{2} [0-9]{2}:[0-9]{2}:[0-9]{2}$",
    "yyyy-MM-dd": r"^[0-9]{4}-[0-9]{2}-[0-9]{2}$",
}


def parse_datetime(c: ColumnOrName, fmt: str = ORDER_DATETIME_FORMAT) -> Column:
    """Parse text with one layout into ``timestamp_ntz``; text that does not
    fit the layout, or names no real date or time, becomes null.

    For the common layouts the text's shape is checked with a regular
    expression and then cast, which is zone-free, never raises and never
    throws per row (a formatter-based parse pays an exception for every bad
    value).  Other layouts use ``try_to_timestamp`` and convert back to
    ``timestamp_ntz`` in the session zone, which is exact except for local
    times that fall in a daylight-saving gap of that zone.
    """
    col = _col(c)
    shape = _LAYOUT_SHAPES.get(fmt)
    if shape is not None:
        return F.when(col.rlike(shape), col.try_cast("timestamp_ntz"))
    return F.try_to_timestamp(col, F.lit(fmt)).cast("timestamp_ntz")


def parse_datetime_inferred(c: ColumnOrName) -> Column:
    """Parse text whose layout is not given, row by row: a column may mix the
    layouts of ``INFERRED_SHAPE``, and a value that fits none is null.

    A bare year such as ``2018`` is *not* a datetime here (a plain cast would
    accept it).
    """
    col = _col(c)
    return F.when(col.rlike(INFERRED_SHAPE), F.translate(col, "/", "-").try_cast("timestamp_ntz"))


def whole_days(start: ColumnOrName, end: ColumnOrName) -> Column:
    """Whole days from ``start`` to ``end``, truncated toward zero.

    23 hours is 0 days and -49 hours is -2 days; ``datediff`` would count
    calendar-day boundaries instead.
    """
    return F.timestamp_diff("DAY", _col(start), _col(end))


def iso_weekday(c: ColumnOrName) -> Column:
    """Monday = 1 ... Sunday = 7 (``dayofweek`` would give Sunday = 1)."""
    return F.extract(F.lit("DAYOFWEEK_ISO"), _col(c))


def month_start(c: ColumnOrName) -> Column:
    """First instant of the month, zone-free (``date_trunc`` would return a
    zoned timestamp)."""
    return F.trunc(F.to_date(_col(c)), "month").cast("timestamp_ntz")


# --- aggregates -------------------------------------------------------------

def n_unique(c: ColumnOrName) -> Column:
    """Distinct values with null counted as one value.

    ``count_distinct`` ignores nulls, so a null term is added.
    """
    col = _col(c)
    return F.count_distinct(col) + F.max(F.when(col.isNull(), 1).otherwise(0))


def sum0(c: ColumnOrName) -> Column:
    """Sum that is 0, not null, when the group holds only nulls."""
    return F.coalesce(F.sum(_col(c)), F.lit(0))


def _whole_cents(x: Column) -> tuple[Column, Column]:
    """The value as whole cents, and whether that is exactly the value."""
    whole = F.round(x * 100).try_cast("bigint")
    return whole, F.coalesce(whole / F.lit(100.0) == x, F.lit(False))


def money_parts(c: ColumnOrName, name: str) -> list[Column]:
    """Aggregates for ``money_total`` and ``money_mean_of``: the sum in whole
    cents, whether it is exact (null without values), the plain sum, and the
    number of values."""
    x = _col(c)
    whole, exact = _whole_cents(x)
    total = F.try_sum(whole)
    return [total.alias(f"{name}_cents"),
            F.when(F.count(x) > 0, F.bool_and(F.when(x.isNotNull(), exact)) & total.isNotNull()).alias(f"{name}_exact"),
            F.sum(x).alias(f"{name}_plain"), F.count(x).alias(f"{name}_n")]


def money_merged(name: str, times: ColumnOrName) -> list[Column]:
    """``money_parts`` of groups of rows that hold them, each row counted
    ``times`` times."""
    k, exact = _col(times), F.col(f"{name}_exact")
    cents = F.try_multiply(F.col(f"{name}_cents"), k)
    total = F.try_sum(cents)
    whole = F.bool_and(F.when(exact.isNotNull(), exact & cents.isNotNull()))
    return [total.alias(f"{name}_cents"), F.when(whole.isNotNull(), whole & total.isNotNull()).alias(f"{name}_exact"),
            F.sum(F.col(f"{name}_plain") * k).alias(f"{name}_plain"), F.sum(F.col(f"{name}_n") * k).alias(f"{name}_n")]


def money_total(name: str) -> Column:
    """``money_sum`` over rows that hold ``money_parts``."""
    total = F.try_sum(f"{name}_cents")
    exact = F.bool_and(f"{name}_exact") & total.isNotNull()
    return F.when(exact, total / F.lit(100.0)).otherwise(F.coalesce(F.sum(f"{name}_plain"), F.lit(0.0)))


def money_mean_of(name: str) -> Column:
    """``money_mean`` over rows that hold ``money_parts``."""
    return F.try_divide(money_total(name), F.sum(f"{name}_n"))


def money_sum(c: ColumnOrName) -> Column:
    """Sum of a money column; 0.0 for an all-null group.

    Where every value of the group is a whole number of cents, the cents are
    summed as ``bigint``: exact, and independent of row order.  Any other
    value (a finer amount, NaN, an infinity, one beyond the ``bigint`` range)
    makes the group a plain sum of doubles, which loses no value but may
    differ in the last bits with the row order.
    """
    x = _col(c)
    whole, exact = _whole_cents(x)
    total = F.try_sum(whole)
    all_exact = F.bool_and(F.when(x.isNotNull(), exact)) & total.isNotNull()
    return F.when(all_exact, total / F.lit(100.0)).otherwise(F.coalesce(F.sum(x), F.lit(0.0)))


def money_mean(c: ColumnOrName) -> Column:
    """Mean of a money column over its non-null values (null if none)."""
    return F.try_divide(money_sum(c), F.count(_col(c)))


def mean(c: ColumnOrName) -> Column:
    """Mean over non-null values."""
    return F.avg(_col(c))


def ratio_pct(numerator: ColumnOrName, denominator: ColumnOrName) -> Column:
    """numerator / denominator * 100; null instead of an error on zero."""
    return F.try_divide(_col(numerator), _col(denominator)) * F.lit(100)
