"""Keep one row per key.

``keep_one_per_key`` is an aggregation, not a window: each key keeps the
row that is smallest by the given order columns (then by the remaining
columns, so the choice is fully deterministic).  As an aggregate it is
combined map-side before the shuffle, so a key holding a third of all rows
is reduced to one row per input partition before it moves -- a
``row_number()`` window would instead sort the whole hot key in one task.

Null keys form one group, like any other key value.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def keep_one_per_key(df: DataFrame, keys: str | Sequence[str],
                     order_by: Sequence[str] | None = None) -> DataFrame:
    keys = [keys] if isinstance(keys, str) else list(keys)
    rest = [c for c in df.columns if c not in keys]
    if not rest:
        return df.select(*keys).distinct()
    order = list(order_by) if order_by else []
    # Fields compare left to right and nulls sort first, as in
    # ORDER BY ... ASC NULLS FIRST.
    pick = F.struct(
        *[F.col(c).alias(f"__o{i}") for i, c in enumerate(order)],
        F.struct(*[F.col(c) for c in rest]).alias("__row"),
    )
    kept = df.groupBy(*keys).agg(F.min(pick).alias("__pick"))
    return kept.select(*[F.col(k) for k in keys],
                       *[F.col(f"__pick.__row.`{c}`").alias(c) for c in rest]
                       ).select(*df.columns)
