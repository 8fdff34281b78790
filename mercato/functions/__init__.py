from mercato.functions.columns import (  # noqa: F401
    WHITESPACE,
    blank_to_null,
    datetime_columns,
    iso_weekday,
    mean,
    money_mean,
    money_mean_of,
    money_merged,
    money_parts,
    money_sum,
    money_total,
    month_start,
    n_unique,
    parse_datetime,
    parse_datetime_inferred,
    ratio_pct,
    strip_ws,
    sum0,
    upper_strip,
    whole_days,
)
