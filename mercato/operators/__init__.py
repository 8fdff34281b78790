from mercato.operators.dedupe import keep_one_per_key  # noqa: F401
from mercato.operators.joins import join_on_columns, join_suffixed, left_join_split_nulls  # noqa: F401
