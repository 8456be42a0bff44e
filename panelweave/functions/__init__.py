from panelweave.functions.expressions import (
    coerce_number,
    columns_by_type,
    drop_columns,
    drop_missing,
    drop_placeholder,
    fill_defaults,
    flag,
    filter_rows,
    min_streak,
    not_equal_keep_null,
    not_in_list,
    period_key,
    pick,
    present,
    rename,
    replace_literals,
    row_sum,
    season_length,
    time_index,
    weighted_sum,
)

__all__ = [
    "coerce_number",
    "columns_by_type",
    "drop_columns",
    "drop_missing",
    "drop_placeholder",
    "fill_defaults",
    "filter_rows",
    "flag",
    "min_streak",
    "not_equal_keep_null",
    "not_in_list",
    "period_key",
    "pick",
    "present",
    "rename",
    "replace_literals",
    "row_sum",
    "season_length",
    "time_index",
    "weighted_sum",
]
