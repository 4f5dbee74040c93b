from ledgerlens.functions.columns import (  # noqa: F401
    days_between, emoji_for, exact_ratio, fmt_fixed, fmt_grouped, indian_grouping,
    severity_rank, ws_trim,
)
