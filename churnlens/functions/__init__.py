"""Native column expressions (no Python per row)."""

from churnlens.functions.expressions import (
    as_col,
    band_left_closed,
    bin_right_closed,
    exact_avg,
    falsy_to_zero,
    flag_equals,
    is_null_count,
    na_to_null,
    python_timestamp_text,
    rate_percent,
    rate_percent_null_as_zero,
    row_digest,
)

__all__ = [
    "as_col",
    "band_left_closed",
    "bin_right_closed",
    "exact_avg",
    "falsy_to_zero",
    "flag_equals",
    "is_null_count",
    "na_to_null",
    "python_timestamp_text",
    "rate_percent",
    "rate_percent_null_as_zero",
    "row_digest",
]
