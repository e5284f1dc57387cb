"""Column-expression helpers. All are built-in Spark expressions (codegen'd, no UDFs)."""

from marquee.functions.text import strip_ws, blank_to_null, split_list, first_token, first_number
from marquee.functions.dates import (
    parse_added_date, year_of, month_of, quarter_label, month_bounds, in_month,
    in_year_range,
)
from marquee.functions.stats import pct, safe_ratio, count_where

__all__ = [
    "strip_ws", "blank_to_null", "split_list", "first_token", "first_number",
    "parse_added_date", "year_of", "month_of", "quarter_label", "month_bounds",
    "in_month", "in_year_range",
    "pct", "safe_ratio", "count_where",
]
