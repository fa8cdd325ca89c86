"""Column-level building blocks (pure Spark SQL expressions)."""

from flagstar.functions.dates import age_years, as_date, date_key, is_weekend
from flagstar.functions.numeric import money_sum, percent_of, round_half_even
from flagstar.functions.rules import (
    clamp_below,
    is_missing,
    negative,
    outside_dates,
    outside_range,
    regex_match,
    regex_mismatch,
)

__all__ = [
    "age_years",
    "as_date",
    "clamp_below",
    "date_key",
    "is_missing",
    "is_weekend",
    "money_sum",
    "negative",
    "outside_dates",
    "outside_range",
    "percent_of",
    "regex_match",
    "regex_mismatch",
    "round_half_even",
]
