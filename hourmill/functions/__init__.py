"""Column expressions: times and batches, rounding and null guards."""

from .numbers import cents, guarded_percent, mean_of_cents, or_zero, ratio
from .times import (
    at_time,
    batch_month,
    batch_year,
    month_span,
    month_tag,
    parse_instant,
    season,
)

__all__ = [
    "at_time",
    "batch_month",
    "batch_year",
    "cents",
    "guarded_percent",
    "mean_of_cents",
    "month_span",
    "month_tag",
    "or_zero",
    "parse_instant",
    "ratio",
    "season",
]
