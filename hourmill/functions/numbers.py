"""Rounding and null-guard expressions for energy amounts."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def cents(amount: Column) -> Column:
    """Two decimals, half away from zero."""
    return F.round(amount, 2)


def or_zero(amount: Column) -> Column:
    return F.coalesce(amount, F.lit(0.0))


def ratio(part: Column, whole: Column) -> Column:
    """Quotient that is null where the divisor is zero."""
    return part / F.nullif(whole, F.lit(0.0))


def guarded_percent(part: Column, whole: Column) -> Column:
    """Percentage to two decimals; null unless ``whole`` is positive."""
    return F.when(whole > 0, cents(part / whole * 100))


def mean_of_cents(amount: Column) -> Column:
    """Rounded mean of amounts that already have two decimals.

    The sum of such amounts is exact to the cent once rounded, so dividing that
    sum keeps a mean that falls on half a cent from moving with the order in
    which tasks add up.
    """
    return cents(cents(F.sum(amount)) / F.nullif(F.count(amount), F.lit(0)))
