"""Expressions on instants, months and batch identifiers (``yyyy-MM``)."""

from __future__ import annotations

import re
from datetime import date, datetime

from pyspark.sql import Column
from pyspark.sql import functions as F

_BATCH = re.compile(r"(\d{4})-(0[1-9]|1[0-2])")


def parse_instant(text: Column, pattern: str | None = None, on_error: str = "raise") -> Column:
    """Text to timestamp; malformed text raises, or is null with ``on_error="null"``.

    Without a pattern the offset or ``Z`` in the text is honoured.
    """
    if on_error not in ("raise", "null"):
        raise ValueError(f"on_error must be 'raise' or 'null', not {on_error!r}")
    parse = F.to_timestamp if on_error == "raise" else F.try_to_timestamp
    return parse(text) if pattern is None else parse(text, F.lit(pattern) if on_error == "null" else pattern)


def month_tag(instant: Column) -> Column:
    """Batch identifier of an instant."""
    return F.date_format(instant, "yyyy-MM")


def batch_year(batch: Column) -> Column:
    return F.split(batch, "-")[0].cast("int")


def batch_month(batch: Column) -> Column:
    return F.split(batch, "-")[1].cast("int")


def month_span(batch: str) -> tuple[date, date]:
    """First day of a batch and first day of the next one."""
    found = _BATCH.fullmatch(batch or "")
    if not found:
        raise ValueError(f"a batch is a month such as '2019-01', not {batch!r}")
    year, month = int(found[1]), int(found[2])
    return date(year, month, 1), date(year + month // 12, month % 12 + 1, 1)


def at_time(as_of: Column | datetime | str | None) -> Column:
    """A processing time: the query's clock unless one is given."""
    if as_of is None:
        return F.current_timestamp()
    if isinstance(as_of, Column):
        return as_of
    return F.lit(as_of).cast("timestamp")


def season(day: Column) -> Column:
    """Season of a date; anything that is not another season is autumn, an unknown date too."""
    quarter = F.month(day) % 12
    return (
        F.when(quarter < 3, "Winter")
        .when(quarter < 6, "Spring")
        .when(quarter < 9, "Summer")
        .otherwise("Autumn")
    )
