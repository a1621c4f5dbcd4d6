"""Daily load, generation and share tables from typed hourly rows.

All three come from the same daily sums, so one aggregation serves them.
"""

from __future__ import annotations

from functools import reduce
from operator import add

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import cents, guarded_percent, or_zero
from ..session import require_utc
from ..spec import GERMAN_POWER, GenerationArea, SeriesSpec


def _areas(spec: SeriesSpec, columns: list[str], zones: bool) -> list[tuple[GenerationArea, bool, tuple[str, ...]]]:
    """Areas with whether their solar column takes part, and which wind columns do."""
    areas = (spec.national, *(spec.zones if zones else ()))
    present = set(columns)
    return [
        (a, not a.optional or a.solar in present, tuple(w for w in a.wind if not a.optional or w in present))
        for a in areas
    ]


def daily_totals(hourly: DataFrame, spec: SeriesSpec = GERMAN_POWER, zones: bool = True) -> DataFrame:
    """Unrounded daily sums of every measure the daily tables need."""
    require_utc(hourly)
    measures = [m for area in spec.load for m in (area.actual, area.forecast)]
    for area, has_solar, winds in _areas(spec, hourly.columns, zones):
        measures += [area.solar] * has_solar + list(winds)
    day = F.to_date(spec.key).alias("event_date")
    return hourly.groupBy(day).agg(*[F.sum(m).alias(m) for m in measures])


def load_summary(totals: DataFrame, spec: SeriesSpec = GERMAN_POWER) -> DataFrame:
    """Actual and forecast load per day, and the difference of the two rounded values."""
    amounts = [
        (cents(F.col(source)), name)
        for area in spec.load
        for source, name in ((area.actual, area.daily_actual), (area.forecast, area.daily_forecast))
    ]
    errors = [
        (cents(cents(F.col(area.actual)) - cents(F.col(area.forecast))), area.daily_error) for area in spec.load
    ]
    return totals.select("event_date", *[value.alias(name) for value, name in amounts + errors])


def _wind(winds: tuple[str, ...]) -> Column:
    return cents(reduce(add, [or_zero(F.col(w)) for w in winds]))


def generation_summary(totals: DataFrame, spec: SeriesSpec = GERMAN_POWER, zones: bool = True) -> DataFrame:
    """Solar and wind per day and area.

    Solar of a day without any value is null, wind is 0. An optional area has
    only the results for which a source column exists.
    """
    results = []
    for area, has_solar, winds in _areas(spec, totals.columns, zones):
        if has_solar:
            results.append(cents(F.col(area.solar)).alias(area.daily_solar))
        if winds:
            results.append(_wind(winds).alias(area.daily_wind))
    return totals.select("event_date", *results)


def _renewable(solar: Column, wind: Column) -> Column:
    return cents(or_zero(solar) + or_zero(wind))


def share_summary(totals: DataFrame, spec: SeriesSpec = GERMAN_POWER) -> DataFrame:
    """Wind and solar per day as a percentage of actual load, null unless load is positive."""
    load, area = spec.load[0], spec.national
    renewable = _renewable(cents(F.col(area.solar)), _wind(area.wind))
    both = totals.select(
        "event_date",
        renewable.alias(spec.daily_renewable),
        cents(F.col(load.actual)).alias(load.daily_actual),
    )
    share = guarded_percent(F.col(spec.daily_renewable), F.col(load.daily_actual))
    return both.select("*", share.alias(spec.daily_share))


def share_by_join(generation: DataFrame, load: DataFrame, spec: SeriesSpec = GERMAN_POWER) -> DataFrame:
    """The share table from finished generation and load tables, joined by day."""
    area, actual = spec.national, spec.load[0].daily_actual
    renewable = _renewable(F.col(area.daily_solar), F.col(area.daily_wind))
    both = generation.select("event_date", renewable.alias(spec.daily_renewable)).join(
        load.select("event_date", actual), "event_date"
    )
    share = guarded_percent(F.col(spec.daily_renewable), F.col(actual))
    return both.select("event_date", spec.daily_renewable, actual, share.alias(spec.daily_share))
