"""Analytic queries on the daily tables, and validation queries on the layers.

``load``, ``generation`` and ``share`` are the daily tables as DataFrames.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import cents, mean_of_cents, ratio, season

# Order of seasons in reports.
SEASONS = ("Winter", "Spring", "Summer", "Autumn")


def _by_month(daily: DataFrame):
    return daily.groupBy(F.date_trunc("month", "event_date").alias("month"))


def _total(name: str) -> Column:
    return cents(F.sum(name))


def recent_load(load: DataFrame, days: int = 30) -> DataFrame:
    """The latest days of actual load, forecast and forecast error, newest first."""
    wanted = load.select("event_date", "de_load_actual_mwh", "de_load_forecast_mwh", "de_forecast_error_mwh")
    return wanted.orderBy(F.desc("event_date")).limit(days)


def monthly_load(load: DataFrame) -> DataFrame:
    """Monthly load and mean daily load."""
    actual = "de_load_actual_mwh"
    return (
        _by_month(load)
        .agg(
            _total(actual).alias("monthly_load_mwh"),
            mean_of_cents(F.col(actual)).alias("average_daily_load_mwh"),
        )
        .orderBy("month")
    )


def forecast_accuracy(load: DataFrame) -> DataFrame:
    """Monthly mean absolute error, and mean of the daily percentage errors."""
    miss = F.abs("de_forecast_error_mwh")
    return (
        _by_month(load)
        .agg(
            mean_of_cents(miss).alias("mean_absolute_error_mwh"),
            cents(F.avg(ratio(miss, F.col("de_load_actual_mwh"))) * 100).alias("mean_absolute_percentage_error"),
        )
        .orderBy("month")
    )


def share_trend(share: DataFrame) -> DataFrame:
    """The daily share series."""
    return share.select("event_date", "wind_solar_share_percent").orderBy("event_date")


def top_days(share: DataFrame, days: int = 10) -> DataFrame:
    """Days with the highest share; equal shares are listed by date."""
    known = share.where(F.col("wind_solar_share_percent").isNotNull())
    return (
        known.select(
            "event_date", "de_wind_solar_generation_mwh", "de_load_actual_mwh", "wind_solar_share_percent"
        )
        .orderBy(F.desc("wind_solar_share_percent"), "event_date")
        .limit(days)
    )


def monthly_generation(generation: DataFrame) -> DataFrame:
    """Monthly solar, wind and their total; the total is unknown when either is."""
    sums = _by_month(generation).agg(
        F.sum("de_solar_generation_mwh").alias("solar"), F.sum("de_wind_generation_mwh").alias("wind")
    )
    return sums.select(
        "month",
        cents(F.col("solar")).alias("solar_generation_mwh"),
        cents(F.col("wind")).alias("wind_generation_mwh"),
        cents(F.col("solar") + F.col("wind")).alias("total_renewable_generation_mwh"),
    ).orderBy("month")


def contribution(generation: DataFrame) -> DataFrame:
    """Solar and wind over all time, in amount and in percent of their total."""
    sums = generation.agg(
        F.sum("de_solar_generation_mwh").alias("solar"), F.sum("de_wind_generation_mwh").alias("wind")
    )
    both = F.col("solar") + F.col("wind")
    return sums.select(
        cents(F.col("solar")).alias("solar_generation_mwh"),
        cents(F.col("wind")).alias("wind_generation_mwh"),
        cents(ratio(F.col("solar"), both) * 100).alias("solar_percent"),
        cents(ratio(F.col("wind"), both) * 100).alias("wind_percent"),
    )


def yearly_progress(share: DataFrame) -> DataFrame:
    """Mean and highest daily share, and total generation, per year."""
    percent = F.col("wind_solar_share_percent")
    return (
        share.groupBy(F.year("event_date").alias("year"))
        .agg(
            mean_of_cents(percent).alias("average_wind_solar_share_percent"),
            cents(F.max(percent)).alias("maximum_wind_solar_share_percent"),
            _total("de_wind_solar_generation_mwh").alias("wind_solar_generation_mwh"),
        )
        .orderBy("year")
    )


def seasonal_load(load: DataFrame) -> DataFrame:
    """Mean daily load per season, winter first."""
    place = F.array_position(F.array(*[F.lit(s) for s in SEASONS]), F.col("season"))
    return (
        load.groupBy(season(F.col("event_date")).alias("season"))
        .agg(mean_of_cents(F.col("de_load_actual_mwh")).alias("average_daily_load_mwh"))
        .orderBy(place)
    )


def monthly_summary(load: DataFrame, generation: DataFrame, share: DataFrame) -> DataFrame:
    """Load, generation, share and forecast error side by side for months all three tables have."""
    loads = _by_month(load).agg(
        _total("de_load_actual_mwh").alias("load_mwh"),
        mean_of_cents(F.abs("de_forecast_error_mwh")).alias("mean_absolute_forecast_error_mwh"),
    )
    produced = _by_month(generation).agg(
        _total("de_solar_generation_mwh").alias("solar_mwh"), _total("de_wind_generation_mwh").alias("wind_mwh")
    )
    shares = _by_month(share).agg(
        mean_of_cents(F.col("wind_solar_share_percent")).alias("wind_solar_share_percent")
    )
    return (
        loads.join(produced, "month")
        .join(shares, "month")
        .select(
            "month",
            "load_mwh",
            "solar_mwh",
            "wind_mwh",
            "wind_solar_share_percent",
            "mean_absolute_forecast_error_mwh",
        )
        .orderBy("month")
    )


def rows_per_batch(bronze: DataFrame) -> DataFrame:
    return bronze.groupBy("batch_id").agg(F.count(F.lit(1)).alias("row_count")).orderBy("batch_id")


def rows_per_month(silver: DataFrame) -> DataFrame:
    return silver.groupBy("year", "month").agg(F.count(F.lit(1)).alias("row_count")).orderBy("year", "month")


def share_preview(share: DataFrame, days: int = 20) -> DataFrame:
    return share.orderBy("event_date").limit(days)
