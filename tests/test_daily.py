"""Null rules, rounding order and optional zones of the daily tables and reports."""

import datetime

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from hourmill import analytics
from hourmill.operators import daily_totals, generation_summary, load_summary, share_by_join, share_summary

LOADS = [
    "de_load_actual_entsoe_transparency",
    "de_load_forecast_entsoe_transparency",
    "de_lu_load_actual_entsoe_transparency",
    "de_lu_load_forecast_entsoe_transparency",
]
NATIONAL = ["de_solar_generation_actual", "de_wind_onshore_generation_actual", "de_wind_offshore_generation_actual"]
DAY = datetime.date(2019, 3, 1)


def hours(spark, values, extra=()):
    names = LOADS + NATIONAL + list(extra)
    schema = "utc_timestamp string, " + ", ".join(f"{n} double" for n in names)
    data = [(f"2019-03-01 {h:02d}:00:00", *[v.get(n) for n in names]) for h, v in enumerate(values)]
    return spark.createDataFrame(data, schema).withColumn("utc_timestamp", F.col("utc_timestamp").cast("timestamp"))


def one(df):
    (row,) = df.collect()
    return row.asDict()


def test_a_day_without_generation(spark):
    totals = daily_totals(hours(spark, [{LOADS[0]: 100.0}] * 24))
    made = one(generation_summary(totals))
    assert made["de_solar_generation_mwh"] is None and made["de_wind_generation_mwh"] == 0.0
    assert one(share_summary(totals))["wind_solar_share_percent"] == 0.0


@pytest.mark.parametrize("load", [0.0, -5.0, None])
def test_share_needs_a_positive_load(spark, load):
    totals = daily_totals(hours(spark, [{LOADS[0]: load, NATIONAL[0]: 3.0}] * 2))
    share = one(share_summary(totals))
    assert share["wind_solar_share_percent"] is None and share["de_wind_solar_generation_mwh"] == 6.0


def test_error_is_the_difference_of_rounded_values(spark):
    totals = daily_totals(hours(spark, [{LOADS[0]: 1.005, LOADS[1]: 0.994}]))
    load = one(load_summary(totals))
    assert (load["de_load_actual_mwh"], load["de_load_forecast_mwh"]) == (1.01, 0.99)
    assert load["de_forecast_error_mwh"] == 0.02 and load["de_lu_forecast_error_mwh"] is None


def test_zones_follow_the_columns_present(spark):
    extra = ["de_50hertz_solar_generation_actual", "de_tennet_wind_offshore_generation_actual"]
    totals = daily_totals(hours(spark, [{extra[0]: 2.0}], extra))
    made = one(generation_summary(totals))
    assert made["50hertz_solar_generation_mwh"] == 2.0 and made["tennet_wind_generation_mwh"] == 0.0
    assert set(made) == {
        "event_date", "de_solar_generation_mwh", "de_wind_generation_mwh",
        "50hertz_solar_generation_mwh", "tennet_wind_generation_mwh",
    }


def test_national_columns_are_required(spark):
    with pytest.raises(PySparkException):
        daily_totals(hours(spark, [{}]).drop(NATIONAL[0]))


def test_share_by_join_equals_share(spark):
    totals = daily_totals(hours(spark, [{LOADS[0]: 10.0, NATIONAL[0]: 1.0, NATIONAL[1]: 2.345}]))
    joined = share_by_join(generation_summary(totals), load_summary(totals))
    assert joined.collect() == share_summary(totals).collect()


def test_share_takes_one_shuffle(spark):
    totals = daily_totals(hours(spark, [{LOADS[0]: 10.0}]))
    plan = share_summary(totals)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1 and "Join" not in plan


def test_monthly_total_is_unknown_without_solar(spark):
    daily = spark.createDataFrame(
        [(DAY, None, 5.0)], "event_date date, de_solar_generation_mwh double, de_wind_generation_mwh double"
    )
    row = one(analytics.monthly_generation(daily))
    assert row["total_renewable_generation_mwh"] is None and row["wind_generation_mwh"] == 5.0


def test_division_by_zero_is_null(spark):
    daily = spark.createDataFrame(
        [(DAY, 0.0, 0.0)], "event_date date, de_solar_generation_mwh double, de_wind_generation_mwh double"
    )
    assert one(analytics.contribution(daily))["solar_percent"] is None
    load = spark.createDataFrame(
        [(DAY, 0.0, 1.0), (DAY, None, None)],
        "event_date date, de_load_actual_mwh double, de_forecast_error_mwh double",
    )
    row = one(analytics.forecast_accuracy(load))
    assert row["mean_absolute_percentage_error"] is None and row["mean_absolute_error_mwh"] == 1.0


def test_means_on_half_a_cent_round_up_in_any_order(spark):
    values = [100000000.01, 0.02, 100000000.01, 0.02]
    for order in (values, values[::-1]):
        daily = spark.createDataFrame([(DAY, v) for v in order], "event_date date, de_load_actual_mwh double")
        assert one(analytics.monthly_load(daily.repartition(3)))["average_daily_load_mwh"] == 50000000.02


def test_seasons_in_order_and_unknown_dates_in_autumn(spark):
    dates = [datetime.date(2019, m, 1) for m in range(1, 13)]
    daily = spark.createDataFrame(
        [(d, float(d.month)) for d in dates] + [(None, 100.0)], "event_date date, de_load_actual_mwh double"
    )
    assert [tuple(r) for r in analytics.seasonal_load(daily).collect()] == [
        ("Winter", 5.0), ("Spring", 4.0), ("Summer", 7.0), ("Autumn", 32.5),
    ]


def test_top_days_use_a_top_k_plan(spark):
    share = spark.range(100).selectExpr(
        "date_add(date'2019-01-01', cast(id AS int)) AS event_date",
        "1.0D AS de_wind_solar_generation_mwh",
        "1.0D AS de_load_actual_mwh",
        "if(id % 10 = 0, null, cast(id % 7 AS double)) AS wind_solar_share_percent",
    )
    top = analytics.top_days(share)
    found = [(r.wind_solar_share_percent, r.event_date) for r in top.collect()]
    assert found == sorted(found, key=lambda r: (-r[0], r[1])) and len(found) == 10
    assert "TakeOrderedAndProject" in top._jdf.queryExecution().executedPlan().toString()
