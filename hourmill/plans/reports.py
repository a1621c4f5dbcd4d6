"""The reports as SQL text over the stored tables, in the names of a spec.

Table names are fields in braces: `bronze`, `silver`, `load`, `generation`, `share`, `control`.
The same reports as DataFrame functions are in `analytics`.
"""

from __future__ import annotations

import re

from ..spec import GERMAN_POWER, SeriesSpec

# Months of the seasons, whose order is that of reports; any other is the last.
_SEASONS = {"Winter": (12, 1, 2), "Spring": (3, 4, 5), "Summer": (6, 7, 8), "Autumn": (9, 10, 11)}
_MONTH = "date_trunc('MONTH', event_date) AS month"


def _total(column: str) -> str:
    return f"round(sum({column}), 2)"


def _mean(amount: str) -> str:
    """A mean of amounts in whole cents, half a cent up, so that it does not move with the order of adding."""
    cents, n = f"sum(CAST(round({amount} * 100) AS BIGINT))", f"count({amount})"
    return f"CAST((2 * {cents} + {n}) div nullif(2 * {n}, 0) AS DOUBLE) / 100"


def _season(month: str) -> str:
    named = list(_SEASONS.items())
    cases = " ".join(f"WHEN {month} IN ({', '.join(map(str, months))}) THEN '{name}'" for name, months in named[:-1])
    return f"CASE {cases} ELSE '{named[-1][0]}' END"


def tables_of(text: str) -> list[str]:
    """The tables that a report names."""
    return sorted(set(re.findall(r"\{(\w+)\}", text)))


def statements(spec: SeriesSpec = GERMAN_POWER) -> dict[str, str]:
    area, made = spec.load[0], spec.national
    actual, forecast, error = area.daily_actual, area.daily_forecast, area.daily_error
    solar, wind, both, share = made.daily_solar, made.daily_wind, spec.daily_renewable, spec.daily_share
    place = " ".join(f"WHEN '{name}' THEN {i}" for i, name in enumerate(_SEASONS, 1))
    return {
        "q01_recent_load": f"SELECT event_date, {actual}, {forecast}, {error} FROM {{load}} ORDER BY event_date DESC LIMIT 30",
        "q02_monthly_load": f"""SELECT {_MONTH}, {_total(actual)} AS monthly_load_mwh, {_mean(actual)} AS average_daily_load_mwh
            FROM {{load}} GROUP BY 1 ORDER BY month""",
        "q03_forecast_accuracy": f"""SELECT {_MONTH}, {_mean(f"abs({error})")} AS mean_absolute_error_mwh,
            round(avg(abs({error}) / nullif({actual}, 0)) * 100, 2) AS mean_absolute_percentage_error
            FROM {{load}} GROUP BY 1 ORDER BY month""",
        "q04_share_trend": f"SELECT event_date, {share} FROM {{share}} ORDER BY event_date",
        "q05_top_days": f"""SELECT event_date, {both}, {actual}, {share} FROM {{share}} WHERE {share} IS NOT NULL
            ORDER BY {share} DESC, event_date LIMIT 10""",
        "q06_monthly_generation": f"""SELECT {_MONTH}, {_total(solar)} AS solar_generation_mwh, {_total(wind)} AS wind_generation_mwh,
            round(sum({solar}) + sum({wind}), 2) AS total_renewable_generation_mwh FROM {{generation}} GROUP BY 1 ORDER BY month""",
        "q07_contribution": f"""WITH sums AS (SELECT sum({solar}) AS s, sum({wind}) AS w FROM {{generation}})
            SELECT round(s, 2) AS solar_generation_mwh, round(w, 2) AS wind_generation_mwh,
                   round(s / nullif(s + w, 0) * 100, 2) AS solar_percent, round(w / nullif(s + w, 0) * 100, 2) AS wind_percent FROM sums""",
        "q08_yearly_progress": f"""SELECT year(event_date) AS year, {_mean(share)} AS average_wind_solar_share_percent,
            round(max({share}), 2) AS maximum_wind_solar_share_percent, {_total(both)} AS wind_solar_generation_mwh
            FROM {{share}} GROUP BY 1 ORDER BY year""",
        "q09_seasonal_load": f"""SELECT {_season("month(event_date)")} AS season, {_mean(actual)} AS average_daily_load_mwh
            FROM {{load}} GROUP BY 1 ORDER BY CASE season {place} END""",
        "q10_monthly_summary": f"""WITH
            loads AS (SELECT {_MONTH}, {_total(actual)} AS load_mwh, {_mean(f"abs({error})")} AS mean_absolute_forecast_error_mwh
                      FROM {{load}} GROUP BY 1),
            produced AS (SELECT {_MONTH}, {_total(solar)} AS solar_mwh, {_total(wind)} AS wind_mwh FROM {{generation}} GROUP BY 1),
            shares AS (SELECT {_MONTH}, {_mean(share)} AS {share} FROM {{share}} GROUP BY 1)
            SELECT month, load_mwh, solar_mwh, wind_mwh, {share}, mean_absolute_forecast_error_mwh
            FROM loads JOIN produced USING (month) JOIN shares USING (month) ORDER BY month""",
        "v1_control_history": "SELECT * FROM {control} ORDER BY year, month",
        "v2_bronze_counts": "SELECT batch_id, count(*) AS row_count FROM {bronze} GROUP BY batch_id ORDER BY batch_id",
        "v3_silver_counts": "SELECT year, month, count(*) AS row_count FROM {silver} GROUP BY year, month ORDER BY year, month",
        "v4_share_preview": "SELECT * FROM {share} ORDER BY event_date LIMIT 20",
    }
