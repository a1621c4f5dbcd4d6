"""SQL twins of the registered queries, for DuckDB over the same tables.

Means of amounts with two decimals are worked out in whole cents, so that a mean
of exactly half a cent rounds up here as it does in Spark.
"""

from __future__ import annotations

from .inputs import (
    DAMAGED_MONTHS,
    EVENT_TYPES,
    FIRST_OPEN_MONTH,
    MEASURES,
    NATIONAL,
    RUN_TIME,
    SETUP_TIME,
    SOURCE_NAMES,
    UNFINISHED_MONTH,
)

ORDERS = """stamped AS (
  SELECT o_orderdate + to_hours(o_orderkey % 24) AS utc_ts, o_orderkey AS seq, o_totalprice,
         o_orderstatus, o_orderpriority, o_custkey
  FROM orders)"""


def _lines(parts: list[str]) -> str:
    return ",\n  ".join(parts)


HOURLY = f"""{ORDERS},
hourly AS (SELECT utc_ts AS utc_timestamp,
  {_lines([f"round(sum(CASE WHEN {c} THEN o_totalprice END), 2) AS {m}" for m, c in MEASURES.items()])}
  FROM stamped GROUP BY utc_ts)"""

_AREAS = {"de": NATIONAL} | {z: None for z in ("50hertz", "amprion", "tennet", "transnetbw")}


def _area_sums(area: str) -> list[str]:
    source = "de" if area == "de" else f"de_{area}"
    solar = f"{source}_solar_generation_actual"
    winds = [w for k in ("onshore", "offshore") if (w := f"{source}_wind_{k}_generation_actual") in MEASURES]
    name = "de" if area == "de" else f'{area}'
    out = []
    if solar in MEASURES:
        out.append(f'round(sum({solar}), 2) AS "{name}_solar_generation_mwh"')
    if winds:
        total = " + ".join(f"coalesce(sum({w}), 0.0)" for w in winds)
        out.append(f'round({total}, 2) AS "{name}_wind_generation_mwh"')
    return out


LOAD_SUMS = [
    f"round(sum({source}), 2) AS {name}"
    for source, name in (
        ("de_load_actual_entsoe_transparency", "de_load_actual_mwh"),
        ("de_load_forecast_entsoe_transparency", "de_load_forecast_mwh"),
        ("de_lu_load_actual_entsoe_transparency", "de_lu_load_actual_mwh"),
        ("de_lu_load_forecast_entsoe_transparency", "de_lu_load_forecast_mwh"),
    )
]
ZONE_SUMS = [s for a in _AREAS for s in _area_sums(a)]

DAILY = f"""{HOURLY},
load AS (SELECT *, round(de_load_actual_mwh - de_load_forecast_mwh, 2) AS de_forecast_error_mwh,
    round(de_lu_load_actual_mwh - de_lu_load_forecast_mwh, 2) AS de_lu_forecast_error_mwh
  FROM (SELECT CAST(utc_timestamp AS DATE) AS event_date, {_lines(LOAD_SUMS)} FROM hourly GROUP BY 1)),
generation AS (SELECT CAST(utc_timestamp AS DATE) AS event_date, {_lines(ZONE_SUMS)} FROM hourly GROUP BY 1),
share AS (SELECT event_date, made AS de_wind_solar_generation_mwh, de_load_actual_mwh,
    CASE WHEN de_load_actual_mwh > 0 THEN round(made / de_load_actual_mwh * 100, 2) END AS wind_solar_share_percent
  FROM (SELECT event_date, de_load_actual_mwh,
          round(coalesce(de_solar_generation_mwh, 0.0) + coalesce(de_wind_generation_mwh, 0.0), 2) AS made
        FROM generation JOIN load USING (event_date)))"""

MONTH = "CAST(date_trunc('month', event_date) AS TIMESTAMP) AS month"


def _mean(amount: str) -> str:
    total, n = f"sum(CAST(round({amount} * 100) AS BIGINT))", f"count({amount})"
    return f"CAST((2 * {total} + {n}) // nullif(2 * {n}, 0) AS DOUBLE) / 100"


TEXT = f"""{HOURLY},
texts AS (SELECT strftime(utc_timestamp, '%Y-%m-%dT%H:%M:%SZ') AS utc_timestamp,
  strftime(utc_timestamp + INTERVAL 1 HOUR, '%Y-%m-%dT%H:%M:%S') || '+0100' AS cet_cest_timestamp,
  {_lines([f"CAST(CAST({m} AS DECIMAL(38,2)) AS VARCHAR) AS {name}" for m, name in SOURCE_NAMES.items()])},
  CAST(dayofyear(utc_timestamp) AS VARCHAR) AS FR_load, CAST(year(utc_timestamp) AS INTEGER) AS year,
  strftime(utc_timestamp, '%Y-%m') AS batch_id
  FROM hourly)"""
_SOURCE = ", ".join(SOURCE_NAMES.values())
_TYPED = ", ".join(MEASURES)
_YM = "CAST(year(utc_timestamp) AS INTEGER) AS year, CAST(month(utc_timestamp) AS INTEGER) AS month"

_RANKED = "row_number() OVER (PARTITION BY utc_ts ORDER BY seq DESC, value DESC) AS place"
REPORTS = f"""{ORDERS},
items AS (SELECT l_shipdate + to_hours(l_orderkey % 24) AS utc_ts, l_orderkey * 10 + l_linenumber AS seq,
  l_extendedprice AS value FROM lineitem),
old AS (SELECT utc_ts, seq, value FROM
  (SELECT *, {_RANKED} FROM (SELECT utc_ts, seq, o_totalprice AS value FROM stamped)) WHERE place = 1),
new AS (SELECT utc_ts, seq, value FROM (SELECT *, {_RANKED} FROM items) WHERE place = 1),
merged AS (SELECT * FROM new UNION ALL SELECT * FROM old WHERE utc_ts NOT IN (SELECT utc_ts FROM new))"""
_UPSERTED = """SELECT utc_ts AS utc_timestamp, seq, value, CAST(year(utc_ts) AS INTEGER) AS year,
  CAST(month(utc_ts) AS INTEGER) AS month FROM merged"""
_REPORTED_DAY = "CAST(utc_ts AS DATE) AS event_date, round(sum(value), 2) AS reported, count(*) AS reports"

CONTROL = f"""{ORDERS},
months AS (SELECT strftime(utc_ts, '%Y-%m') AS batch_id, count(*) AS n, count(DISTINCT utc_ts) AS hours
  FROM stamped GROUP BY 1),
control AS (SELECT batch_id, CAST(batch_id[1:4] AS INTEGER) AS year, CAST(batch_id[6:7] AS INTEGER) AS month,
  CASE WHEN batch_id < '{FIRST_OPEN_MONTH}' THEN 'completed'
       WHEN batch_id = '{FIRST_OPEN_MONTH}' THEN 'failed' ELSE 'in_progress' END AS status,
  CAST(n AS INTEGER) AS rows_bronze, CAST(hours AS INTEGER) AS rows_silver,
  TIMESTAMP '{SETUP_TIME}' AS created_at, TIMESTAMP '{SETUP_TIME}' AS updated_at,
  CASE WHEN batch_id = '{FIRST_OPEN_MONTH}' THEN 'unreadable file' END AS error_message
  FROM months)"""
_DONE = f"""SELECT batch_id, CAST(batch_id[1:4] AS INTEGER) AS year, CAST(batch_id[6:7] AS INTEGER) AS month, 'completed' AS status,
  CAST(hours AS INTEGER) AS rows_bronze, CAST(hours AS INTEGER) AS rows_silver, TIMESTAMP '{RUN_TIME}' AS created_at,
  TIMESTAMP '{RUN_TIME}' AS updated_at, CAST(NULL AS VARCHAR) AS error_message FROM months"""
_LISTED = """SELECT batch_id, CAST(batch_id[1:4] AS INTEGER) AS year, CAST(batch_id[6:7] AS INTEGER) AS month
  FROM months"""
_OPEN = f"batch_id NOT IN (SELECT batch_id FROM control WHERE status = 'completed' AND batch_id <= '{UNFINISHED_MONTH}')"


def _changed(hit: str, **values: str) -> str:
    swaps = ", ".join(f"CASE WHEN {hit} THEN {v} ELSE {c} END AS {c}" for c, v in values.items())
    return f"WITH {CONTROL} SELECT * REPLACE ({swaps}) FROM control"


def _started(month: str) -> str:
    y, m = month.split("-")
    return (
        f"SELECT '{month}', {int(y)}, {int(m)}, 'in_progress', NULL, NULL, TIMESTAMP '{RUN_TIME}', "
        f"TIMESTAMP '{RUN_TIME}', NULL"
    )


def _nulls(rows: str, columns) -> str:
    return "\nUNION ALL ".join(
        f"SELECT '{c}' AS column_name, count(*) - count({c}) AS null_count, "
        f"CASE WHEN count(*) > 0 THEN round(100.0 * (count(*) - count({c})) / count(*), 1) ELSE 0.0 END "
        f"AS null_percent FROM {rows}"
        for c in columns
    )


def failure_text() -> str:
    """An error text with quotes, longer than what is kept."""
    return "can't read the 'hourly' file; " * 30


def statements() -> dict[str, str]:
    daily_all = f"""WITH {DAILY} SELECT load.*, generation.* EXCLUDE (event_date),
      share.de_wind_solar_generation_mwh, share.wind_solar_share_percent
      FROM load JOIN generation USING (event_date) JOIN share USING (event_date)"""
    kept_text = failure_text().replace("'", "")[:500]
    upserted = f"WITH {REPORTS} {_UPSERTED}"
    told = {
        "scan_csv_year": f"WITH {TEXT} SELECT * EXCLUDE (year, batch_id) FROM texts",
        "scan_csv_all_years": f"WITH {TEXT} SELECT * EXCLUDE (batch_id) FROM texts",
        "scan_file_lineage": f"""WITH {TEXT} SELECT year AS folder_year, 'csv' AS file_kind, count(*) AS row_count
          FROM texts GROUP BY year""",
        "scan_batch": f"""WITH {HOURLY} SELECT *, strftime(utc_timestamp, '%Y-%m') AS batch_id, {_YM}
          FROM hourly WHERE strftime(utc_timestamp, '%Y-%m') = '{FIRST_OPEN_MONTH}'""",
        "project_prefix": f"WITH {TEXT} SELECT utc_timestamp, cet_cest_timestamp, {_SOURCE} FROM texts",
        "normalize_names": f"""WITH {TEXT} SELECT utc_timestamp, cet_cest_timestamp, FR_load AS fr_load, year,
          {", ".join(f"{name} AS {m}" for m, name in SOURCE_NAMES.items())} FROM texts""",
        "bulk_cast_double": f"""WITH {TEXT} SELECT utc_timestamp, cet_cest_timestamp,
          {", ".join(f"CAST({name} AS DOUBLE) AS {name}" for name in SOURCE_NAMES.values())} FROM texts""",
        "parse_timestamps": f"""WITH {HOURLY} SELECT utc_timestamp, utc_timestamp AS cet_cest_timestamp
          FROM hourly""",
        "derive_year_month": f"WITH {HOURLY} SELECT *, {_YM} FROM hourly",
        "filter_month": f"""WITH {HOURLY} SELECT * FROM hourly
          WHERE strftime(utc_timestamp, '%Y-%m') = '{FIRST_OPEN_MONTH}'""",
        "dedupe_latest": f"""WITH {ORDERS} SELECT * EXCLUDE (place) FROM (SELECT *,
          strftime(utc_ts, '%Y-%m') AS batch_id,
          row_number() OVER (PARTITION BY utc_ts ORDER BY seq DESC) AS place FROM stamped) WHERE place = 1""",
        "null_profile": f"WITH {HOURLY} {_nulls('hourly', MEASURES)}",
        "null_profile_events": f"""WITH per_hour AS (SELECT date_trunc('hour', ts) AS h,
          {", ".join(f"sum(CASE WHEN event_type = '{t}' THEN value END) AS ev_{t}" for t in EVENT_TYPES)}
          FROM events GROUP BY 1) {_nulls("per_hour", [f"ev_{t}" for t in EVENT_TYPES])}""",
        "batch_row_counts": f"""WITH {ORDERS} SELECT strftime(utc_ts, '%Y-%m') AS batch_id, CAST(count(*) AS INTEGER) AS rows_bronze,
          CAST(count(DISTINCT utc_ts) AS INTEGER) AS rows_silver FROM stamped GROUP BY 1""",
        "write_partitioned": f"WITH {HOURLY} SELECT *, {_YM} FROM hourly",
        "bronze_batch": f"""WITH {TEXT} SELECT utc_timestamp, cet_cest_timestamp, {_SOURCE}, batch_id,
          TIMESTAMP '{RUN_TIME}' AS ingestion_timestamp FROM texts""",
        "silver_batch": f"""WITH {HOURLY} SELECT utc_timestamp, utc_timestamp AS cet_cest_timestamp, {_TYPED},
          strftime(utc_timestamp, '%Y-%m') AS batch_id, TIMESTAMP '{RUN_TIME}' AS ingestion_timestamp, {_YM}
          FROM hourly""",
        "daily_load": f"WITH {DAILY} SELECT * FROM load",
        "daily_generation": f"""WITH {DAILY} SELECT event_date, de_solar_generation_mwh, de_wind_generation_mwh
          FROM generation""",
        "daily_generation_zones": f"WITH {DAILY} SELECT * FROM generation",
        "daily_share": f"WITH {DAILY} SELECT * FROM share",
        "join_inner_daily": f"WITH {DAILY} SELECT * FROM share",
        "merge_upsert_bronze": f"""WITH {REPORTS} SELECT strftime(utc_ts, '%Y-%m-%dT%H:%M:%SZ') AS utc_timestamp,
          seq, value, strftime(utc_ts, '%Y-%m') AS batch_id FROM merged""",
        "merge_upsert_silver": upserted,
        "merge_upsert_gold": f"""WITH {REPORTS},
          target AS (SELECT {_REPORTED_DAY} FROM (SELECT utc_ts, o_totalprice AS value FROM stamped) GROUP BY 1),
          source AS (SELECT {_REPORTED_DAY} FROM items GROUP BY 1)
          SELECT * FROM source UNION ALL
          SELECT * FROM target WHERE event_date NOT IN (SELECT event_date FROM source)""",
        "create_or_merge": f"""WITH {REPORTS}
          SELECT 'created' AS step, utc_ts AS utc_timestamp, seq, value FROM old UNION ALL
          SELECT 'merged' AS step, utc_ts AS utc_timestamp, seq, value FROM merged""",
        "rerun_idempotent": upserted,
        "merge_update_conditional": _changed(
            f"status = 'in_progress' AND batch_id >= '{FIRST_OPEN_MONTH}'",
            status="'completed'",
            updated_at=f"TIMESTAMP '{RUN_TIME}'",
            error_message="NULL",
        ),
        "delete_by_key": f"WITH {CONTROL} SELECT * FROM control WHERE batch_id <> '{FIRST_OPEN_MONTH}'",
        "list_batches": f"WITH {CONTROL} {_LISTED}",
        "completed_batches": f"WITH {CONTROL} SELECT batch_id FROM control WHERE status = 'completed'",
        "pending_batches": f"WITH {CONTROL} {_LISTED} WHERE {_OPEN}",
        "next_batch": f"WITH {CONTROL} {_LISTED} WHERE {_OPEN} ORDER BY batch_id LIMIT 1",
        "control_begin": f"""WITH {CONTROL} SELECT * REPLACE (CAST(rows_bronze AS DOUBLE) AS rows_bronze,
          CAST(rows_silver AS DOUBLE) AS rows_silver) FROM control WHERE batch_id NOT IN ('{FIRST_OPEN_MONTH}', '1997-03')
          UNION ALL {_started(FIRST_OPEN_MONTH)} UNION ALL {_started("1997-03")}""",
        "control_record_counts": f"""WITH {CONTROL} SELECT control.* REPLACE (
          CAST(n AS INTEGER) AS rows_bronze, CAST(hours AS INTEGER) AS rows_silver,
          TIMESTAMP '{RUN_TIME}' AS updated_at) FROM control JOIN months USING (batch_id)""",
        "control_lifecycle": f"""WITH {CONTROL} SELECT batch_id, year, month,
          CASE WHEN batch_id = '{FIRST_OPEN_MONTH}' THEN 'failed' ELSE 'completed' END AS status, rows_bronze, rows_silver,
          created_at, TIMESTAMP '{RUN_TIME}' AS updated_at,
          CASE WHEN batch_id = '{FIRST_OPEN_MONTH}' THEN '{kept_text}' END AS error_message FROM control""",
        "control_fail": _changed(
            f"batch_id = '{UNFINISHED_MONTH}'",
            status="'failed'",
            updated_at=f"TIMESTAMP '{RUN_TIME}'",
            error_message=f"'{kept_text}'",
        ),
        "control_complete": _changed(
            f"batch_id = '{UNFINISHED_MONTH}'",
            status="'completed'",
            updated_at=f"TIMESTAMP '{RUN_TIME}'",
            error_message="NULL",
        ),
        "q01_recent_load": f"""WITH {DAILY} SELECT event_date, de_load_actual_mwh, de_load_forecast_mwh,
          de_forecast_error_mwh FROM load ORDER BY event_date DESC LIMIT 30""",
        "q02_monthly_load": f"""WITH {DAILY} SELECT {MONTH}, round(sum(de_load_actual_mwh), 2) AS monthly_load_mwh,
          {_mean("de_load_actual_mwh")} AS average_daily_load_mwh FROM load GROUP BY 1""",
        "q03_forecast_accuracy": f"""WITH {DAILY} SELECT {MONTH},
          {_mean("abs(de_forecast_error_mwh)")} AS mean_absolute_error_mwh,
          round(avg(abs(de_forecast_error_mwh) / nullif(de_load_actual_mwh, 0)) * 100, 2)
            AS mean_absolute_percentage_error FROM load GROUP BY 1""",
        "q04_share_trend": f"WITH {DAILY} SELECT event_date, wind_solar_share_percent FROM share",
        "q05_top_days": f"""WITH {DAILY} SELECT * FROM share WHERE wind_solar_share_percent IS NOT NULL
          ORDER BY wind_solar_share_percent DESC, event_date LIMIT 10""",
        "q06_monthly_generation": f"""WITH {DAILY} SELECT {MONTH},
          round(sum(de_solar_generation_mwh), 2) AS solar_generation_mwh,
          round(sum(de_wind_generation_mwh), 2) AS wind_generation_mwh,
          round(sum(de_solar_generation_mwh) + sum(de_wind_generation_mwh), 2) AS total_renewable_generation_mwh
          FROM generation GROUP BY 1""",
        "q07_contribution": f"""WITH {DAILY}, t AS (SELECT sum(de_solar_generation_mwh) AS s,
          sum(de_wind_generation_mwh) AS w FROM generation)
          SELECT round(s, 2) AS solar_generation_mwh, round(w, 2) AS wind_generation_mwh,
          round(s / nullif(s + w, 0) * 100, 2) AS solar_percent, round(w / nullif(s + w, 0) * 100, 2) AS wind_percent
          FROM t""",
        "q08_yearly_progress": f"""WITH {DAILY} SELECT CAST(year(event_date) AS INTEGER) AS year,
          {_mean("wind_solar_share_percent")} AS average_wind_solar_share_percent,
          round(max(wind_solar_share_percent), 2) AS maximum_wind_solar_share_percent,
          round(sum(de_wind_solar_generation_mwh), 2) AS wind_solar_generation_mwh FROM share GROUP BY 1""",
        "q09_seasonal_load": f"""WITH {DAILY} SELECT
          ['Winter', 'Spring', 'Summer', 'Autumn'][(month(event_date) % 12) // 3 + 1] AS season,
          {_mean("de_load_actual_mwh")} AS average_daily_load_mwh FROM load GROUP BY 1""",
        "q10_monthly_summary": f"""WITH {DAILY},
          a AS (SELECT {MONTH}, round(sum(de_load_actual_mwh), 2) AS load_mwh,
            {_mean("abs(de_forecast_error_mwh)")} AS mean_absolute_forecast_error_mwh FROM load GROUP BY 1),
          b AS (SELECT {MONTH}, round(sum(de_solar_generation_mwh), 2) AS solar_mwh,
            round(sum(de_wind_generation_mwh), 2) AS wind_mwh FROM generation GROUP BY 1),
          c AS (SELECT {MONTH}, {_mean("wind_solar_share_percent")} AS wind_solar_share_percent
            FROM share GROUP BY 1)
          SELECT * FROM a JOIN b USING (month) JOIN c USING (month)""",
        "v1_control_history": f"WITH {CONTROL} {_DONE}",
        "v2_bronze_counts": f"""WITH {HOURLY} SELECT strftime(utc_timestamp, '%Y-%m') AS batch_id,
          count(*) AS row_count FROM hourly GROUP BY 1""",
        "v3_silver_counts": f"WITH {HOURLY} SELECT {_YM}, count(*) AS row_count FROM hourly GROUP BY 1, 2",
        "v4_share_preview": f"WITH {DAILY} SELECT * FROM share ORDER BY event_date LIMIT 20",
        "run_one_batch": f"{daily_all} WHERE strftime(event_date, '%Y-%m') = '{FIRST_OPEN_MONTH}'",
        "run_all_batches": daily_all,
        "catalog_control_history": f"WITH {CONTROL} {_DONE}",
        "run_quarantine": f"""WITH {CONTROL}, {DAILY.removeprefix(ORDERS).lstrip(",")},
          days AS (SELECT strftime(event_date, '%Y-%m') AS batch_id, count(*) AS days FROM load GROUP BY 1)
          SELECT batch_id, CASE WHEN batch_id IN {DAMAGED_MONTHS} THEN 'failed' ELSE 'completed' END AS status,
            CASE WHEN batch_id IN {DAMAGED_MONTHS} THEN 0 ELSE days END AS days FROM months JOIN days USING (batch_id)""",
        "inventory_months": f"""WITH {CONTROL} SELECT batch_id, CAST(batch_id[1:4] AS INTEGER) AS year,
          CAST(batch_id[6:7] AS INTEGER) AS month, CAST(batch_id[1:4] AS INTEGER) AS first_folder,
          CAST(batch_id[1:4] AS INTEGER) AS last_folder, hours AS rows FROM months""",
        "merge_evolve": f"""WITH {REPORTS}, both_kinds AS (
          SELECT *, CAST(2 AS BIGINT) AS kind, 'item' AS note FROM new UNION ALL
          SELECT *, CAST(1 AS BIGINT) AS kind, NULL AS note FROM old WHERE utc_ts NOT IN (SELECT utc_ts FROM new))
          SELECT utc_ts AS utc_timestamp, seq, value, CAST(year(utc_ts) AS INTEGER) AS year,
          CAST(month(utc_ts) AS INTEGER) AS month, kind, note FROM both_kinds""",
    }
    return told | {"catalog_monthly_summary": told["q10_monthly_summary"]}
