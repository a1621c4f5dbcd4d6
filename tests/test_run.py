"""Whole runs over small landing areas: retries, late rows, order of months, views."""

import datetime

import pytest

from hourmill import FailedBatches, GenerationArea, Lake, Landing, LoadArea, SeriesSpec, TableNames, analytics
from hourmill import reports, run_batch, run_pending
from hourmill.plans.run import aggregate_gold, ingest_bronze, transform_silver

MEASURES = [
    "DE_load_actual_entsoe_transparency",
    "DE_load_forecast_entsoe_transparency",
    "DE_LU_load_actual_entsoe_transparency",
    "DE_LU_load_forecast_entsoe_transparency",
    "DE_solar_generation_actual",
    "DE_wind_onshore_generation_actual",
    "DE_wind_offshore_generation_actual",
    "DE_tennet_solar_generation_actual",
]
HEADER = ",".join(["utc_timestamp", "cet_cest_timestamp", *MEASURES, "FR_load"])


def line(utc, load, solar="1.0"):
    local = datetime.datetime.fromisoformat(utc.removesuffix("Z")) + datetime.timedelta(hours=1)
    return ",".join([utc, local.isoformat() + "+0100", str(load), "10", "5", "5", solar, "2", "", "1", "9"])


@pytest.fixture
def land(spark, tmp_path):
    def put(year, *lines, name="a.csv"):
        folder = tmp_path / "landing" / f"year={year}"
        folder.mkdir(parents=True, exist_ok=True)
        (folder / name).write_text("\n".join([HEADER, *lines]) + "\n")
        return Landing(spark, str(tmp_path / "landing"))

    return put


@pytest.fixture
def lake(spark, tmp_path):
    return Lake(spark, str(tmp_path / "lake"))


def hours_2018_2019(land):
    land(2018, line("2018-12-31T22:00:00Z", 20))
    return land(
        2019,
        line("2018-12-31T23:00:00Z", 21),
        line("2019-01-01T00:00:00Z", 22),
        line("2019-01-31T23:00:00Z", 23),
        line("2019-02-01T00:00:00Z", 24, solar=""),
    )


def snapshot(lake):
    def rows(table, *drop):
        return sorted((tuple(r) for r in table.read().drop(*drop).collect()), key=repr)

    return [
        rows(lake.bronze, "ingestion_timestamp"),
        rows(lake.silver, "ingestion_timestamp"),
        rows(lake.load),
        rows(lake.generation),
        rows(lake.share),
    ]


def status(lake):
    return {r.batch_id: (r.status, r.rows_bronze, r.rows_silver) for r in lake.control_state().collect()}


def test_month_by_month_in_any_order_equals_all_at_once(spark, land, lake, tmp_path):
    landing = hours_2018_2019(land)
    seen = []
    while (report := run_batch(lake, landing)) is not None:
        seen.append((report.batches, report.rows_bronze, report.completed))
    assert seen == [
        (("2018-12",), {"2018-12": 2}, 1), (("2019-01",), {"2019-01": 2}, 1), (("2019-02",), {"2019-02": 1}, 1),
    ]
    assert status(lake) == {
        "2018-12": ("completed", 2, 2), "2019-01": ("completed", 2, 2), "2019-02": ("completed", 1, 1),
    }
    other = Lake(spark, str(tmp_path / "other"))
    report = run_pending(other, landing)
    assert report.rows_silver == {"2018-12": 2, "2019-01": 2, "2019-02": 1} and report.completed == 3
    assert report.nulls["de_solar_generation_actual"] == 1
    assert report.nulls["de_wind_offshore_generation_actual"] == 5
    assert run_pending(other, landing) is None
    assert snapshot(other) == snapshot(lake) and status(other) == status(lake)
    backwards = Lake(spark, str(tmp_path / "backwards"))
    for month in ("2019-02", "2019-01", "2018-12"):
        run_batch(backwards, landing, month)
    assert snapshot(backwards) == snapshot(lake)


def test_table_columns(spark, land, lake):
    run_pending(lake, hours_2018_2019(land))
    times = ["utc_timestamp", "cet_cest_timestamp"]
    lower = [m.lower() for m in MEASURES]
    assert lake.bronze.read().columns == [*times, *MEASURES, "source_file", "batch_id", "ingestion_timestamp"]
    assert lake.silver.read().columns == [
        *times, *lower, "source_file", "batch_id", "ingestion_timestamp", "year", "month",
    ]
    assert lake.generation.read().columns == [
        "event_date", "de_solar_generation_mwh", "de_wind_generation_mwh", "tennet_solar_generation_mwh",
    ]
    assert dict(lake.bronze.read().dtypes)["batch_id"] == "string"


def test_a_rerun_takes_corrections_and_keeps_hours_that_are_gone(spark, land, lake):
    run_pending(lake, hours_2018_2019(land))
    landing = land(2019, line("2018-12-31T23:00:00Z", 21), line("2019-01-01T00:00:00Z", 99.5))
    assert run_batch(lake, landing) is None
    report = run_batch(lake, landing, "2019-01")
    assert report.rows_bronze == {"2019-01": 1} and report.rows_silver == {"2019-01": 2}
    loads = {str(r.event_date): r.de_load_actual_mwh for r in lake.load.read().collect()}
    assert loads == {"2018-12-31": 41.0, "2019-01-01": 99.5, "2019-01-31": 23.0, "2019-02-01": 24.0}


def test_repeated_hours_stay_in_bronze_and_are_settled_in_silver(spark, land, lake):
    land(2019, line("2019-01-01T00:00:00Z", 1))
    landing = land(2019, line("2019-01-01T00:00:00Z", 2), name="b.csv")
    for _ in range(2):
        report = run_batch(lake, landing, "2019-01")
        assert report.rows_bronze == {"2019-01": 2} and report.rows_silver == {"2019-01": 1}
        assert lake.bronze.read().count() == 2
        assert [r.de_load_actual_entsoe_transparency for r in lake.silver.read().collect()] == [2.0]


def test_a_failing_month_is_marked_and_can_be_retried(spark, land, lake):
    landing = land(2019, line("2019-01-01T00:00:00Z", "oops"))
    with pytest.raises(FailedBatches):
        run_batch(lake, landing)
    (row,) = lake.control_state().collect()
    assert row.status == "failed" and "oops" in row.error_message and "'" not in row.error_message
    assert not lake.silver.exists()
    run_batch(lake, land(2019, line("2019-01-01T00:00:00Z", 3)))
    assert status(lake) == {"2019-01": ("completed", 1, 1)}
    assert lake.control_state().collect()[0].error_message is None


def test_lenient_runs_turn_malformed_values_into_nulls(spark, land, lake):
    landing = land(2019, line("2019-01-01T00:00:00Z", "oops"), line("2019-01-01T01:00:00Z", 3))
    report = run_batch(lake, landing, on_error="null")
    assert report.nulls["de_load_actual_entsoe_transparency"] == 1
    assert [r.de_load_actual_mwh for r in lake.load.read().collect()] == [3.0]


def test_a_gold_failure_leaves_the_month_in_progress(spark, land, lake, monkeypatch):
    landing = hours_2018_2019(land)

    def broken(*_):
        raise RuntimeError("gold")

    monkeypatch.setattr("hourmill.plans.run.aggregate_gold", broken)
    with pytest.raises(RuntimeError):
        run_batch(lake, landing)
    assert status(lake) == {"2018-12": ("in_progress", 2, 2)}
    monkeypatch.undo()
    assert run_batch(lake, landing).batches == ("2018-12",)
    assert status(lake) == {"2018-12": ("completed", 2, 2)}


def test_a_month_without_rows(spark, land, lake):
    landing = hours_2018_2019(land)
    with pytest.raises(ValueError, match="2017-05"):
        run_batch(lake, landing, "2017-05")
    assert status(lake) == {"2017-05": ("in_progress", 0, 0)}
    run_batch(lake, landing, "2019-01")
    assert ingest_bronze(lake, landing.scan(lineage=True), ["2017-05"]) == ({"2017-05": 0}, {})
    assert transform_silver(lake, ["2017-05"])[0] == {"2017-05": 0}
    with pytest.raises(ValueError, match="2017-05"):
        aggregate_gold(lake, ["2019-01", "2017-05"])


def test_tables_can_be_queried_by_name(spark, land, lake):
    run_pending(lake, hours_2018_2019(land))
    lake.register_views()
    total = spark.sql(
        "SELECT round(sum(de_load_actual_mwh), 2) AS mwh FROM daily_load_summary JOIN daily_wind_solar_share "
        "USING (event_date, de_load_actual_mwh)"
    ).collect()
    assert [r.mwh for r in total] == [110.0]
    assert [r.row_count for r in analytics.rows_per_batch(spark.table("germany_energy_raw")).collect()] == [2, 2, 1]
    assert [r.row_count for r in analytics.rows_per_month(spark.table("germany_energy_clean")).collect()] == [2, 2, 1]
    assert spark.table("batch_control").count() == 3


def test_one_bad_month_leaves_the_others_complete(lake, land):
    landing = land(
        2019,
        line("2019-01-01T00:00:00Z", 22),
        line("2019-02-01T00:00:00Z", "bad"),
        line("2019-03-01T00:00:00Z", 24),
    )
    with pytest.raises(FailedBatches):
        run_pending(lake, landing)
    status = {r.batch_id: r.status for r in lake.control_state().collect()}
    assert status == {"2019-01": "completed", "2019-02": "failed", "2019-03": "completed"}


def test_bad_months_are_set_aside_by_the_pass_that_loads_the_others(spark, land, lake, monkeypatch):
    for month in range(1, 7):
        bad = month in (2, 5)
        landing = land(2019, line(f"2019-0{month}-01T00:00:00Z", f"bad{month}" if bad else 20), line(f"2019-0{month}-02T00:00:00Z", 30), name=f"{month}.csv")
    scans = []
    read = Landing.read
    monkeypatch.setattr(Landing, "read", lambda self, h, p: (scans.append(len(p)), read(self, h, p))[1])
    with pytest.raises(FailedBatches) as failed:
        run_pending(lake, landing)
    assert scans == [6, 6]  # one look at the keys of new files, one load
    assert set(failed.value.reasons) == {"2019-02", "2019-05"} and "bad5" in failed.value.reasons["2019-05"]
    rows = {r.batch_id: r for r in lake.control_state().collect()}
    assert {b: r.status for b, r in rows.items()} == {
        f"2019-0{m}": "failed" if m in (2, 5) else "completed" for m in range(1, 7)
    }
    assert "bad2" in rows["2019-02"].error_message and rows["2019-02"].rows_silver is None and rows["2019-01"].rows_silver == 2
    assert sorted({r.event_date.month for r in lake.load.read().collect()}) == [1, 3, 4, 6]
    scans.clear()
    land(2019, line("2019-02-01T00:00:00Z", 1), name="2.csv")
    land(2019, line("2019-05-01T00:00:00Z", 1), name="5.csv")
    assert run_pending(lake, landing).batches == ("2019-02", "2019-05") and scans == [2, 2]
    assert run_pending(lake, landing) is None and scans == [2, 2]


def test_a_key_that_is_no_time(land, lake):
    landing = land(2019, line("2019-01-01T00:00:00Z", 1), line("2019-01-01T01:00:00Z", 1).replace("2019-01-01T01:00:00Z", "noon"))
    with pytest.raises(ValueError, match="1 rows of .*a.csv have a utc_timestamp that is no time"):
        run_batch(lake, landing)
    assert run_batch(lake, landing, on_error="null").rows_bronze == {"2019-01": 1}


def test_measures_that_come_later(spark, land, tmp_path):
    land(2018, line("2018-12-01T00:00:00Z", 1))
    folder = tmp_path / "landing" / "year=2019"
    folder.mkdir()
    (folder / "a.csv").write_text(f"{HEADER},DE_amprion_solar_generation_actual\n{line('2019-01-01T00:00:00Z', 2)},7\n")
    landing = Landing(spark, str(tmp_path / "landing"))
    lake = Lake(spark, str(tmp_path / "grown"), evolve=True)
    early = land(2018, line("2018-12-01T00:00:00Z", 1))
    (folder / "a.csv").rename(tmp_path / "later.csv")
    run_pending(lake, early)
    (tmp_path / "later.csv").rename(folder / "a.csv")
    run_pending(lake, landing)
    name = "de_amprion_solar_generation_actual"
    assert {r.batch_id: r[name] for r in lake.silver.read().collect()} == {"2018-12": None, "2019-01": 7.0}
    assert {str(r.event_date): r.amprion_solar_generation_mwh for r in lake.generation.read().collect()} == {
        "2018-12-01": None, "2019-01-01": 7.0,
    }


def test_reports_by_sql_equal_the_dataframe_ones(spark, land, lake):
    run_pending(lake, hours_2018_2019(land))
    lake.register_tables("reports_test")
    load, generation, share = (t.read() for t in (lake.load, lake.generation, lake.share))
    frames = {
        "q01_recent_load": analytics.recent_load(load), "q02_monthly_load": analytics.monthly_load(load),
        "q03_forecast_accuracy": analytics.forecast_accuracy(load), "q04_share_trend": analytics.share_trend(share),
        "q05_top_days": analytics.top_days(share), "q06_monthly_generation": analytics.monthly_generation(generation),
        "q07_contribution": analytics.contribution(generation), "q08_yearly_progress": analytics.yearly_progress(share),
        "q09_seasonal_load": analytics.seasonal_load(load), "q10_monthly_summary": analytics.monthly_summary(load, generation, share),
        "v2_bronze_counts": analytics.rows_per_batch(lake.bronze.read()), "v3_silver_counts": analytics.rows_per_month(lake.silver.read()),
        "v4_share_preview": analytics.share_preview(share), "v1_control_history": lake.control_state().orderBy("year", "month"),
    }
    assert frames.keys() == reports.statements().keys()
    for name, frame in frames.items():
        for stored in (lake.report(name), lake.report(name, "reports_test")):
            assert [tuple(r) for r in stored.collect()] == [tuple(r) for r in frame.collect()], name
            assert stored.columns == frame.columns, name
    plan = lake.report("q10_monthly_summary", "reports_test")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan parquet") == 3
    spark.sql("DROP DATABASE reports_test CASCADE")


def test_another_spec_names_tables_and_reports(spark, tmp_path):
    other = SeriesSpec(
        prefix="AT_",
        load=(LoadArea("at_load", "at_forecast", "at_mwh", "at_planned_mwh", "at_miss_mwh"),),
        national=GenerationArea("at_sun", ("at_wind",), "at_sun_mwh", "at_wind_mwh"),
        zones=(),
        daily_renewable="at_renewable_mwh",
        daily_share="at_share",
        tables=TableNames(bronze="at_raw", load="at_daily", control="at_months"),
    )
    folder = tmp_path / "landing" / "year=2019"
    folder.mkdir(parents=True)
    lines = ["utc_timestamp,cet_cest_timestamp,AT_load,AT_forecast,AT_sun,AT_wind"]
    lines += [f"2019-0{m}-01T00:00:00Z,2019-0{m}-01T01:00:00+0100,{m * 10},8,1,2" for m in (1, 2, 7)]
    (folder / "a.csv").write_text("\n".join(lines) + "\n")
    lake = Lake(spark, str(tmp_path / "lake"), other)
    assert run_pending(lake, Landing(spark, str(tmp_path / "landing"))).completed == 3
    assert lake.load.path.endswith("gold/at_daily") and lake.control.path.endswith("at_months")
    recent = lake.report("q01_recent_load")
    assert recent.columns == ["event_date", "at_mwh", "at_planned_mwh", "at_miss_mwh"]
    assert [r.at_miss_mwh for r in recent.collect()] == [62.0, 12.0, 2.0]
    assert [tuple(r)[1:] for r in lake.report("q10_monthly_summary").select("month", "load_mwh", "at_share").collect()] == [
        (10.0, 30.0), (20.0, 15.0), (70.0, 4.29),
    ]
    assert {r.season: r.average_daily_load_mwh for r in lake.report("q09_seasonal_load").collect()} == {"Winter": 15.0, "Summer": 70.0}
    lake.register_views()
    assert spark.table("at_months").count() == 3
