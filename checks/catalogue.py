"""The registered queries: each runs one operator or report on inputs derived from the test tables."""

from __future__ import annotations

import contextlib
from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hourmill import GERMAN_POWER, FailedBatches, Lake, Landing, MonthTable, SnapshotTable, bronze_batch, control, reports
from hourmill import run_batch, run_pending, silver_batch
from hourmill.operators import (
    bulk_cast_double,
    daily_totals,
    dedupe_latest,
    delete_where,
    derive_year_month,
    filter_month,
    generation_summary,
    list_batches,
    load_summary,
    merge_update,
    normalize_names,
    null_profile,
    parse_timestamps,
    project_prefix,
    scan_batch,
    share_by_join,
    share_summary,
)

from . import inputs
from .inputs import EVENT_TYPES, FIRST_OPEN_MONTH, MEASURES, RUN_TIME, UNFINISHED_MONTH
from .oracle import failure_text

Query = Callable[[SparkSession, str], DataFrame]
TIMES = GERMAN_POWER.time_columns


# -- CSV landing area -------------------------------------------------------


def _landing(spark: SparkSession, d: str) -> Landing:
    return Landing(spark, inputs.landing_folder(spark, d))


def scan_csv_year(spark, d):
    """Every year folder, each by its own scan."""
    landing = _landing(spark, d)
    years = [r[0] for r in landing.scan().select("year").distinct().orderBy("year").collect()]
    return reduce(DataFrame.unionByName, [landing.scan_year(y) for y in years])


def scan_csv_all_years(spark, d):
    return _landing(spark, d).scan()


def scan_file_lineage(spark, d):
    path = F.col("source_file")
    return (
        _landing(spark, d)
        .scan(lineage=True)
        .groupBy(
            F.regexp_extract(path, "year=([0-9]+)/", 1).cast("int").alias("folder_year"),
            F.regexp_extract(path, "([^.]+)$", 1).alias("file_kind"),
        )
        .agg(F.count(F.lit(1)).alias("row_count"))
    )


def project(spark, d):
    return project_prefix(_landing(spark, d).scan(), GERMAN_POWER.prefix, TIMES)


def cast_double(spark, d):
    return bulk_cast_double(project(spark, d), GERMAN_POWER.prefix)


def parse(spark, d):
    return parse_timestamps(_landing(spark, d).scan()).select(*TIMES)


def bronze(spark, d):
    return bronze_batch(_landing(spark, d).scan(lineage=True), as_of=RUN_TIME)


def silver(spark, d):
    return silver_batch(bronze(spark, d))


# -- tables -----------------------------------------------------------------


def _month_table(spark, keys=("utc_timestamp",)) -> MonthTable:
    folders = {"year": "year(utc_timestamp)", "month": "month(utc_timestamp)"}
    return MonthTable(spark, inputs.new_folder(spark), keys, folders)


def _batch_table(spark) -> MonthTable:
    return MonthTable(
        spark,
        inputs.new_folder(spark),
        ["utc_timestamp"],
        {"batch_id": "date_format(to_timestamp(utc_timestamp), 'yyyy-MM')"},
    )


def scan_one_batch(spark, d):
    hours = inputs.hourly_batches(spark, d)
    stored = _month_table(spark)
    stored.overwrite_folders(hours)
    return scan_batch(stored.read(), FIRST_OPEN_MONTH)


def write_partitioned(spark, d):
    stored = _month_table(spark)
    stored.overwrite_folders(derive_year_month(inputs.hourly_wide(spark, d)))
    return stored.read()


def batch_row_counts(spark, d):
    """Rows per batch that a merge has written to a raw and to a clean table, counted per folder afterwards."""
    raw = inputs.raw_orders(spark, d).withColumnRenamed("utc_ts", "utc_timestamp")
    counts = []
    for rows, name in ((raw, "rows_bronze"), (dedupe_latest(raw, ["utc_timestamp"], ["seq"]), "rows_silver")):
        folders = {"batch_id": "date_format(utc_timestamp, 'yyyy-MM')"}
        table = MonthTable(spark, inputs.new_folder(spark), ["utc_timestamp"], folders, stamped=True)
        table.merge(rows, run=name)
        tags = [r["batch_id"] for r in _months(spark, d).select("batch_id").collect()]
        counts.append(table.rows_of(name, tags).groupBy("batch_id").agg(F.count(F.lit(1)).cast("int").alias(name)))
    return counts[0].join(counts[1], "batch_id")


def _by_hour(reports: DataFrame, as_text: bool = False) -> DataFrame:
    hour = F.date_format("utc_ts", "yyyy-MM-dd'T'HH:mm:ss'Z'") if as_text else F.col("utc_ts")
    return reports.select(hour.alias("utc_timestamp"), "seq", "value")


def _upsert(spark, d, stored: MonthTable, as_text: bool = False, merges: int = 1) -> DataFrame:
    latest = {"on_duplicate": "latest", "latest_by": ["seq"]}
    stored.merge(_by_hour(inputs.order_reports(spark, d), as_text), **latest)
    for _ in range(merges):
        stored.merge(_by_hour(inputs.item_reports(spark, d), as_text), **latest)
    return stored.read()


def upsert_bronze(spark, d):
    return _upsert(spark, d, _batch_table(spark), as_text=True)


def upsert_silver(spark, d):
    return _upsert(spark, d, _month_table(spark))


def upsert_gold(spark, d):
    def per_day(reports: DataFrame) -> DataFrame:
        return reports.groupBy(F.to_date("utc_ts").alias("event_date")).agg(
            F.round(F.sum("value"), 2).alias("reported"), F.count(F.lit(1)).alias("reports")
        )

    month = {"event_month": "date_format(event_date, 'yyyy-MM')"}
    stored = MonthTable(spark, inputs.new_folder(spark), ["event_date"], month, hidden=True)
    stored.merge(per_day(inputs.order_reports(spark, d)), on_duplicate="error")
    stored.merge(per_day(inputs.item_reports(spark, d)), on_duplicate="error")
    return stored.read()


def create_or_merge(spark, d):
    steps = {"created": 0, "merged": 1}
    tables = {step: _upsert(spark, d, _month_table(spark), merges=n) for step, n in steps.items()}
    parts = [t.select(F.lit(step).alias("step"), "utc_timestamp", "seq", "value") for step, t in tables.items()]
    return reduce(DataFrame.unionByName, parts)


def rerun_idempotent(spark, d):
    return _upsert(spark, d, _month_table(spark), merges=2)


def merge_evolve(spark, d):
    """Reports of orders, then of items with a column more and wider amounts of items."""
    folders = {"year": "year(utc_timestamp)", "month": "month(utc_timestamp)"}
    stored = MonthTable(spark, inputs.new_folder(spark), ["utc_timestamp"], folders, evolve=True)
    latest = {"on_duplicate": "latest", "latest_by": ["seq"]}
    stored.merge(_by_hour(inputs.order_reports(spark, d)).withColumn("kind", F.lit(1)), **latest)
    items = _by_hour(inputs.item_reports(spark, d)).withColumns({"kind": F.lit(2).cast("long"), "note": F.lit("item")})
    stored.merge(items, **latest)
    again = MonthTable(spark, stored.path, ["utc_timestamp"], folders, evolve=True)
    return again.read()


# -- daily tables and reports -----------------------------------------------


def _totals(spark, d):
    return daily_totals(inputs.hourly_wide(spark, d))


def _load(spark, d):
    return load_summary(_totals(spark, d))


def _generation(spark, d):
    return generation_summary(_totals(spark, d))


def _national_generation(spark, d):
    return generation_summary(daily_totals(inputs.hourly_wide(spark, d), zones=False), zones=False)


def _share(spark, d):
    return share_summary(_totals(spark, d))


def _report(name: str) -> Query:
    """A report by its SQL over the stored tables of a lake."""
    return lambda spark, d: inputs.lake(spark, d).report(name)


def _catalog_report(name: str) -> Query:
    """The same over external tables in the catalog."""

    def run(spark, d):
        lake = inputs.lake(spark, d)
        database = "checks_" + lake.root.rsplit("/", 1)[1]
        lake.register_tables(database)
        return lake.report(name, database)

    return run


# -- control ----------------------------------------------------------------


def _months(spark, d):
    return list_batches(inputs.raw_orders(spark, d), "utc_ts")


def _shown(rows: DataFrame) -> DataFrame:
    """Control rows with counts as doubles, in which every client can hold an unknown count."""
    return rows.withColumns({c: F.col(c).cast("double") for c in ("rows_bronze", "rows_silver")})


def _finish(spark, d):
    state = inputs.control_rows(spark, d)
    done = state.where(F.col("batch_id") >= FIRST_OPEN_MONTH).select("batch_id", F.lit("completed").alias("status"))
    changed = merge_update(
        state,
        done,
        ["batch_id"],
        {
            "status": F.col("source.status"),
            "updated_at": F.lit(RUN_TIME).cast("timestamp"),
            "error_message": F.lit(None).cast("string"),
        },
        F.col("target.status") == "in_progress",
    )
    return changed


def _record(spark, d):
    rows = inputs.raw_orders(spark, d).groupBy("batch_id", "utc_ts").agg(F.count(F.lit(1)).alias("n"))
    counts = rows.groupBy("batch_id").agg(
        F.sum("n").alias("rows_bronze"), F.count(F.lit(1)).alias("rows_silver")
    )
    return control.record_counts(inputs.control_rows(spark, d), counts, RUN_TIME)


def _control(change: Callable[[DataFrame], DataFrame]) -> Query:
    return lambda spark, d: change(inputs.control_rows(spark, d))


def control_lifecycle(spark, d):
    """A stored control table, made empty; all months begun, counted, and completed or failed, each in a snapshot of its own."""
    table = SnapshotTable(spark, inputs.new_folder(spark), control.SCHEMA)
    table.create()
    months = [r["batch_id"] for r in _months(spark, d).orderBy("year", "month").collect()]
    table.write(control.begin(table.read(), months, inputs.SETUP_TIME))
    raw = inputs.raw_orders(spark, d)
    counts = raw.groupBy("batch_id").agg(
        F.count(F.lit(1)).alias("rows_bronze"), F.count_distinct("utc_ts").alias("rows_silver")
    )
    table.write(control.record_counts(table.read(), counts, RUN_TIME))
    table.write(control.fail_each(table.read(), {FIRST_OPEN_MONTH: failure_text()}, RUN_TIME))
    table.write(control.complete(table.read(), months, RUN_TIME))
    return table.read()


# -- whole runs -------------------------------------------------------------


def _daily_tables(lake: Lake) -> DataFrame:
    share = lake.share.read().drop("de_load_actual_mwh")
    return lake.load.read().join(lake.generation.read(), "event_date").join(share, "event_date")


def run_one_batch(spark, d):
    lake = Lake(spark, inputs.new_folder(spark))
    lake.control.write(inputs.control_rows(spark, d, begun_only=True))
    run_batch(lake, _landing(spark, d), as_of=RUN_TIME)
    return _daily_tables(lake)


def run_all_batches(spark, d):
    lake = Lake(spark, inputs.new_folder(spark))
    run_pending(lake, _landing(spark, d), as_of=RUN_TIME)
    return _daily_tables(lake)


def run_quarantine(spark, d):
    """A backlog with two months that hold values of no type: the others are completed by the same pass."""
    lake = Lake(spark, inputs.new_folder(spark))
    with contextlib.suppress(FailedBatches):  # what failed is in the control table
        run_pending(lake, inputs.damaged_landing(spark, d), as_of=RUN_TIME)
    days = lake.load.read().groupBy(F.date_format("event_date", "yyyy-MM").alias("batch_id")).agg(F.count(F.lit(1)).alias("days"))
    return lake.control_state().join(days, "batch_id", "left").select("batch_id", "status", F.coalesce("days", F.lit(0)).alias("days"))


def inventory_months(spark, d):
    """Months and their rows from a lake's inventory of the landing area, refreshed twice: the second time reads no file."""
    landing = _landing(spark, d)
    inventory = Lake(spark, inputs.new_folder(spark)).inventory(landing)
    inventory.refresh()
    inventory.refresh()
    return inventory.months()


QUERIES: dict[str, Query] = {
    "scan_csv_year": scan_csv_year,
    "scan_csv_all_years": scan_csv_all_years,
    "scan_file_lineage": scan_file_lineage,
    "scan_batch": scan_one_batch,
    "project_prefix": project,
    "normalize_names": lambda s, d: normalize_names(_landing(s, d).scan()),
    "bulk_cast_double": cast_double,
    "parse_timestamps": parse,
    "derive_year_month": lambda s, d: derive_year_month(inputs.hourly_wide(s, d)),
    "filter_month": lambda s, d: filter_month(inputs.hourly_wide(s, d), FIRST_OPEN_MONTH),
    "dedupe_latest": lambda s, d: dedupe_latest(inputs.raw_orders(s, d), ["utc_ts"], ["seq"]),
    "null_profile": lambda s, d: null_profile(inputs.hourly_wide(s, d), list(MEASURES)),
    "null_profile_events": lambda s, d: null_profile(inputs.events_hourly(s, d), [f"ev_{t}" for t in EVENT_TYPES]),
    "batch_row_counts": batch_row_counts,
    "write_partitioned": write_partitioned,
    "bronze_batch": lambda s, d: bronze(s, d).drop("source_file"),
    "silver_batch": lambda s, d: silver(s, d).drop("source_file"),
    "daily_load": _load,
    "daily_generation": _national_generation,
    "daily_generation_zones": _generation,
    "daily_share": _share,
    "join_inner_daily": lambda s, d: share_by_join(_generation(s, d), _load(s, d)),
    "merge_upsert_bronze": upsert_bronze,
    "merge_upsert_silver": upsert_silver,
    "merge_upsert_gold": upsert_gold,
    "create_or_merge": create_or_merge,
    "merge_evolve": merge_evolve,
    "rerun_idempotent": rerun_idempotent,
    "merge_update_conditional": _finish,
    "delete_by_key": _control(lambda c: delete_where(c, F.col("batch_id") == FIRST_OPEN_MONTH)),
    "list_batches": _months,
    "completed_batches": _control(control.completed_batches),
    "pending_batches": lambda s, d: control.pending_batches(_months(s, d), inputs.control_rows(s, d, begun_only=True)),
    "next_batch": lambda s, d: control.next_batch(_months(s, d), inputs.control_rows(s, d, begun_only=True)),
    "control_begin": _control(lambda c: _shown(control.begin(c, [FIRST_OPEN_MONTH, "1997-03"], RUN_TIME))),
    "control_lifecycle": control_lifecycle,
    "control_record_counts": _record,
    "control_fail": _control(lambda c: control.fail(c, [UNFINISHED_MONTH], failure_text(), RUN_TIME)),
    "control_complete": _control(lambda c: control.complete(c, [FIRST_OPEN_MONTH, UNFINISHED_MONTH], RUN_TIME)),
    **{name: _report(name) for name in reports.statements()},
    "catalog_monthly_summary": _catalog_report("q10_monthly_summary"),
    "catalog_control_history": _catalog_report("v1_control_history"),
    "run_one_batch": run_one_batch,
    "run_all_batches": run_all_batches,
    "run_quarantine": run_quarantine,
    "inventory_months": inventory_months,
}
