"""Series-shaped inputs derived from the generated tables (see FIXTURES.md, part B)."""

from __future__ import annotations

import atexit
import functools
import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from hourmill import Lake, Landing, run_pending
from hourmill.functions import month_tag
from hourmill.plans import control

NATIONAL = {
    "de_load_actual_entsoe_transparency": "o_orderstatus <> 'P'",
    "de_load_forecast_entsoe_transparency": "o_orderstatus <> 'F'",
    "de_lu_load_actual_entsoe_transparency": "o_orderstatus <> 'P' AND o_custkey % 2 = 0",
    "de_lu_load_forecast_entsoe_transparency": "o_orderstatus <> 'F' AND o_custkey % 2 = 0",
    "de_solar_generation_actual": "o_orderpriority = '1-URGENT'",
    "de_wind_onshore_generation_actual": "o_orderpriority = '2-HIGH'",
    "de_wind_offshore_generation_actual": "o_orderpriority = '3-MEDIUM'",
}
ZONE_KINDS = {
    "50hertz": ("solar", "wind_onshore", "wind_offshore"),
    "amprion": ("solar", "wind_onshore"),
    "tennet": ("solar", "wind_onshore", "wind_offshore"),
    "transnetbw": ("wind_onshore",),
}
MEASURES = NATIONAL | {
    f"de_{zone}_{kind}_generation_actual": f"{NATIONAL[f'de_{kind}_generation_actual']} AND o_custkey % 4 = {i}"
    for i, (zone, kinds) in enumerate(ZONE_KINDS.items())
    for kind in kinds
}
# Source spelling: upper-case area prefix, the rest as it is.
SOURCE_NAMES = {m: m.replace("de_lu_", "DE_LU_").replace("de_", "DE_", 1) for m in MEASURES}
EVENT_TYPES = ("click", "error", "purchase", "signup", "view")

FIRST_OPEN_MONTH = "1997-01"
UNFINISHED_MONTH = "1997-02"
DAMAGED_MONTHS = ("1994-03", "1996-11")
SETUP_TIME = "2024-01-01 00:00:00"
RUN_TIME = "2024-02-01 12:30:00"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def new_folder(spark: SparkSession) -> str:
    """A fresh folder in the shared place the session names; a local one for local sessions without it."""
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if shared is None:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        shared = _own_folder()
    return f"{shared.rstrip('/')}/hourmill-checks/{uuid.uuid4().hex}"


@functools.cache
def _own_folder() -> str:
    """A folder of this process, which goes when it ends."""
    folder = tempfile.TemporaryDirectory(prefix="hourmill-checks-", ignore_cleanup_errors=True)
    atexit.register(folder.cleanup)
    return folder.name


def _hour(day: str, number: str) -> Column:
    hours = F.make_interval(hours=(F.col(number) % 24).cast("int"))
    return F.col(day).cast("timestamp") + hours


def raw_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """B1: a row per order, several per hour."""
    orders = table(spark, sf_dir, "orders").withColumn("utc_ts", _hour("o_orderdate", "o_orderkey"))
    return orders.select(
        "utc_ts",
        F.col("o_orderkey").alias("seq"),
        month_tag(F.col("utc_ts")).alias("batch_id"),
        "o_totalprice",
        "o_orderstatus",
        "o_orderpriority",
        "o_custkey",
    )


def hourly_wide(spark: SparkSession, sf_dir: str) -> DataFrame:
    """B2: a row per hour with 16 typed measures."""
    sums = [
        F.round(F.sum(F.when(F.expr(condition), F.col("o_totalprice"))), 2).alias(name)
        for name, condition in MEASURES.items()
    ]
    return raw_orders(spark, sf_dir).groupBy(F.col("utc_ts").alias("utc_timestamp")).agg(*sums)


def hourly_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """B2 with the batch, year and month of each hour."""
    hour = F.col("utc_timestamp")
    return hourly_wide(spark, sf_dir).select(
        "*", month_tag(hour).alias("batch_id"), F.year(hour).alias("year"), F.month(hour).alias("month")
    )


def raw_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """B3: source-shaped strings, one out-of-scope column, and the year of the folder."""
    hour = F.col("utc_timestamp")
    texts = [F.col(m).cast("decimal(38,2)").cast("string").alias(name) for m, name in SOURCE_NAMES.items()]
    return hourly_wide(spark, sf_dir).select(
        F.date_format(hour, "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("utc_timestamp"),
        F.concat(F.date_format(hour + F.expr("INTERVAL 1 HOUR"), "yyyy-MM-dd'T'HH:mm:ss"), F.lit("+0100")).alias(
            "cet_cest_timestamp"
        ),
        *texts,
        F.dayofyear(hour).cast("string").alias("FR_load"),
        F.year(hour).alias("year"),
    )


_landings: dict[tuple[str, str], str] = {}
_lakes: dict[tuple[str, str], Lake] = {}


def _landed(spark: SparkSession, rows: DataFrame) -> str:
    folder = new_folder(spark)
    rows.hint("rebalance", "year").write.option("header", True).partitionBy("year").csv(folder)
    return folder


def landing_folder(spark: SparkSession, sf_dir: str) -> str:
    """B3 as CSV files in year folders, written once per application and input."""
    known = (spark.sparkContext.applicationId, sf_dir)
    if known not in _landings:
        _landings[known] = _landed(spark, raw_text(spark, sf_dir))
    return _landings[known]


def lake(spark: SparkSession, sf_dir: str) -> Lake:
    """B7: a lake that holds all months of B3, filled once per application and input."""
    known = (spark.sparkContext.applicationId, sf_dir)
    if known not in _lakes:
        filled = Lake(spark, new_folder(spark))
        run_pending(filled, Landing(spark, landing_folder(spark, sf_dir)), as_of=RUN_TIME)
        _lakes[known] = filled
    return _lakes[known]


def damaged_landing(spark: SparkSession, sf_dir: str) -> Landing:
    """B8: B3 with one measure that is no number in two months."""
    rows = raw_text(spark, sf_dir)
    solar = SOURCE_NAMES["de_solar_generation_actual"]
    hit = F.substring("utc_timestamp", 1, 7).isin(list(DAMAGED_MONTHS))
    return Landing(spark, _landed(spark, rows.withColumn(solar, F.when(hit, F.lit("n/a")).otherwise(F.col(solar)))))


def events_hourly(spark: SparkSession, sf_dir: str) -> DataFrame:
    """B4: a row per hour of the event stream with a summed value per event type."""
    value = [
        F.round(F.sum(F.when(F.col("event_type") == t, F.col("value"))), 2).alias(f"ev_{t}") for t in EVENT_TYPES
    ]
    hour = F.date_trunc("hour", F.col("ts").cast("timestamp")).alias("utc_timestamp")
    return table(spark, sf_dir, "events").groupBy(hour).agg(*value)


def control_rows(spark: SparkSession, sf_dir: str, begun_only: bool = False) -> DataFrame:
    """B5: all months with their counts, completed before 1997-01, which has failed; later ones are unfinished.

    With ``begun_only`` the history ends with 1997-02, so that later months are still to come.
    """
    months = (
        raw_orders(spark, sf_dir)
        .groupBy("batch_id", "utc_ts")
        .agg(F.count(F.lit(1)).alias("n"))
        .groupBy("batch_id")
        .agg(F.sum("n").alias("rows_bronze"), F.count(F.lit(1)).alias("rows_silver"))
    )
    if begun_only:
        months = months.where(F.col("batch_id") <= UNFINISHED_MONTH)
    done = F.col("batch_id") < FIRST_OPEN_MONTH
    failed = F.col("batch_id") == FIRST_OPEN_MONTH
    values = {
        "year": F.split("batch_id", "-")[0],
        "month": F.split("batch_id", "-")[1],
        "status": F.when(done, "completed").when(failed, "failed").otherwise("in_progress"),
        "created_at": F.lit(SETUP_TIME),
        "updated_at": F.lit(SETUP_TIME),
        "error_message": F.when(failed, F.lit("unreadable file")),
    }
    return months.select(
        *[values.get(f.name, F.col(f.name)).cast(f.dataType).alias(f.name) for f in control.SCHEMA.fields]
    )


def order_reports(spark: SparkSession, sf_dir: str) -> DataFrame:
    """B6 target rows: all orders as reports for their hour."""
    return raw_orders(spark, sf_dir).select("utc_ts", "seq", F.col("o_totalprice").alias("value"))


def item_reports(spark: SparkSession, sf_dir: str) -> DataFrame:
    """B6 source rows: all line items as later reports for their hour."""
    return table(spark, sf_dir, "lineitem").select(
        _hour("l_shipdate", "l_orderkey").alias("utc_ts"),
        (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("seq"),
        F.col("l_extendedprice").alias("value"),
    )
