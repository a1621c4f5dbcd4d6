"""The batch control table: one row per attempted month, and the next month to do.

Status goes from ``in_progress`` to ``completed`` or ``failed``. Each transition
takes the whole state and returns the whole new state, for any number of months
at once; the table has one row per month, so it stays small, and each state is stored as
a snapshot of its own. It is meant for one writer at a time.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import at_time, batch_month, batch_year, month_span
from ..operators.mutations import affected_rows, delete_where, merge_update, update_where

# Status names, and how much of an error text is kept.
IN_PROGRESS, COMPLETED, FAILED = "in_progress", "completed", "failed"
ERROR_LENGTH = 500

SCHEMA = T.StructType(
    [
        T.StructField("batch_id", T.StringType()),
        T.StructField("year", T.IntegerType()),
        T.StructField("month", T.IntegerType()),
        T.StructField("status", T.StringType()),
        T.StructField("rows_bronze", T.IntegerType()),
        T.StructField("rows_silver", T.IntegerType()),
        T.StructField("created_at", T.TimestampType()),
        T.StructField("updated_at", T.TimestampType()),
        T.StructField("error_message", T.StringType()),
    ]
)

When = Column | datetime | str | None


def empty(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], SCHEMA)


def _listed(spark: SparkSession, batches: Sequence[str]) -> DataFrame:
    if not batches:
        raise ValueError("at least one batch is required")
    for b in batches:
        month_span(b)
    return spark.createDataFrame([(b,) for b in dict.fromkeys(batches)], "batch_id string")


def begin(control: DataFrame, batches: Sequence[str], as_of: When = None) -> DataFrame:
    """Start attempts: earlier rows of the months give way to fresh ``in_progress`` rows."""
    fresh = {
        "year": batch_year(F.col("batch_id")),
        "month": batch_month(F.col("batch_id")),
        "status": F.lit(IN_PROGRESS),
        "created_at": at_time(as_of),
        "updated_at": at_time(as_of),
    }
    started = _listed(control.sparkSession, batches).select(
        *[
            (F.col(f.name) if f.name == "batch_id" else fresh.get(f.name, F.lit(None)).cast(f.dataType)).alias(f.name)
            for f in SCHEMA.fields
        ]
    )
    return delete_where(control, F.col("batch_id").isin(list(batches))).unionByName(started)


def record_counts(control: DataFrame, counts: DataFrame, as_of: When = None) -> DataFrame:
    """Store ``rows_bronze`` and ``rows_silver`` per ``batch_id``; the status stays."""
    return merge_update(
        control,
        counts,
        ["batch_id"],
        {
            "rows_bronze": F.col("source.rows_bronze").cast("int"),
            "rows_silver": F.col("source.rows_silver").cast("int"),
            "updated_at": at_time(as_of),
        },
    )


def fail(control: DataFrame, batches: Sequence[str], message: str, as_of: When = None) -> DataFrame:
    """Mark months failed, with the error text less its single quotes, cut to 500 characters."""
    text = F.substring(F.regexp_replace(F.lit(message), "'", ""), 1, ERROR_LENGTH)
    return update_where(
        control,
        F.col("batch_id").isin(list(batches)),
        {"status": F.lit(FAILED), "updated_at": at_time(as_of), "error_message": text},
    )


def fail_each(control: DataFrame, messages: dict[str, str], as_of: When = None) -> DataFrame:
    """Mark months failed, each with its own error text, cut as in :func:`fail`."""
    told = control.sparkSession.createDataFrame(list(messages.items()), "batch_id string, message string")
    text = F.substring(F.regexp_replace(F.col("source.message"), "'", ""), 1, ERROR_LENGTH)
    return merge_update(
        control, told, ["batch_id"], {"status": F.lit(FAILED), "updated_at": at_time(as_of), "error_message": text}
    )


def _in_progress() -> Column:
    return F.col("target.status") == IN_PROGRESS


def complete(control: DataFrame, batches: Sequence[str], as_of: When = None) -> DataFrame:
    """Mark months completed that are in progress; other months are left alone, none is added."""
    done = _listed(control.sparkSession, batches).select(
        "batch_id", F.lit(COMPLETED).alias("status"), at_time(as_of).alias("updated_at")
    )
    return merge_update(
        control,
        done,
        ["batch_id"],
        {
            "status": F.col("source.status"),
            "updated_at": F.col("source.updated_at"),
            "error_message": F.lit(None).cast("string"),
        },
        _in_progress(),
    )


def completable(control: DataFrame, batches: Sequence[str]) -> DataFrame:
    """The rows that :func:`complete` would change."""
    return affected_rows(control, _listed(control.sparkSession, batches), ["batch_id"], _in_progress())


def completed_batches(control: DataFrame) -> DataFrame:
    return control.where(F.col("status") == COMPLETED).select("batch_id")


def pending_batches(listed: DataFrame, control: DataFrame) -> DataFrame:
    """Months of the source that are not completed; failed and unfinished ones stay eligible."""
    return listed.join(completed_batches(control), "batch_id", "left_anti")


def next_batch(listed: DataFrame, control: DataFrame) -> DataFrame:
    """The earliest pending month: one row, or none when all is done."""
    return pending_batches(listed, control).orderBy("year", "month").limit(1)


def history(control: DataFrame) -> DataFrame:
    return control.orderBy("year", "month")
