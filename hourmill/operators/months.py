"""Selecting months (batches) of rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import month_span, month_tag, parse_instant
from ..session import require_utc
from ..spec import GERMAN_POWER


def instant_of(df: DataFrame, column: str, on_error: str = "raise") -> Column:
    """The column as a timestamp; text is parsed with its own offset or ``Z``."""
    kind = df.schema[column].dataType
    if isinstance(kind, T.StringType):
        return parse_instant(F.col(column), on_error=on_error)
    return F.col(column)


def filter_month(df: DataFrame, batch: str, column: str = GERMAN_POWER.key, on_error: str = "raise") -> DataFrame:
    """Rows whose time lies in one month; rows without a time are not in any.

    Typed columns get a plain range, which reaches the Parquet scan. Text is
    parsed once per row.
    """
    require_utc(df)
    first, after = month_span(batch)
    if isinstance(df.schema[column].dataType, T.StringType):
        month = F.date_trunc("month", instant_of(df, column, on_error))
        return df.where(month == F.lit(str(first)).cast("timestamp"))
    kind = df.schema[column].dataType
    return df.where((F.col(column) >= F.lit(str(first)).cast(kind)) & (F.col(column) < F.lit(str(after)).cast(kind)))


def list_batches(
    df: DataFrame, column: str = GERMAN_POWER.key, folder: str | None = None, on_error: str = "raise"
) -> DataFrame:
    """The months present: ``batch_id, year, month``.

    With ``folder`` each month also has the lowest and highest folder that
    holds rows of it, so that a later read can be limited to those.
    """
    require_utc(df)
    rows = df.select(
        F.date_trunc("month", instant_of(df, column, on_error)).alias("_month"),
        *([F.col(folder).alias("_folder")] if folder else []),
    ).where(F.col("_month").isNotNull())
    span = [F.min("_folder").alias("first_folder"), F.max("_folder").alias("last_folder")]
    found = rows.groupBy("_month").agg(*span) if folder else rows.distinct()
    return found.select(
        month_tag(F.col("_month")).alias("batch_id"),
        F.year("_month").alias("year"),
        F.month("_month").alias("month"),
        *(["first_folder", "last_folder"] if folder else []),
    )


def scan_batch(table: DataFrame, batches: str | Sequence[str]) -> DataFrame:
    """Rows of some batches; a table foldered by month or by year and month is pruned to them."""
    wanted = [batches] if isinstance(batches, str) else list(batches)
    rows = table.where(F.col("batch_id").isin(wanted))
    if {"year", "month"} <= set(table.columns):
        spans = [month_span(b)[0] for b in wanted]
        rows = rows.where((F.col("year") * 100 + F.col("month")).isin([d.year * 100 + d.month for d in spans]))
    return rows
