"""Incremental, month-by-month processing of wide hourly series on Spark."""

from .plans import BatchReport, FailedBatches, Lake, analytics, bronze_batch, control, reports, run_batch, run_pending, silver_batch
from .session import require_utc
from .sources import Inventory, Landing, MonthTable, SnapshotTable
from .spec import GERMAN_POWER, GenerationArea, LoadArea, SeriesSpec, TableNames

__all__ = [
    "GERMAN_POWER",
    "BatchReport",
    "FailedBatches",
    "GenerationArea",
    "Inventory",
    "Lake",
    "Landing",
    "LoadArea",
    "MonthTable",
    "SeriesSpec",
    "SnapshotTable",
    "TableNames",
    "analytics",
    "bronze_batch",
    "control",
    "reports",
    "require_utc",
    "run_batch",
    "run_pending",
    "silver_batch",
]
