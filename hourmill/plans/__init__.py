"""Layer builds, batch control, analytic queries and the month-by-month run."""

from . import analytics, control, reports
from .layers import bronze_batch, silver_batch
from .lake import Lake
from .run import BatchReport, FailedBatches, run_batch, run_pending

__all__ = [
    "BatchReport",
    "FailedBatches",
    "Lake",
    "analytics",
    "bronze_batch",
    "control",
    "reports",
    "run_batch",
    "run_pending",
    "silver_batch",
]
