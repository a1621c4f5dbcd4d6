"""DataFrame operators: each takes DataFrames and returns one, lazily."""

from .cleaning import (
    bulk_cast_double,
    dedupe_latest,
    derive_year_month,
    normalize_names,
    null_profile,
    parse_timestamps,
    project_prefix,
    scoped_columns,
)
from .daily import daily_totals, generation_summary, load_summary, share_by_join, share_summary
from .mutations import affected_rows, delete_where, merge_update, merge_upsert, update_where
from .months import filter_month, list_batches, scan_batch

__all__ = [
    "affected_rows",
    "bulk_cast_double",
    "daily_totals",
    "dedupe_latest",
    "delete_where",
    "derive_year_month",
    "filter_month",
    "generation_summary",
    "list_batches",
    "load_summary",
    "merge_update",
    "merge_upsert",
    "normalize_names",
    "null_profile",
    "parse_timestamps",
    "project_prefix",
    "scan_batch",
    "scoped_columns",
    "share_by_join",
    "share_summary",
    "update_where",
]
