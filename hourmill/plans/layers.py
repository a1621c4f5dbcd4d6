"""Raw and clean layers of some months of a series."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import at_time, month_span, month_tag, parse_instant
from ..operators.cleaning import (
    bulk_cast_double,
    dedupe_latest,
    derive_year_month,
    named,
    normalize_names,
    parse_timestamps,
    project_prefix,
    scoped_columns,
)
from ..operators.months import instant_of
from ..session import require_utc
from ..spec import GERMAN_POWER, SeriesSpec


def bronze_batch(
    raw: DataFrame,
    spec: SeriesSpec = GERMAN_POWER,
    batches: Sequence[str] | None = None,
    as_of: Column | datetime | str | None = None,
    on_error: str = "raise",
) -> DataFrame:
    """Raw rows of some months (all, unless given) in scope, with file, batch and ingestion time."""
    require_utc(raw)
    month = F.date_trunc("month", instant_of(raw, spec.key, on_error))
    if batches is None:
        rows = raw.where(month.isNotNull())
    else:
        rows = raw.where(month.isin([F.lit(str(month_span(b)[0])).cast("timestamp") for b in batches]))
    batch = F.lit(batches[0]) if batches is not None and len(batches) == 1 else month_tag(month)
    scoped = project_prefix(rows, spec.prefix, spec.time_columns, ["source_file"])
    return scoped.select("*", batch.alias("batch_id"), at_time(as_of).alias("ingestion_timestamp"))


def problem_of(rows: DataFrame, spec: SeriesSpec = GERMAN_POWER) -> Column:
    """The first value of a raw row that the clean layer cannot type, as text with its column; null if there is none."""
    typed = [(c, named(c).try_cast("double")) for c in scoped_columns(rows, spec.prefix)]
    formats = ((spec.key, spec.key_format), (spec.local_time, spec.local_format))
    typed += [(c, parse_instant(named(c), pattern, "null")) for c, pattern in formats]
    bad = [F.when(named(c).isNotNull() & value.isNull(), F.concat(F.lit(f"{c} cannot be read: "), named(c))) for c, value in typed]
    return F.coalesce(*bad)


def typed_rows(bronze: DataFrame, spec: SeriesSpec = GERMAN_POWER, on_error: str = "raise") -> DataFrame:
    """Bronze rows with lower-case names, parsed times, double measures, year and month."""
    parsed = normalize_names(parse_timestamps(bronze, spec, on_error))
    return derive_year_month(bulk_cast_double(parsed, spec.typed_prefix, on_error), spec.key.lower())


def silver_batch(
    bronze: DataFrame,
    spec: SeriesSpec = GERMAN_POWER,
    tie_breakers: Sequence[str] | None = None,
    on_error: str = "raise",
) -> DataFrame:
    """Clean rows of the months in ``bronze``: typed, and the latest ingested one per key.

    Equal ingestion times are settled by file, then by the remaining columns.
    """
    typed = typed_rows(bronze, spec, on_error)
    if tie_breakers is None:
        done = (spec.key.lower(), "ingestion_timestamp", "source_file")
        tie_breakers = ["source_file", *[c for c in typed.columns if c not in done]]
    return dedupe_latest(typed, [spec.key.lower()], ["ingestion_timestamp"], tie_breakers)
