"""Taking months of the landing area through Bronze, Silver and the daily tables."""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from dataclasses import dataclass, field
from datetime import datetime, timezone

from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.cleaning import normalize_names, parse_timestamps, scoped_columns
from ..operators.daily import daily_totals, generation_summary, load_summary, share_summary
from ..operators.months import scan_batch
from ..sources.inventory import Inventory
from ..sources.landing import Landing
from ..sources.tables import PROBLEM
from . import control
from .lake import Lake
from .layers import bronze_batch, problem_of, silver_batch


class FailedBatches(ValueError):
    """Months that could not be done, with the reason of each; the others of the same run are complete."""

    def __init__(self, reasons: dict[str, str]):
        super().__init__("; ".join(f"{batch}: {why}" for batch, why in sorted(reasons.items())))
        self.reasons = reasons


@dataclass(frozen=True)
class BatchReport:
    """What one run did: rows per batch, and null counts of the clean rows per column."""

    batches: tuple[str, ...]
    rows_bronze: dict[str, int] = field(default_factory=dict)
    rows_silver: dict[str, int] = field(default_factory=dict)
    nulls: dict[str, int] = field(default_factory=dict)
    completed: int = 0


def _month_folders(batches: Sequence[str]) -> list[str]:
    return [f"{int(b[:4])}/{int(b[5:])}" for b in batches]


def ingest_bronze(
    lake: Lake, raw: DataFrame, batches: Sequence[str], as_of=None, on_error: str = "raise"
) -> tuple[dict[str, int], dict[str, str]]:
    """Upsert some months into Bronze; returns source rows per batch, and what is wrong in batches with values that have no type.

    A repeated raw key is kept: Bronze is a replayable copy, Silver settles it. Rows are tried
    by the same pass that writes them; they are counted per folder afterwards from two narrow columns.
    """
    rows = bronze_batch(raw, lake.spec, batches, as_of, on_error)
    run = uuid.uuid4().hex
    lake.bronze.merge(rows.withColumn(PROBLEM, problem_of(rows, lake.spec)), touched=batches, run=run)
    counts = lake.bronze.counts_of(run, batches)
    wrong = {b: f"{bad} rows with values that cannot be read, such as {example}" for b, (_, bad, example) in counts.items() if bad}
    return {b: counts.get(b, (0, 0, None))[0] for b in batches}, wrong


def transform_silver(lake: Lake, batches: Sequence[str], on_error: str = "raise"):
    """Upsert some months of Bronze into Silver; returns rows per batch and null counts per column.

    Which old rows give way follows from the keys alone, so these are read from
    Bronze by themselves, without the measures and the deduplication.
    """
    bronze = lake.bronze.read_if_exists(batches)
    if bronze is None:
        return dict.fromkeys(batches, 0), {}
    source = scan_batch(bronze, batches)
    rows = silver_batch(source, lake.spec, on_error=on_error)
    measures = scoped_columns(rows, lake.spec.typed_prefix)
    run, folders = uuid.uuid4().hex, _month_folders(batches)
    nulls = lake.silver.merge(
        rows,
        match_on=normalize_names(parse_timestamps(source.select(*lake.spec.time_columns), lake.spec, on_error)),
        touched=folders,
        metrics={f"null {m}": F.col(m).isNull() for m in measures},
        run=run,
    )
    counts = lake.silver.counts_of(run, folders)
    per_batch = {b: counts.get(f, (0, 0, None))[0] for b, f in zip(batches, folders, strict=True)}
    return per_batch, {m: nulls.get(f"null {m}", 0) for m in measures}


def aggregate_gold(lake: Lake, batches: Sequence[str]) -> None:
    """Upsert the daily tables of some months from Silver; a month without clean rows is an error.

    The three tables share one set of daily sums, a row per day, which is kept
    while they are written.
    """
    silver = lake.silver.read_if_exists(_month_folders(batches))
    if silver is None:
        raise ValueError(f"no clean rows for {', '.join(batches)}")
    years = sorted({b[:4] for b in batches})
    totals = daily_totals(scan_batch(silver, batches), lake.spec).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        month = F.date_format("event_date", "yyyy-MM").alias("month")
        present = {r["month"] for r in totals.select(month).distinct().collect()}
        missing = sorted(set(batches) - present)
        if missing:
            raise ValueError(f"no clean rows for {', '.join(missing)}")
        for table, daily in (
            (lake.load, load_summary(totals, lake.spec)),
            (lake.generation, generation_summary(totals, lake.spec)),
            (lake.share, share_summary(totals, lake.spec)),
        ):
            table.merge(daily, touched=years, spread=False)
    finally:
        totals.unpersist()


def _process(lake: Lake, inventory: Inventory, batches: list[str], as_of, on_error: str) -> BatchReport:
    """Months through all layers. Those with values that cannot be read are marked failed and left there; the others go on."""
    at = as_of or datetime.now(timezone.utc)
    lake.create()
    lake.save_control(control.begin(lake.control_state(), batches, at), batches)
    try:
        bronze, wrong = ingest_bronze(lake, inventory.scan(batches, lineage=True), batches, at, on_error)
        wrong = wrong if on_error == "raise" else {}
        good = [b for b in batches if b not in wrong]
        silver, nulls = transform_silver(lake, good, on_error) if good else ({}, {})
        state = lake.control_state()
        if good:
            counts = lake.spark.createDataFrame(
                [(b, bronze[b], silver[b]) for b in good], "batch_id string, rows_bronze int, rows_silver int"
            )
            state = control.record_counts(state, counts, as_of)
        lake.save_control(control.fail_each(state, wrong, as_of) if wrong else state, batches)
    except Exception as error:
        lake.save_control(control.fail(lake.control_state(), batches, str(error), as_of), batches)
        raise
    completed = 0
    if good:
        aggregate_gold(lake, good)
        completed = lake.save_control(control.complete(lake.control_state(), good, as_of), good)["completed"]
    if wrong:
        raise FailedBatches(wrong)
    return BatchReport(tuple(batches), bronze, silver, nulls, completed)


def _known(lake: Lake, landing: Landing, on_error: str) -> Inventory:
    """The landing area's inventory as of now; rows whose key is no time belong to no month, which is an error unless lenient."""
    inventory = lake.inventory(landing)
    inventory.refresh()
    if on_error == "raise":
        bad = inventory.malformed().orderBy("path").limit(1).collect()
        if bad:
            raise ValueError(f"{bad[0]['malformed']} rows of {bad[0]['path']} have a {lake.spec.key} that is no time")
    return inventory


def run_batch(
    lake: Lake, landing: Landing, batch: str | None = None, as_of=None, on_error: str = "raise"
) -> BatchReport | None:
    """Run one month, by default the earliest pending one; None when none is pending.

    Months, and the files that hold rows of each, come from the lake's inventory of the landing
    area: only files that are new or changed since the last run are looked at to choose, and only
    those with rows of the month are read to load it.
    """
    inventory = _known(lake, landing, on_error)
    if batch is None:
        found = control.next_batch(inventory.months(), lake.control_state()).collect()
        if not found:
            return None
        batch = found[0]["batch_id"]
    return _process(lake, inventory, [batch], as_of, on_error)


def run_pending(lake: Lake, landing: Landing, as_of=None, on_error: str = "raise") -> BatchReport | None:
    """Run all pending months in one pass, with the same tables as one run per month.

    The landing area is read once to load the months, after a look at files the inventory does not know.
    Months with values that cannot be read are found by that pass and marked failed, each with
    its reason; all others are completed by it, and `FailedBatches` tells of the failed ones at the end.
    """
    inventory = _known(lake, landing, on_error)
    found = control.pending_batches(inventory.months(), lake.control_state()).orderBy("year", "month").collect()
    if not found:
        return None
    return _process(lake, inventory, [r["batch_id"] for r in found], as_of, on_error)
