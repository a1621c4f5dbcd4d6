"""The tables of one lakehouse under one root folder."""

from __future__ import annotations

import zlib

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import require_utc
from ..sources.inventory import Inventory
from ..sources.landing import Landing
from ..sources.snapshots import SnapshotTable
from ..sources.tables import PROBLEM, RUN, MonthTable
from ..spec import GERMAN_POWER, SeriesSpec
from . import control, reports


class Lake:
    """Bronze, Silver, three daily tables and the control table.

    Bronze is foldered by batch, Silver by year and month. The daily tables have
    one row per day whatever the volume of hourly rows, so they are foldered by year to
    keep files from being tiny. The control table, a row per month, is kept in snapshots.
    With ``evolve`` measures that are new in the source join Bronze and Silver.
    """

    def __init__(self, spark: SparkSession, root: str, spec: SeriesSpec = GERMAN_POWER, evolve: bool = False):
        require_utc(spark)
        self.spark, self.root, self.spec = spark, root.rstrip("/"), spec
        key, names = f"`{spec.key}`", spec.tables
        self.bronze = self._table(
            f"bronze/{names.bronze}",
            [spec.key],
            {"batch_id": f"date_format(to_timestamp({key}), 'yyyy-MM')"},
            last=["source_file", "batch_id", "ingestion_timestamp"],
            stamped=True,
            evolve=evolve,
        )
        self.silver = self._table(
            f"silver/{names.silver}",
            [spec.key.lower()],
            {"year": f"year({key})", "month": f"month({key})"},
            stamped=True,
            evolve=evolve,
        )
        self.load = self._daily(names.load)
        self.generation = self._daily(names.generation, evolve)
        self.share = self._daily(names.share)
        self.control = SnapshotTable(spark, f"{self.root}/orchestration/{names.control}", control.SCHEMA)

    def _table(self, place: str, keys: list[str], folders: dict[str, str], **options) -> MonthTable:
        return MonthTable(self.spark, f"{self.root}/{place}", keys, folders, **options)

    def _daily(self, name: str, evolve: bool = False) -> MonthTable:
        return self._table(f"gold/{name}", ["event_date"], {"event_year": "year(event_date)"}, hidden=True, evolve=evolve)

    def inventory(self, landing: Landing) -> Inventory:
        """What this lake knows of a landing area's files; areas are told apart by their root."""
        place = f"{zlib.crc32(landing.root.encode()):08x}"
        return Inventory(landing, f"{self.root}/orchestration/landing_files/{place}", self.spec.key)

    def create(self) -> None:
        """Set up the control table, empty, unless it is there."""
        self.control.create()

    def control_state(self) -> DataFrame:
        """Rows of the control table, none before the first attempt."""
        rows = self.control.read_if_exists()
        return control.empty(self.spark) if rows is None else rows

    def save_control(self, state: DataFrame, batches: list[str]) -> dict[str, int]:
        """Store a new state of the control table; counts how many of some batches are completed in it."""
        done = F.col("batch_id").isin(batches) & (F.col("status") == control.COMPLETED)
        return self.control.write(state, {"completed": done})

    def _tables(self) -> list[MonthTable]:
        return [self.bronze, self.silver, self.load, self.generation, self.share]

    def register_views(self) -> None:
        """Name the existing tables for SQL: temporary views under the table names."""
        for table in self._tables():
            rows = table.read_if_exists()
            if rows is not None:
                rows.createOrReplaceTempView(table.path.rsplit("/", 1)[1])
        self.control_state().createOrReplaceTempView(self.spec.tables.control)

    def register_tables(self, database: str) -> None:
        """Name the existing tables in the catalog: external tables on their folders, and views of the columns they show.

        To be called again after runs that add folders or columns. The control view is of the snapshot that is newest now.
        """
        self.spark.sql(f"CREATE DATABASE IF NOT EXISTS `{database}` LOCATION '{self.root}/catalog'")
        for table in self._tables():
            rows = table.read_if_exists()
            if rows is None:
                continue
            name = f"`{database}`.`{table.path.rsplit('/', 1)[1]}"
            stored = table.stored_schema()
            columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in stored.fields)
            self.spark.sql(f"DROP TABLE IF EXISTS {name}_files`")
            self.spark.sql(
                f"CREATE TABLE {name}_files` ({columns}) USING parquet PARTITIONED BY ({', '.join(table.folders)}) LOCATION '{table.path}'"
            )
            self.spark.sql(f"ALTER TABLE {name}_files` RECOVER PARTITIONS")
            shown = ", ".join(f"`{c}`" for c in rows.columns if c not in (RUN, PROBLEM))
            self.spark.sql(f"CREATE OR REPLACE VIEW {name}` AS SELECT {shown} FROM {name}_files`")
        newest = self.control.folder()
        if newest is not None:
            shown = ", ".join(f"`{c}`" for c in control.SCHEMA.names)
            self.spark.sql(f"CREATE OR REPLACE VIEW `{database}`.`{self.spec.tables.control}` AS SELECT {shown} FROM parquet.`{newest}`")

    def report(self, name: str, database: str | None = None) -> DataFrame:
        """A report by its SQL, on the stored tables or on those registered in a database."""
        text = reports.statements(self.spec)[name]
        if database is not None:
            tables = {part: f"`{database}`.`{table}`" for part, table in self.spec.tables.parts().items()}
            return self.spark.sql(text.format_map(tables))
        stored = dict(zip(("bronze", "silver", "load", "generation", "share"), self._tables(), strict=True))
        used = reports.tables_of(text)
        return self.spark.sql(text, **{part: self.control_state() if part == "control" else stored[part].read() for part in used})
