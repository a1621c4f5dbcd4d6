"""Small tables kept as numbered snapshots that never change.

A write makes a new folder; the mark Spark leaves when a job has committed makes it
complete. Readers take the newest complete one, so a driver that dies while writing
leaves the state before.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

_FOLDER = re.compile(r"v(\d{10})")
_COMMITTED = "_SUCCESS"


class SnapshotTable:
    """A table at ``path`` for one writer at a time; the last ``keep`` complete snapshots stay readable."""

    def __init__(self, spark: SparkSession, path: str, schema: StructType, keep: int = 20):
        self.spark, self.path, self.schema, self.keep = spark, path.rstrip("/"), schema, max(keep, 1)

    def _place(self, *below: str):
        jvm = self.spark._jvm
        place = jvm.org.apache.hadoop.fs.Path("/".join([self.path, *below]))
        return place.getFileSystem(self.spark._jsc.hadoopConfiguration()), place

    def versions(self) -> list[tuple[int, bool]]:
        """Numbers of all snapshots, oldest first, and whether each is complete."""
        files, root = self._place()
        if not files.exists(root):
            return []
        names = [s.getPath().getName() for s in files.listStatus(root) if s.isDirectory()]
        found = sorted(int(m[1]) for m in map(_FOLDER.fullmatch, names) if m)
        return [(n, files.exists(self._place(self._name(n), _COMMITTED)[1])) for n in found]

    @staticmethod
    def _name(number: int) -> str:
        return f"v{number:010d}"

    def _complete(self) -> list[int]:
        return [n for n, complete in self.versions() if complete]

    def exists(self) -> bool:
        return bool(self._complete())

    def create(self) -> None:
        """An empty first snapshot, unless there is a complete one."""
        if not self.exists():
            self.write(self.spark.createDataFrame([], self.schema))

    def folder(self, number: int | None = None) -> str | None:
        """Where a complete snapshot is, by default the newest."""
        complete = self._complete()
        if not complete or (number is not None and number not in complete):
            return None
        return f"{self.path}/{self._name(complete[-1] if number is None else number)}"

    def read_if_exists(self, number: int | None = None) -> DataFrame | None:
        folder = self.folder(number)
        return None if folder is None else self.spark.read.schema(self.schema).parquet(folder)

    def read(self, number: int | None = None) -> DataFrame:
        rows = self.read_if_exists(number)
        if rows is None:
            raise ValueError(f"no complete snapshot {'' if number is None else f'{number} '}at {self.path}")
        return rows

    def write(self, rows: DataFrame, metrics: dict[str, Column] | None = None) -> dict[str, int]:
        """A new snapshot of the rows; returns how many of them meet each metric."""
        number = max((n for n, _ in self.versions()), default=0) + 1
        rows = rows.select(*[F.col(f.name).cast(f.dataType) for f in self.schema.fields]).coalesce(1)
        counted = Observation() if metrics else None
        if counted is not None:
            rows = rows.observe(counted, *[F.count_if(m).alias(name) for name, m in metrics.items()])
        rows.write.parquet(f"{self.path}/{self._name(number)}")
        for old in self._complete()[: -self.keep]:
            files, place = self._place(self._name(old))
            files.delete(place, True)
        return dict(counted.get) if counted is not None else {}
