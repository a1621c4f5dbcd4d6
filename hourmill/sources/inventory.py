"""What is known of a landing area's files, so that only new and changed ones are read.

One row per file: where it is, its size and time, its header, and the months its rows
lie in. A refresh lists the files, which reads none, and looks into those whose
size or time differs from what is known; months and the files that hold them
then come from the inventory alone.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import month_tag
from ..operators.cleaning import named
from ..session import require_utc
from ..spec import GERMAN_POWER
from .landing import Landing, by_name, grouped, names_of, with_lineage
from .snapshots import SnapshotTable

_MONTH = T.StructType([T.StructField("batch_id", T.StringType()), T.StructField("rows", T.LongType())])
SCHEMA = T.StructType(
    [
        T.StructField("path", T.StringType()),
        T.StructField("size", T.LongType()),
        T.StructField("modified", T.TimestampType()),
        T.StructField("year", T.IntegerType()),
        T.StructField("header", T.StringType()),
        T.StructField("months", T.ArrayType(_MONTH)),
        T.StructField("malformed", T.LongType()),
    ]
)
_SAME = ["path", "size", "modified"]


class Inventory:
    """The files of ``landing``, remembered at ``path``; ``key`` is the column that tells a row's time."""

    def __init__(self, landing: Landing, path: str, key: str = GERMAN_POWER.key):
        self.landing, self.key = landing, key
        self.table = SnapshotTable(require_utc(landing.spark), path, SCHEMA)

    def refresh(self) -> DataFrame:
        """The inventory as of now. Files that are gone leave it; unchanged ones are not read."""
        listed = self.landing.files().persist(StorageLevel.MEMORY_AND_DISK)
        try:
            known = self.table.read_if_exists()
            if known is None:
                changed, kept, gone = listed, None, False
            else:
                changed = listed.join(known.select(*_SAME), _SAME, "left_anti")
                kept = known.join(listed.select(*_SAME), _SAME, "left_semi")
                gone = known.join(listed.select(*_SAME), _SAME, "left_anti").count() > 0
            new = [r["path"] for r in changed.select("path").collect()]  # as many names as a scan of these files lists
            if new:
                entries, headers = self._entries(changed, new)
                try:
                    self.table.write(entries if kept is None else kept.unionByName(entries))
                finally:
                    headers.unpersist()
            elif gone:
                self.table.write(kept)
            return self.table.read()
        finally:
            listed.unpersist()

    def _entries(self, changed: DataFrame, paths: list[str]) -> tuple[DataFrame, DataFrame]:
        """Rows for some files, by one look at their first lines and one scan of their key; and the former, kept for both."""
        plain = [path for _, places in grouped([("", p) for p in paths]) for path in places]
        headers = self.landing.first_lines(plain).persist(StorageLevel.MEMORY_AND_DISK)
        hours = []
        for header, places in grouped((r["header"], r["path"]) for r in headers.collect()):
            rows = self.landing.read(header, places)
            if self.key not in rows.columns:
                raise ValueError(f"no column {self.key} in {places[0]}")
            hours.append(rows.select(F.col("_metadata.file_path").alias("path"), named(self.key).alias("at")))
        instant = F.try_to_timestamp("at")
        if hours:
            counts = by_name(hours).groupBy("path", month_tag(instant).alias("batch_id"), F.col("at").isNull().alias("empty")).count()
        else:  # files without any line
            counts = self.landing.spark.createDataFrame([], "path string, batch_id string, empty boolean, count long")
        known = F.col("batch_id").isNotNull()
        months = counts.groupBy("path").agg(
            F.sort_array(F.collect_list(F.when(known, F.struct("batch_id", F.col("count").alias("rows"))))).alias("months"),
            F.sum(F.when(~known & ~F.col("empty"), F.col("count"))).alias("malformed"),
        )
        found = changed.join(headers, "path", "left").join(months, "path", "left")
        filled = {"months": F.coalesce("months", F.array().cast(T.ArrayType(_MONTH))), "malformed": F.coalesce("malformed", F.lit(0))}
        return found.withColumns(filled).select(*SCHEMA.names), headers

    def months(self) -> DataFrame:
        """The months that rows lie in: ``batch_id, year, month``, lowest and highest folder, and the number of rows."""
        each = self.table.read().select("year", F.explode("months").alias("m")).select("year", "m.*")
        span = [F.min("year").alias("first_folder"), F.max("year").alias("last_folder"), F.sum("rows").alias("rows")]
        first = F.to_date("batch_id", "yyyy-MM")
        found = each.groupBy("batch_id").agg(*span)
        return found.select("batch_id", F.year(first).alias("year"), F.month(first).alias("month"), *["first_folder", "last_folder", "rows"])

    def malformed(self) -> DataFrame:
        """Files with keys that are no time, and how many."""
        return self.table.read().where(F.col("malformed") > 0).select("path", "malformed")

    def scan(self, batches: Sequence[str] | None = None, lineage: bool = False) -> DataFrame:
        """Rows of the files that hold rows of some months (of all files, unless given), in the columns that any file has."""
        known = self.table.read()
        headers = [r["header"] for r in known.where("header IS NOT NULL").select("header").distinct().orderBy("header").collect()]
        if not headers:
            raise ValueError(f"no CSV rows under {self.landing.root}")
        wanted = known.where("header IS NOT NULL")
        if batches is not None:
            held = F.transform("months", lambda m: m["batch_id"])
            wanted = wanted.where(F.arrays_overlap(held, F.array(*[F.lit(b) for b in batches])))
        found = grouped((r["header"], r["path"]) for r in wanted.select("header", "path").orderBy("path").collect())
        scans = [self.landing.read(header, places) for header, places in found]
        if lineage:
            scans = [with_lineage(s) for s in scans]
        names = list(dict.fromkeys(name for header in headers for name in names_of(header)))
        rest = ["year", *(["source_file"] if lineage else [])]
        if not scans:
            empty = ", ".join([*[f"`{n.replace('`', '``')}` string" for n in names], "year int", *(["source_file string"] if lineage else [])])
            return self.landing.spark.createDataFrame([], empty)
        rows = by_name(scans)
        missing = [F.lit(None).cast("string").alias(n) for n in names if n not in rows.columns]
        return rows.select("*", *missing).select(*[named(n) for n in (*names, *rest)])
