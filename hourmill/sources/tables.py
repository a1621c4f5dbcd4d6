"""Parquet tables whose folders follow from the row key.

A folder value is an expression over key columns only, so rows with equal keys
always share a folder, and an upsert has to look at the folders of its source
and no others.
"""

from __future__ import annotations

import json
import re
import uuid
from collections.abc import Sequence

from pyspark import StorageLevel
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from ..operators.cleaning import named
from ..operators.mutations import conform, key_bytes, reconciled, unique_source, without_keys
from .snapshots import SnapshotTable

_INCOMING = "_incoming"
#: Columns that a stamped table stores and does not show: the merge that wrote a row, and what is wrong with the row.
RUN, PROBLEM = "_run", "_problem"
_MAX_NAMED_FOLDERS = 10_000
_NULL_TAG = "null"
_PLAIN_TAG = re.compile(r"[\w.-]+(/[\w.-]+)*")


class MonthTable:
    """A table at ``path`` with ``keys`` and ``folders`` (name to SQL expression over the keys).

    Folder columns are columns of the table unless ``hidden``. ``last`` names
    columns to show last, since reading puts folder columns at the end. A ``stamped`` table
    notes in each row the merge that wrote it, so that the rows of a merge can be counted
    per folder from two narrow columns, however many folders there are. With ``evolve`` columns that are
    new in a source join the table, and those a source lacks are null.
    """

    def __init__(
        self,
        spark: SparkSession,
        path: str,
        keys: Sequence[str],
        folders: dict[str, str],
        hidden: bool = False,
        last: Sequence[str] = (),
        stamped: bool = False,
        evolve: bool = False,
    ):
        self.spark, self.path = spark, path
        self.keys, self.folders = tuple(keys), dict(folders)
        self.hidden, self.last, self.stamped, self.evolve = hidden, tuple(last), stamped, evolve
        self._schema: StructType | None = None
        # A name that begins like this is no data to Spark.
        self._schemas = SnapshotTable(spark, f"{path}/_schema", StructType([StructField("schema", StringType())])) if evolve else None

    def exists(self) -> bool:
        return self._stored() is not None

    def read(self) -> DataFrame:
        rows = self.read_if_exists()
        if rows is None:
            raise ValueError(f"no table at {self.path}")
        return rows

    def read_if_exists(self, tags: Sequence[str] | None = None) -> DataFrame | None:
        """The table, or only some of its folders; None when there is nothing there.

        A tag is a folder's values as text, joined by ``/``.
        """
        stored = self._stored(tags)
        return None if stored is None else self._visible(stored)

    def _stored(self, tags: Sequence[str] | None = None) -> DataFrame | None:
        """Rows with their folder columns. The schema is looked up once; named folders alone are listed."""
        reader = self.spark.read.option("basePath", self.path)
        if self._schema is None and self._schemas is not None:
            known = self._schemas.read_if_exists()
            self._schema = known and StructType.fromJson(json.loads(known.first()["schema"]))
        if self._schema is not None:
            reader = reader.schema(self._schema)
        try:
            stored = reader.parquet(self.path if tags is None else self._pattern(tags))
        except AnalysisException as problem:
            if problem.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
                return None
            raise
        self._schema = stored.schema
        return stored if tags is None else stored.where(self._tag().isin(list(tags)))

    def stored_schema(self) -> StructType:
        """All stored columns, folder columns last."""
        self.read()
        folders = [f for f in self._schema.fields if f.name in self.folders]
        return StructType([f for f in self._schema.fields if f.name not in self.folders] + folders)

    def _pattern(self, tags: Sequence[str]) -> str:
        """Glob over the folders of some tags; with two levels it may cover a few more."""
        if not tags or not all(_PLAIN_TAG.fullmatch(t) for t in tags) or _NULL_TAG in "/".join(tags).split("/"):
            return self.path
        levels = zip(*[t.split("/") for t in tags], strict=True)
        parts = [f"{name}={{{','.join(sorted(set(values)))}}}" for name, values in zip(self.folders, levels, strict=True)]
        return "/".join([self.path, *parts])

    def _visible(self, stored: DataFrame) -> DataFrame:
        dropped = (set(self.folders) if self.hidden else set()) | ({RUN, PROBLEM} if self.stamped else set())
        first = [c for c in stored.columns if c not in dropped and c not in self.last]
        return stored.select(*[named(c) for c in (*first, *self.last)])

    def _in_folders(self, rows: DataFrame) -> DataFrame:
        """Rows with their folder columns; those they lack are computed from the key."""
        return rows.select("*", *[F.expr(e).alias(n) for n, e in self.folders.items() if n not in rows.columns])

    def _tag(self) -> Column:
        parts = [F.coalesce(F.col(f).cast("string"), F.lit(_NULL_TAG)) for f in self.folders]
        return F.concat_ws("/", *parts)

    def _checked(self, rows: DataFrame, touched: Sequence[str] | None) -> DataFrame:
        """Rows with their folder columns; a row that would go elsewhere than its key says, or than ``touched`` says, stops the write.

        Stopping comes before any folder is replaced, so no stored row is lost.
        """
        given = [n for n in self.folders if n in rows.columns]
        rows = self._in_folders(rows)
        types = dict(rows.dtypes)

        def or_stop(name: str, fine: Column, why: str) -> Column:
            return F.when(fine, F.col(name)).otherwise(F.raise_error(F.lit(why)).cast(types[name]))

        own = {
            n: or_stop(n, F.col(n).cast("string").eqNullSafe(F.expr(self.folders[n]).cast("string")), f"{n} of a row is not what its key says")
            for n in given
        }
        rows = rows.withColumns(own) if own else rows
        if touched is None:
            return rows
        first = next(iter(self.folders))
        why = "a source row lies in a folder that is not among those named as touched"
        return rows.withColumn(first, or_stop(first, self._tag().isin(list(touched)), why))

    def overwrite_folders(
        self, rows: DataFrame, spread: bool = True, metrics: dict[str, Column] | None = None
    ) -> dict[str, int]:
        """Replace exactly the folders the rows fall in; other folders stay."""
        return self._write(self._checked(rows, None).withColumn(_INCOMING, F.lit(True)), spread, metrics)

    def merge(
        self,
        source: DataFrame,
        match_on: DataFrame | None = None,
        touched: Sequence[str] | None = None,
        on_duplicate: str = "keep",
        latest_by: Sequence[str] = (),
        spread: bool = True,
        metrics: dict[str, Column] | None = None,
        run: str | None = None,
    ) -> dict[str, int]:
        """Upsert by key, or create the table; returns counts of source rows per metric.

        Only folders of the source are read and rewritten. ``touched`` gives
        their tags when the caller knows them, otherwise they are looked up; a source row outside
        them stops the merge before anything is replaced. Finer ``folders`` (say, a hash of
        the key beside the month) let a merge of few keys read and rewrite less.
        ``run`` names the merge in a stamped table.
        While none of them holds rows yet, the source is written as it is,
        without any join. ``match_on`` may give the source's keys more cheaply
        than the source; the distinct keys are kept while they are used.
        """
        incoming = self._checked(unique_source(source, self.keys, on_duplicate, latest_by), touched)
        if self.stamped:
            problem = F.col(PROBLEM) if PROBLEM in source.columns else F.lit(None).cast("string")
            incoming = incoming.withColumns({RUN: F.lit(run or uuid.uuid4().hex), PROBLEM: problem})
        table = self._stored() if self._schema is None else self.spark.createDataFrame([], self._schema)
        if self._schemas is not None:
            before = None if table is None else table.schema
            self._schema = incoming.schema if before is None else reconciled(before, incoming.schema)
            if self._schema != before or not self._schemas.exists():  # first, since readers can widen what is stored narrow
                self._schemas.write(self.spark.createDataFrame([(self._schema.json(),)], self._schemas.schema))
            table = None if table is None else self.spark.createDataFrame([], self._schema)
        if table is not None:
            incoming = conform(incoming, table, fill=self.evolve)
        rows = incoming.withColumn(_INCOMING, F.lit(True))
        old = None if table is None or touched is None else self._stored(touched)
        if table is None or (touched is not None and (old is None or old.isEmpty())):
            return self._write(rows, spread, metrics)
        keys = (source if match_on is None else match_on).select(*[named(k) for k in self.keys]).distinct()
        keys = keys.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            size = None
            if touched is None:
                tags, size = self._measured(keys)
                old = self._stored_like(keys) if tags is None else self._stored(tags)
            if old is not None:
                kept = without_keys(old, keys, self.keys, size).withColumn(_INCOMING, F.lit(False))
                rows = rows.unionByName(kept)
            return self._write(rows, spread, metrics)
        finally:
            keys.unpersist()

    def rows_of(self, run: str, tags: Sequence[str]) -> DataFrame:
        """Rows that a merge wrote, with folder columns and what is wrong with them, from some folders of a stamped table."""
        stored = self._stored(tags) if self.stamped else None
        if stored is None:
            parts = [StructField(n, StringType()) for n in (*self.folders, RUN, PROBLEM)]
            return self.spark.createDataFrame([], StructType(parts))
        return stored.where(F.col(RUN) == run)

    def counts_of(self, run: str, tags: Sequence[str]) -> dict[str, tuple[int, int, str | None]]:
        """Per folder, rows that a merge wrote, those with something wrong, and one thing that is.

        Reads the two narrow columns of the folders concerned once, for any number of folders.
        """
        tag = self._tag().alias("tag")
        wrong = F.count(F.col(PROBLEM)).alias("wrong")
        found = self.rows_of(run, tags).groupBy(tag).agg(F.count(F.lit(1)).alias("n"), wrong, F.min(PROBLEM).alias("example"))
        return {r["tag"]: (r["n"], r["wrong"], r["example"]) for r in found.collect()}

    def _measured(self, keys: DataFrame) -> tuple[list[str] | None, int | None]:
        """Folders and bytes of some distinct keys by one job; unknown when the folders are too many to name."""
        per_folder = self._in_folders(keys).groupBy(self._tag().alias("tag")).agg(key_bytes(self.keys).alias("size"))
        found = per_folder.limit(_MAX_NAMED_FOLDERS + 1).collect()
        if len(found) > _MAX_NAMED_FOLDERS:
            return None, None
        return sorted(r["tag"] for r in found), sum(r["size"] for r in found)

    def _stored_like(self, rows: DataFrame) -> DataFrame | None:
        """Stored rows of the folders some rows belong to, however many these are."""
        stored = self._stored()
        if stored is None:
            return None
        tags = self._in_folders(rows).select(self._tag().alias("_tag")).distinct()
        return stored.withColumn("_tag", self._tag()).join(tags, "_tag", "left_semi").drop("_tag")

    def _write(self, rows: DataFrame, spread: bool, metrics: dict[str, Column] | None) -> dict[str, int]:
        """Dynamic partition overwrite; counts are taken after the last shuffle.

        Rebalancing gathers a folder's rows and splits a large folder over
        several tasks by size. Counting in the writing stage itself keeps the
        numbers right when a lost executor makes earlier stages run again.
        """
        if spread:
            rows = rows.hint("rebalance", *self.folders)
        rows = rows.sortWithinPartitions(*self.folders, *[named(k) for k in self.keys])
        counted = Observation() if metrics else None
        if counted is not None:
            rows = rows.observe(
                counted, *[F.count_if(F.col(_INCOMING) & m).alias(name) for name, m in metrics.items()]
            )
        (
            rows.drop(_INCOMING)
            .write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .partitionBy(*self.folders)
            .parquet(self.path)
        )
        return dict(counted.get) if counted is not None else {}
