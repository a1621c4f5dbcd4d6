"""CSV landing area: ``<root>/year=YYYY/*.csv`` with a header row in each file.

Spark matches CSV columns by position under one header, so a folder whose files
order their columns differently would be mislabelled without a word. By default
the headers are read first and files are scanned per header, joined by name.
"""

from __future__ import annotations

import csv
from collections.abc import Iterable
from functools import reduce
from urllib.parse import unquote

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

_MOST_NAMED_YEARS = 1_000


def names_of(header: str) -> list[str]:
    """Column names in a header line; unnamed columns are ``_c`` and their place."""
    names = next(csv.reader([header.removeprefix("\ufeff")]))
    if len(set(names)) < len(names):
        raise ValueError(f"a CSV header names a column twice: {header}")
    return [name or f"_c{i}" for i, name in enumerate(names)]


def _strings(names: list[str]) -> T.StructType:
    return T.StructType([T.StructField(name, T.StringType()) for name in names])


class Landing:
    """A landing area; headers are read at every scan, so files that came or changed since the last one count.

    ``headers="group"`` reads the first line of every file in the folders asked for, and a
    file that changes its header before its rows are read makes the scan fail. ``headers="same"``
    takes the header of one file and lets the scan itself fail on any file
    that differs, which costs nothing extra and suits very many files. An `Inventory`
    remembers headers, so that only files that came or changed are looked at.
    """

    def __init__(self, spark: SparkSession, root: str, headers: str = "group"):
        if headers not in ("group", "same"):
            raise ValueError(f"headers must be 'group' or 'same', not {headers!r}")
        self.spark, self.root, self.headers = spark, root.rstrip("/"), headers

    def scan(self, first_year: int | None = None, last_year: int | None = None, lineage: bool = False) -> DataFrame:
        """Rows of all year folders, or of a range of them: strings plus ``year`` of the folder.

        Only folders of the range are listed and looked at; their files' columns are the
        columns of the result. A range without a folder has no rows, and the columns of all
        folders. With ``lineage`` each row carries the path of its file as ``source_file``.
        """
        try:
            scans = self._scans(self._pattern(first_year, last_year))
        except AnalysisException as problem:
            if problem.getCondition() != "PATH_NOT_FOUND" or (first_year is None and last_year is None):
                raise
            scans = self._scans(self._pattern(None, None))
        if lineage:
            scans = [with_lineage(s) for s in scans]
        rows = by_name(scans)
        if first_year is not None:
            rows = rows.where(F.col("year") >= first_year)
        if last_year is not None:
            rows = rows.where(F.col("year") <= last_year)
        return rows

    def scan_year(self, year: int, lineage: bool = False) -> DataFrame:
        """Rows of one year folder, without the folder's column."""
        return self.scan(year, year, lineage).drop("year")

    def _pattern(self, first_year: int | None, last_year: int | None) -> str:
        if first_year is None or last_year is None or not 0 <= last_year - first_year < _MOST_NAMED_YEARS:
            return f"{self.root}/year=*"
        return f"{self.root}/year={{{','.join(map(str, range(first_year, last_year + 1)))}}}"

    def _reader(self, check: bool = False):
        return (
            self.spark.read.option("header", True)
            .option("enforceSchema", not check)
            .option("basePath", self.root)
        )

    def _scans(self, pattern: str) -> list[DataFrame]:
        if self.headers == "same":
            names = [c for c in self._reader().csv(pattern).columns if c != "year"]
            return [self._reader(check=True).schema(_strings(names)).csv(pattern)]
        return [self.read(header, paths) for header, paths in self._group_by_header(pattern)]

    def read(self, header: str, paths: list[str]) -> DataFrame:
        """Files or folders that share a header line."""
        names = names_of(header)
        stated = next(csv.reader([header.removeprefix("\ufeff")]))
        return self._reader(check=names == stated).schema(_strings(names)).csv(paths)

    def files(self) -> DataFrame:
        """All files: ``path``, ``size``, ``modified`` and ``year`` of the folder. No content is read."""
        listed = self.spark.read.format("binaryFile").option("basePath", self.root).load(self._pattern(None, None))
        about = {"path": "file_path", "size": "file_size", "modified": "file_modification_time"}
        return listed.select(*[F.col(f"_metadata.{source}").alias(name) for name, source in about.items()], F.col("year").cast("int"))

    def first_lines(self, paths: str | list[str]) -> DataFrame:
        """``path`` and first line of each file.

        Lines of a file's first split are in order within their task, so the first one is that of
        the lowest row number there.
        """
        lines = self.spark.read.text(paths).select(
            "value", F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_block_start").alias("start")
        )
        numbered = lines.where(F.col("start") == 0).select("path", "value", F.monotonically_increasing_id().alias("n"))
        return numbered.groupBy("path").agg(F.min_by("value", "n").alias("header"))

    def _group_by_header(self, pattern: str) -> list[tuple[str, list[str]]]:
        """Header lines with the folders (or, in a mixed folder, files) that carry them.

        Only folders and header texts come to the driver; file paths do for mixed folders alone.
        """
        firsts = self.first_lines(pattern).withColumn("folder", F.regexp_replace("path", "/[^/]*$", ""))
        found = firsts.groupBy("folder", "header").count().orderBy("folder", "header").collect()
        if not found:
            raise ValueError(f"no CSV rows under {self.root}")
        if len({r["header"] for r in found}) == 1:
            return [(found[0]["header"], [pattern])]
        headers_of: dict[str, list[str]] = {}
        for r in found:
            headers_of.setdefault(r["folder"], []).append(r["header"])
        mixed = [f for f, headers in headers_of.items() if len(headers) > 1]
        places = [(headers[0], folder) for folder, headers in headers_of.items() if len(headers) == 1]
        if mixed:
            places += [(r["header"], r["path"]) for r in firsts.where(F.col("folder").isin(mixed)).orderBy("path").collect()]
        return grouped(places)


def grouped(places: Iterable[tuple[str, str]]) -> list[tuple[str, list[str]]]:
    """Paths per header, given pairs of a header and a path as file metadata tell it (percent-encoded)."""
    groups: dict[str, list[str]] = {}
    for header, path in places:
        groups.setdefault(header, []).append(unquote(path))
    return sorted(groups.items())


def with_lineage(rows: DataFrame) -> DataFrame:
    return rows.select("*", F.col("_metadata.file_path").alias("source_file"))


def by_name(scans: list[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), scans)
