"""Scoping, typing and deduplicating wide series rows."""

from __future__ import annotations

from collections import Counter
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import parse_instant
from ..session import require_utc
from ..spec import GERMAN_POWER, SeriesSpec


def named(name: str) -> Column:
    """Column of exactly this name, dots and all."""
    return F.col("`" + name.replace("`", "``") + "`")


def scoped_columns(df: DataFrame, prefix: str) -> list[str]:
    """Columns that start with ``prefix``, letter case included."""
    return [c for c in df.columns if c.startswith(prefix)]


def project_prefix(df: DataFrame, prefix: str, keep_first: Sequence[str], keep_last: Sequence[str] = ()) -> DataFrame:
    """Named columns and all columns in scope; everything else is dropped."""
    return df.select(*[named(c) for c in (*keep_first, *scoped_columns(df, prefix), *keep_last)])


def normalize_names(df: DataFrame) -> DataFrame:
    """Lower-case every column name; names that differ by case only are an error."""
    lower = [c.lower() for c in df.columns]
    clashes = sorted(name for name, n in Counter(lower).items() if n > 1)
    if clashes:
        raise ValueError(f"column names differ by letter case only: {', '.join(clashes)}")
    return df.toDF(*lower)


def _replace(df: DataFrame, changed: dict[str, Column]) -> DataFrame:
    return df.select(*[changed[c].alias(c) if c in changed else named(c) for c in df.columns])


def bulk_cast_double(df: DataFrame, prefix: str, on_error: str = "raise") -> DataFrame:
    """Cast all columns in scope to double in one projection."""

    def cast(c: str) -> Column:
        return named(c).cast("double") if on_error == "raise" else named(c).try_cast("double")

    return _replace(df, {c: cast(c) for c in scoped_columns(df, prefix)})


def parse_timestamps(df: DataFrame, spec: SeriesSpec = GERMAN_POWER, on_error: str = "raise") -> DataFrame:
    """Parse the UTC key (its ``Z`` is literal) and the local time (its offset counts)."""
    require_utc(df)
    return _replace(
        df,
        {
            spec.key: parse_instant(named(spec.key), spec.key_format, on_error),
            spec.local_time: parse_instant(named(spec.local_time), spec.local_format, on_error),
        },
    )


def derive_year_month(df: DataFrame, key: str = GERMAN_POWER.key) -> DataFrame:
    return df.select("*", F.year(named(key)).alias("year"), F.month(named(key)).alias("month"))


def dedupe_latest(
    df: DataFrame, keys: Sequence[str], latest_by: Sequence[str], tie_breakers: Sequence[str] | None = None
) -> DataFrame:
    """One row per key: the latest by ``latest_by``, ties settled by further columns.

    Without ``tie_breakers`` all remaining columns settle ties, so the winner
    never depends on task order. Ranking with a limit of one lets every task
    drop all but its own best row per key before the shuffle, so a key with a
    large part of all rows sends only one row per task.
    """
    if tie_breakers is None:
        unordered = ("map", "variant", "void")
        tie_breakers = [
            f.name
            for f in df.schema.fields
            if f.name not in (*keys, *latest_by) and not f.dataType.simpleString().startswith(unordered)
        ]
    order = [named(c).desc() for c in (*latest_by, *tie_breakers)]
    best_first = Window.partitionBy(*[named(k) for k in keys]).orderBy(*order)
    ranked = df.withColumn("_rank", F.row_number().over(best_first))
    return ranked.where(F.col("_rank") == 1).drop("_rank")


def null_profile(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Null count and percentage of each column, from one pass over the rows."""
    counts = df.agg(
        F.count(F.lit(1)).alias("_rows"),
        *[F.count_if(named(c).isNull()).alias(c) for c in columns],
    )
    share = F.when(F.col("_rows") > 0, F.round(F.lit(100.0) * F.col("null_count") / F.col("_rows"), 1))
    return counts.unpivot("_rows", [named(c) for c in columns], "column_name", "null_count").select(
        "column_name", "null_count", F.coalesce(share, F.lit(0.0)).alias("null_percent")
    )
