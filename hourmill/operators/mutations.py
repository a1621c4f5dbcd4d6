"""Table changes as DataFrame results: the old rows and the changes in, the new rows out."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import add, and_, or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .cleaning import dedupe_latest, named

_BROADCAST_BYTES = 64 << 20
_ROW_OVERHEAD = 32


def _any_null(keys: Sequence[str]) -> Column:
    return reduce(or_, [named(k).isNull() for k in keys])


def unique_source(
    source: DataFrame, keys: Sequence[str], on_duplicate: str, latest_by: Sequence[str] = ()
) -> DataFrame:
    """Settle source rows that share a key; rows with a null key match nothing and all stay.

    ``keep`` leaves them all, ``latest`` keeps the latest by ``latest_by``,
    ``error`` raises when there are any.
    """
    if on_duplicate == "keep":
        return source
    if on_duplicate == "latest":
        lone = _any_null(keys)
        return dedupe_latest(source.where(~lone), keys, latest_by).unionByName(source.where(lone))
    if on_duplicate == "error":
        repeated = source.where(~_any_null(keys)).groupBy(*[named(k) for k in keys]).count().where("count > 1")
        if not repeated.isEmpty():
            raise ValueError(f"several source rows share a key ({', '.join(keys)})")
        return source
    raise ValueError(f"on_duplicate must be 'keep', 'latest' or 'error', not {on_duplicate!r}")


def conform(source: DataFrame, target: DataFrame, fill: bool = False) -> DataFrame:
    """Source rows in the target's columns and types; extra columns go, missing ones are an error or, with ``fill``, null."""
    missing = [c for c in target.columns if c not in source.columns]
    if missing and not fill:
        raise ValueError(f"the source lacks columns of the table: {', '.join(missing)}")
    return source.select(
        *[(F.lit(None) if f.name in missing else named(f.name)).cast(f.dataType).alias(f.name) for f in target.schema.fields]
    )


# Types that a column can go to without losing a value.
_WIDER = {"tinyint": 0, "smallint": 1, "int": 2, "bigint": 3}
_WIDER_FLOAT = {"float": 0, "double": 1}


def _wider(name: str, a: T.DataType, b: T.DataType) -> T.DataType:
    x, y = a.simpleString(), b.simpleString()
    if x == y:
        return a
    for order in (_WIDER, _WIDER_FLOAT):
        if x in order and y in order:
            return a if order[x] > order[y] else b
    if {x, y} <= {"tinyint", "smallint", "int", "double"}:
        return T.DoubleType()
    raise ValueError(f"column {name} is {x} in the table and {y} in the source")


def reconciled(table: T.StructType, source: T.StructType) -> T.StructType:
    """Columns of both, the table's first, in the wider type of each; types that do not fit are an error."""
    theirs = {f.name: f.dataType for f in source.fields}
    ours = [T.StructField(f.name, _wider(f.name, f.dataType, theirs.get(f.name, f.dataType))) for f in table.fields]
    return T.StructType(ours + [T.StructField(f.name, f.dataType) for f in source.fields if f.name not in table.names])


def key_bytes(keys: Sequence[str]) -> Column:
    """About how many bytes some distinct keys take when they are broadcast (an aggregate)."""
    width = reduce(add, [F.coalesce(F.octet_length(named(k).cast("string")), F.lit(0)) for k in keys])
    return F.coalesce(F.sum(width + F.lit(_ROW_OVERHEAD)), F.lit(0))


def without_keys(rows: DataFrame, replaced: DataFrame, keys: Sequence[str], size: int | None = None) -> DataFrame:
    """Rows whose key is not among the distinct keys in ``replaced``; null keys are among none.

    The keys are measured, unless their ``size`` is given. Up to a fixed size they
    are broadcast, so the rows stay where they are, however many of them share a key.
    Beyond it both sides are shuffled, and adaptive execution splits a shuffle
    partition that a frequent key makes too large. It can do so only where the join
    itself shuffles the keys; joining on one struct sees to that, since the
    partitioning left by a ``distinct()`` on the single columns does not serve it.
    """
    if size is None:
        size = replaced.agg(key_bytes(keys).alias("size")).collect()[0]["size"]
    if size <= _BROADCAST_BYTES:
        return rows.join(F.broadcast(replaced), list(keys), "left_anti")
    whole = F.when(~_any_null(keys), F.struct(*[named(k).alias(k) for k in keys]))
    left, right = rows.withColumn("_key", whole), replaced.select(whole.alias("_replaced"))
    return left.join(right.hint("merge"), F.col("_key") == F.col("_replaced"), "left_anti").drop("_key")


def merge_upsert(
    target: DataFrame,
    source: DataFrame,
    keys: Sequence[str],
    on_duplicate: str = "latest",
    latest_by: Sequence[str] = (),
    match_on: DataFrame | None = None,
) -> DataFrame:
    """Source rows plus the target rows whose key the source does not have.

    ``match_on`` may give the source's keys more cheaply than the source itself.
    """
    incoming = conform(unique_source(source, keys, on_duplicate, latest_by), target)
    replaced = (source if match_on is None else match_on).select(*[named(k) for k in keys]).distinct()
    return without_keys(target, replaced, keys).unionByName(incoming)


def _joined(target: DataFrame, source: DataFrame, keys: Sequence[str], how: str) -> DataFrame:
    rest = [c for c in source.columns if c not in keys]
    one_each = source.groupBy(*[named(k) for k in keys]).agg(
        F.count(F.lit(1)).alias("_matches"), *[F.first(named(c)).alias(c) for c in rest]
    )
    same_key = reduce(and_, [F.col(f"target.{k}") == F.col(f"source.{k}") for k in keys])
    return target.alias("target").join(one_each.alias("source"), same_key, how)


def _hit(condition: Column | None) -> Column:
    several = F.raise_error(F.lit("several source rows match one target row")).cast("boolean")
    wanted = F.lit(True) if condition is None else F.coalesce(condition, F.lit(False))
    matches = F.col("source._matches")
    return F.when(matches > 1, several).otherwise(matches.isNotNull() & wanted)


def merge_update(
    target: DataFrame,
    source: DataFrame,
    keys: Sequence[str],
    assign: dict[str, Column],
    condition: Column | None = None,
) -> DataFrame:
    """Target rows, changed where a source row has their key and the condition holds.

    Columns in ``assign`` and ``condition`` are named ``target.x`` and
    ``source.x``. Source rows without a match are not inserted. The target is
    meant to have few rows per key, as a keyed table has.
    """
    hit = _hit(condition)
    return _joined(target, source, keys, "left").select(
        *[
            (F.when(hit, assign[c]).otherwise(F.col(f"target.{c}")) if c in assign else F.col(f"target.{c}")).alias(c)
            for c in target.columns
        ]
    )


def affected_rows(
    target: DataFrame, source: DataFrame, keys: Sequence[str], condition: Column | None = None
) -> DataFrame:
    """The target rows, as they are, that :func:`merge_update` would change."""
    return _joined(target, source, keys, "inner").where(_hit(condition)).select("target.*")


def delete_where(target: DataFrame, predicate: Column) -> DataFrame:
    """Rows for which the predicate is not true; an unknown outcome keeps the row."""
    return target.where(~F.coalesce(predicate, F.lit(False)))


def update_where(target: DataFrame, predicate: Column, assign: dict[str, Column]) -> DataFrame:
    """Target rows, changed where the predicate is true."""
    hit = F.coalesce(predicate, F.lit(False))
    return target.select(
        *[(F.when(hit, assign[c]).otherwise(named(c)).alias(c) if c in assign else named(c)) for c in target.columns]
    )
