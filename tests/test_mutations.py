"""Upsert, update and delete as DataFrames and as stored tables."""

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from hourmill import MonthTable
from hourmill.operators import affected_rows, delete_where, merge_update, merge_upsert, update_where
from hourmill.operators.mutations import without_keys

SCHEMA = "k int, v int"


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def frame(spark, data, schema=SCHEMA):
    return spark.createDataFrame(data, schema)


def test_null_keys_never_match(spark):
    merged = merge_upsert(frame(spark, [(None, 1), (1, 1)]), frame(spark, [(None, 2), (1, 2)]), ["k"])
    assert rows(merged) == [(1, 2), (None, 1), (None, 2)]


def test_repeated_source_keys(spark):
    target, source = frame(spark, [(1, 0)]), frame(spark, [(1, 1), (1, 2), (None, 3), (None, 3)])
    assert rows(merge_upsert(target, source, ["k"], "latest", ["v"])) == [(1, 2), (None, 3), (None, 3)]
    assert rows(merge_upsert(target, source, ["k"], "keep")) == [(1, 1), (1, 2), (None, 3), (None, 3)]
    with pytest.raises(ValueError, match="share a key"):
        merge_upsert(target, source, ["k"], "error")
    with pytest.raises(ValueError):
        merge_upsert(target, source, ["k"], "other")


@pytest.mark.parametrize("limit", [0, 64 << 20])
def test_hot_keys_on_either_side(spark, monkeypatch, limit):
    monkeypatch.setattr("hourmill.operators.mutations._BROADCAST_BYTES", limit)
    target = spark.range(9_000, numPartitions=6).selectExpr("if(id % 3 = 0, -1, int(id)) AS k", "1 AS v")
    target = target.unionByName(frame(spark, [(None, 1), (None, 1)]))
    source = spark.range(9_000, numPartitions=6).selectExpr("if(id % 3 = 0, -1, int(id) + 6000) AS k", "2 AS v")
    merged = merge_upsert(target, source, ["k"], "keep")
    plan = merged._jdf.queryExecution().executedPlan().toString()
    assert ("BroadcastHashJoin" in plan) == (limit > 0)
    counts = {r.v: r["count"] for r in merged.groupBy("v").count().collect()}
    assert counts == {1: 4_000 + 2, 2: 9_000}
    assert {r.v for r in merged.where("k = -1").distinct().collect()} == {2}


def test_source_columns_follow_the_target(spark):
    target = frame(spark, [(1, 1)])
    extra = frame(spark, [("2", 2, "x")], "k string, v int, w string")
    assert rows(merge_upsert(target, extra, ["k"])) == [(1, 1), (2, 2)]
    with pytest.raises(ValueError, match="lacks columns of the table: v"):
        merge_upsert(target, extra.drop("v"), ["k"])


small = st.lists(st.tuples(st.one_of(st.none(), st.integers(0, 5)), st.integers(0, 3)), max_size=8)


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(small, small)
def test_upsert_against_plain_python(spark, old, new):
    target = {k: v for k, v in old if k is not None}
    latest = {}
    for k, v in new:
        if k is not None:
            latest[k] = max(v, latest.get(k, v))
    nulls = [(None, v) for k, v in new if k is None]
    want = sorted([*(target | latest).items(), *nulls], key=repr)
    source = frame(spark, new)
    once = merge_upsert(frame(spark, list(target.items())), source, ["k"], "latest", ["v"])
    assert rows(once) == want
    if not nulls:
        assert rows(merge_upsert(once, source, ["k"], "latest", ["v"])) == want


def test_update_changes_matches_that_meet_the_condition(spark):
    target = frame(spark, [(1, 1), (2, 9), (None, 1), (4, None)])
    source = frame(spark, [(1, 5), (2, 5), (3, 5), (None, 5), (4, 5)])
    condition = F.col("target.v") < 5
    changed = merge_update(target, source, ["k"], {"v": F.col("source.v")}, condition)
    assert rows(changed) == [(1, 5), (2, 9), (4, None), (None, 1)]
    assert rows(affected_rows(target, source, ["k"], condition)) == [(1, 1)]


def test_update_with_several_matches_is_an_error(spark):
    source = frame(spark, [(1, 5), (1, 6), (None, 1), (None, 2)])
    fine = merge_update(frame(spark, [(2, 1), (None, 1)]), source, ["k"], {"v": F.col("source.v")})
    assert rows(fine) == [(2, 1), (None, 1)]
    with pytest.raises(PySparkException, match="several source rows"):
        merge_update(frame(spark, [(1, 1)]), source, ["k"], {"v": F.col("source.v")}).collect()


def test_delete_and_update_leave_rows_with_an_unknown_outcome(spark):
    target = frame(spark, [(1, 1), (2, 2), (None, 3)])
    assert rows(delete_where(target, F.col("k") == 1)) == [(2, 2), (None, 3)]
    assert rows(update_where(target, F.col("k") == 1, {"v": F.lit(0)})) == [(1, 0), (2, 2), (None, 3)]


@pytest.fixture
def table(spark, tmp_path):
    return MonthTable(spark, str(tmp_path / "t"), ["day"], {"ym": "date_format(day, 'yyyy-MM')"}, hidden=True)


def days(spark, *pairs):
    return frame(spark, list(pairs), "day string, v int").withColumn("day", F.to_date("day"))


def stored(table):
    return sorted((str(r.day), r.v) for r in table.read().collect())


def files(table):
    return {r[0] for r in table.spark.read.parquet(table.path).select("_metadata.file_path").distinct().collect()}


def test_a_missing_table_is_created_then_merged(spark, table):
    assert not table.exists()
    with pytest.raises(ValueError):
        table.read()
    first = table.merge(days(spark, ("2019-01-01", 1), ("2019-02-01", 2)), metrics={"rows": F.lit(True)})
    assert first == {"rows": 2} and table.exists()
    before = files(table)
    again = table.merge(
        days(spark, ("2019-02-01", 3), ("2019-02-02", 4)),
        metrics={"rows": F.lit(True), "threes": F.col("v") == 3},
    )
    assert again == {"rows": 2, "threes": 1}
    assert stored(table) == [("2019-01-01", 1), ("2019-02-01", 3), ("2019-02-02", 4)]
    assert any("2019-01" in f for f in before & files(table))


def test_counts_leave_out_rows_that_were_there(spark, table):
    table.merge(days(spark, *[(f"2019-01-{d:02d}", d) for d in range(1, 20)]))
    counts = table.merge(days(spark, ("2019-01-01", 0)), touched=["2019-01"], metrics={"rows": F.lit(True)})
    assert counts == {"rows": 1} and len(stored(table)) == 19


def test_a_failing_write_leaves_the_table_as_it_was(spark, table):
    table.merge(days(spark, ("2019-01-01", 1)))
    broken = days(spark, ("2019-01-01", 2), ("2019-01-02", 3)).withColumn(
        "v", F.when(F.col("v") == 3, F.raise_error(F.lit("stop")).cast("int")).otherwise(F.col("v"))
    )
    with pytest.raises(PySparkException):
        table.merge(broken)
    assert stored(table) == [("2019-01-01", 1)]


def test_more_folders_than_can_be_named(spark, table, monkeypatch):
    monkeypatch.setattr("hourmill.sources.tables._MAX_NAMED_FOLDERS", 1)
    table.merge(days(spark, ("2019-01-01", 1), ("2019-02-01", 2), ("2019-03-01", 3)))
    table.merge(days(spark, ("2019-01-01", 5), ("2019-02-02", 6)))
    assert stored(table) == [("2019-01-01", 5), ("2019-02-01", 2), ("2019-02-02", 6), ("2019-03-01", 3)]


@pytest.mark.parametrize("stored_keys", [True, False])
def test_a_frequent_key_is_split_when_keys_are_too_many_to_broadcast(spark, monkeypatch, tmp_path, stored_keys):
    monkeypatch.setattr("hourmill.operators.mutations._BROADCAST_BYTES", 0)
    settings = {
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "100k",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "100k",
        "spark.sql.shuffle.partitions": "32",
    }
    before = {name: spark.conf.get(name) for name in settings}
    target = spark.range(200_000, numPartitions=8).selectExpr("if(id % 3 = 0, -1, id) AS k", "uuid() AS v")
    source = spark.range(100_000, 400_000).selectExpr("id AS k")
    if stored_keys:
        source.write.parquet(str(tmp_path / "keys"))
        source = spark.read.parquet(str(tmp_path / "keys"))
    keys = source.distinct().persist()
    for name, value in settings.items():
        spark.conf.set(name, value)
    try:
        kept = without_keys(target, keys, ["k"])
        assert len(kept.collect()) == 66_667 + 66_666
        assert "skew=true" in kept._jdf.queryExecution().executedPlan().toString()
    finally:
        keys.unpersist()
        for name, value in before.items():
            spark.conf.set(name, value)


def test_only_touched_folders_are_listed_and_read(spark, table):
    table.merge(days(spark, ("2019-01-01", 1), ("2019-02-01", 2)))
    january = table.read_if_exists(["2019-01", "2018-12"])
    assert [r.v for r in january.collect()] == [1]
    assert all("ym=2019-01/" in f for f in january.inputFiles())
    plan = january._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in plan and "PartitionFilters: []" not in plan
    assert table.read_if_exists(["2018-12"]) is None


def test_folders_of_two_levels_and_of_unknown_days(spark, tmp_path):
    folders = {"y": "year(day)", "m": "month(day)"}
    table = MonthTable(spark, str(tmp_path / "two"), ["day"], folders)
    table.merge(days(spark, ("2018-02-01", 1), ("2019-01-01", 2), ("2019-02-01", 3), (None, 4)))
    assert sorted(r.v for r in table.read_if_exists(["2018/2", "2019/1"]).collect()) == [1, 2]
    table.merge(days(spark, ("2018-02-01", 5), (None, 6)))
    assert sorted(r.v for r in table.read().collect()) == [2, 3, 4, 5, 6]
    assert [r.v for r in table.read().where("day IS NULL").orderBy("v").collect()] == [4, 6]


def years(spark, path, **options):
    return MonthTable(spark, str(path), ["day"], {"y": "year(day)"}, **options)


def test_a_row_outside_the_touched_folders_stops_the_merge_and_loses_nothing(spark, tmp_path):
    table = years(spark, tmp_path / "t")
    table.merge(days(spark, ("2019-01-01", 1), ("2020-01-01", 2)))
    with pytest.raises(Exception, match="not among those named as touched"):
        table.merge(days(spark, ("2019-05-01", 3), ("2020-06-01", 4)), touched=["2019"])
    assert sorted(r.v for r in table.read().collect()) == [1, 2]
    table.merge(days(spark, ("2019-05-01", 3), ("2020-06-01", 4)), touched=["2019", "2020"])
    assert sorted(r.v for r in table.read().collect()) == [1, 2, 3, 4]
    fresh = years(spark, tmp_path / "u")
    with pytest.raises(Exception, match="not among those named as touched"):
        fresh.merge(days(spark, ("2019-05-01", 3), ("2020-06-01", 4)), touched=["2019"])


def test_a_folder_that_is_not_what_the_key_says_stops_the_merge(spark, tmp_path):
    table = years(spark, tmp_path / "t")
    table.merge(days(spark, ("2019-01-01", 1)).withColumn("y", F.lit(2019)))
    with pytest.raises(Exception, match="y of a row is not what its key says"):
        table.merge(days(spark, ("2019-01-01", 9)).withColumn("y", F.lit(2020)))
    assert [(r.v, r.y) for r in table.read().collect()] == [(1, 2019)]


def test_rows_of_a_merge_are_counted_per_folder(spark, tmp_path):
    table = years(spark, tmp_path / "t", stamped=True)
    first = days(spark, ("2018-01-01", 0), ("2019-01-01", 1), ("2019-01-02", 2))
    table.merge(first, run="one")
    marked = days(spark, ("2019-01-02", 5), ("2019-01-03", 6)).withColumn("_problem", F.when(F.col("v") == 6, "six"))
    table.merge(marked, run="two")
    assert table.counts_of("one", ["2018", "2019"]) == {"2018": (1, 0, None), "2019": (1, 0, None)}
    assert table.counts_of("two", ["2018", "2019"]) == {"2019": (2, 1, "six")}
    assert table.counts_of("three", ["2019"]) == {}
    assert table.read().columns == [*first.columns, "y"]
    assert years(spark, tmp_path / "none", stamped=True).counts_of("one", ["2019"]) == {}


def test_columns_that_come_later(spark, tmp_path):
    table = years(spark, tmp_path / "t", evolve=True)
    table.merge(days(spark, ("2018-01-01", 1), ("2019-01-01", 2)))
    wider = days(spark, ("2019-01-01", 3)).withColumns({"v": F.col("v").cast("long") + (1 << 40), "w": F.lit("new")})
    table.merge(wider)
    table.merge(days(spark, ("2020-01-01", 4)))
    for stored in (table, years(spark, tmp_path / "t", evolve=True)):
        got = {str(r.day): (r.v, r.w) for r in stored.read().collect()}
        assert got == {"2018-01-01": (1, None), "2019-01-01": ((1 << 40) + 3, "new"), "2020-01-01": (4, None)}
    with pytest.raises(ValueError, match="column w is string"):
        table.merge(days(spark, ("2021-01-01", 4)).withColumn("w", F.lit(1)))
    strict = years(spark, tmp_path / "s")
    strict.merge(days(spark, ("2018-01-01", 1)))
    strict.merge(days(spark, ("2019-01-01", 3)).withColumn("w", F.lit("ignored")))
    assert strict.read().columns == ["day", "v", "y"]


def test_finer_folders_let_a_small_merge_read_and_rewrite_less(spark, tmp_path):
    folders = {"y": "year(day)", "slot": "pmod(xxhash64(day), 16)"}
    table = MonthTable(spark, str(tmp_path / "t"), ["day"], folders)
    table.merge(spark.sql("SELECT date_add(DATE'2019-01-01', CAST(id AS int)) AS day, CAST(id AS int) AS v FROM range(360)"))
    before = {p: p.stat().st_mtime_ns for p in (tmp_path / "t").rglob("*.parquet")}
    table.merge(days(spark, ("2019-01-01", -1), ("2019-03-01", -2)))
    after = {p: p.stat().st_mtime_ns for p in (tmp_path / "t").rglob("*.parquet")}
    replaced = {p.parent.name for p in before if before[p] != after.get(p)}
    assert 1 <= len(replaced) <= 2 and len({p.parent.name for p in before}) == 16
    assert sum(r.v for r in table.read().collect()) == sum(range(360)) - 0 - 59 - 3
