"""Numbered snapshots: what readers see while and after writers die."""

import os

import pytest
from pyspark.sql import functions as F

from hourmill import Lake, SnapshotTable, control


def numbers(table):
    return sorted(r.batch_id for r in table.read().collect())


def rows(spark, *months):
    return control.begin(control.empty(spark), months, "2024-01-01 00:00:00")


def test_created_empty_once(spark, tmp_path):
    table = SnapshotTable(spark, str(tmp_path / "t"), control.SCHEMA)
    assert not table.exists() and table.read_if_exists() is None and table.versions() == []
    with pytest.raises(ValueError, match="no complete snapshot"):
        table.read()
    table.create()
    assert table.exists() and table.read().schema == control.SCHEMA and numbers(table) == []
    table.write(rows(spark, "2019-01"))
    table.create()
    assert numbers(table) == ["2019-01"]


def test_a_half_written_snapshot_is_ignored(spark, tmp_path):
    path = str(tmp_path / "t")
    table = SnapshotTable(spark, path, control.SCHEMA)
    table.write(rows(spark, "2019-01"))
    table.write(rows(spark, "2019-01", "2019-02"))
    os.remove(os.path.join(path, "v0000000002", "_SUCCESS"))  # as if the driver had died before the commit
    os.makedirs(os.path.join(path, "v0000000003", "_temporary"))
    assert table.versions() == [(1, True), (2, False), (3, False)]
    assert numbers(SnapshotTable(spark, path, control.SCHEMA)) == ["2019-01"]
    table.write(rows(spark, "2019-03"))
    assert table.versions()[-1] == (4, True) and numbers(table) == ["2019-03"]
    assert [r.batch_id for r in table.read(1).collect()] == ["2019-01"]
    with pytest.raises(ValueError):
        table.read(2)


def test_old_snapshots_go(spark, tmp_path):
    table = SnapshotTable(spark, str(tmp_path / "t"), control.SCHEMA, keep=2)
    counts = [table.write(rows(spark, *[f"2019-0{m}" for m in range(1, n + 1)]), {"n": F.lit(True)})["n"] for n in (1, 2, 3)]
    assert counts == [1, 2, 3] and [n for n, _ in table.versions()] == [2, 3]


def test_a_state_can_be_read_while_the_next_is_written(spark, tmp_path):
    lake = Lake(spark, str(tmp_path / "lake"))
    assert lake.control_state().isEmpty() and not lake.control.exists()
    lake.create()
    assert lake.control.exists() and lake.control_state().schema == control.SCHEMA
    before = lake.control_state()
    assert lake.save_control(control.begin(before, ["2019-01"], "2024-01-01 00:00:00"), ["2019-01"]) == {"completed": 0}
    state = control.complete(lake.control_state(), ["2019-01"], "2024-01-02 00:00:00")
    assert lake.save_control(state, ["2019-01"]) == {"completed": 1}
    assert before.isEmpty() and [r.status for r in lake.control_state().collect()] == ["completed"]


def test_each_month_fails_with_its_own_text(spark):
    state = control.fail_each(rows(spark, "2019-01", "2019-02", "2019-03"), {"2019-01": "it's", "2019-03": "x" * 600}, "2024-01-02 00:00:00")
    found = {r.batch_id: (r.status, r.error_message) for r in state.collect()}
    assert found == {"2019-01": ("failed", "its"), "2019-02": ("in_progress", None), "2019-03": ("failed", "x" * 500)}
