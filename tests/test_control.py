"""Status transitions of the control table, and the choice of the next month."""

import datetime

import pytest

from hourmill import control

T0, T1 = "2024-01-01 00:00:00", "2024-01-02 00:00:00"
AT0, AT1 = datetime.datetime(2024, 1, 1), datetime.datetime(2024, 1, 2)


def state(df):
    return {r.batch_id: r for r in df.collect()}


def listed(spark, *months):
    data = [(m, int(m[:4]), int(m[5:])) for m in months]
    return spark.createDataFrame(data, "batch_id string, year int, month int")


def chosen(spark, table, *months):
    return [r.batch_id for r in control.next_batch(listed(spark, *months), table).collect()]


def test_empty_table_has_the_control_columns(spark):
    empty = control.empty(spark)
    assert empty.schema == control.SCHEMA and empty.isEmpty()
    assert control.history(empty).columns == control.SCHEMA.names


def test_begin_replaces_earlier_attempts(spark):
    first = control.begin(control.empty(spark), ["2019-01"], T0)
    failed = control.fail(first, ["2019-01"], "no", T0)
    again = state(control.begin(failed, ["2019-01", "2019-02", "2019-01"], T1))
    assert set(again) == {"2019-01", "2019-02"}
    row = again["2019-01"]
    assert tuple(row) == ("2019-01", 2019, 1, "in_progress", None, None, AT1, AT1, None)
    assert control.begin(failed, ["2019-02"], T1).schema == control.SCHEMA


@pytest.mark.parametrize("batches", [[], [""], ["2019-13"]])
def test_begin_needs_proper_months(spark, batches):
    with pytest.raises(ValueError):
        control.begin(control.empty(spark), batches)


def test_counts_leave_the_status(spark):
    started = control.begin(control.empty(spark), ["2019-01", "2019-02"], T0)
    counts = spark.createDataFrame([("2019-01", 744, 743)], "batch_id string, rows_bronze int, rows_silver int")
    after = state(control.record_counts(started, counts, T1))
    assert tuple(after["2019-01"])[3:8] == ("in_progress", 744, 743, AT0, AT1)
    assert after["2019-02"].rows_bronze is None and after["2019-02"].updated_at == AT0


def test_error_text_is_cut_and_loses_single_quotes(spark):
    started = control.begin(control.empty(spark), ["2019-01"], T0)
    after = state(control.fail(started, ["2019-01"], "it's " + "x" * 600, T1))["2019-01"]
    assert after.status == "failed" and after.updated_at == AT1
    assert after.error_message == "its " + "x" * 496


def test_complete_takes_only_months_in_progress(spark):
    started = control.begin(control.empty(spark), ["2019-01", "2019-02"], T0)
    table = control.fail(started, ["2019-01"], "no", T0)
    assert [r.batch_id for r in control.completable(table, ["2019-01", "2019-02", "2019-03"]).collect()] == ["2019-02"]
    after = state(control.complete(table, ["2019-01", "2019-02", "2019-03"], T1))
    assert set(after) == {"2019-01", "2019-02"}
    assert (after["2019-01"].status, after["2019-01"].updated_at) == ("failed", AT0)
    assert (after["2019-02"].status, after["2019-02"].updated_at) == ("completed", AT1)
    assert after["2019-02"].created_at == AT0


def test_next_month_is_the_earliest_that_is_not_completed(spark):
    months = ["2019-02", "2018-12", "2019-01"]
    table = control.empty(spark)
    assert chosen(spark, table, *months) == ["2018-12"]
    table = control.complete(control.begin(table, ["2018-12"], T0), ["2018-12"], T0)
    assert chosen(spark, table, *months) == ["2019-01"]
    table = control.begin(table, ["2019-01"], T0)
    assert chosen(spark, table, *months) == ["2019-01"]
    table = control.fail(table, ["2019-01"], "no", T0)
    assert chosen(spark, table, *months) == ["2019-01"]
    for m in ("2019-01", "2019-02"):
        table = control.complete(control.begin(table, [m], T1), [m], T1)
    assert chosen(spark, table, *months) == []
