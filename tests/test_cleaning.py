"""Hand-made frames for scoping, typing, deduplication and null profiles."""

import pytest
from pyspark.errors import PySparkException

from hourmill import GERMAN_POWER, bronze_batch, require_utc, silver_batch
from hourmill.operators import (
    bulk_cast_double,
    dedupe_latest,
    filter_month,
    list_batches,
    normalize_names,
    null_profile,
    parse_timestamps,
    project_prefix,
)

BOUNDARY = [
    ("2018-12-31T23:00:00Z", "2019-01-01T00:00:00+0100"),
    ("2019-01-01T00:00:00Z", "2019-01-01T01:00:00+0100"),
]
TIMES = "utc_timestamp string, cet_cest_timestamp string"


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_prefix_is_case_sensitive_and_other_columns_go(spark):
    df = spark.createDataFrame([("t", "l", "1", "2", "3")], f"{TIMES}, DE_a string, de_b string, FR_load string")
    assert project_prefix(df, "DE_", GERMAN_POWER.time_columns).columns == [*GERMAN_POWER.time_columns, "DE_a"]


def test_dotted_names_survive(spark):
    df = spark.createDataFrame([("t", "l", "1.5")], f"{TIMES}, `DE_a.b` string")
    scoped = normalize_names(project_prefix(df, "DE_", GERMAN_POWER.time_columns))
    assert rows(bulk_cast_double(scoped, "de_")) == [("t", "l", 1.5)]


def test_names_differing_by_case_are_an_error(spark):
    df = spark.range(1).selectExpr("1 AS x").toDF("DE_a")
    assert normalize_names(df).columns == ["de_a"]
    with pytest.raises(ValueError, match="de_a"):
        normalize_names(spark.range(1).selectExpr("1 AS x", "2 AS y").toDF("DE_a", "de_A"))


def test_midnight_hour_belongs_to_the_utc_month(spark):
    df = spark.createDataFrame(BOUNDARY, TIMES)
    assert rows(list_batches(df)) == [("2018-12", 2018, 12), ("2019-01", 2019, 1)]
    assert rows(filter_month(df, "2018-12")) == [BOUNDARY[0]]
    parsed = parse_timestamps(df)
    assert [r[0] == r[1] for r in parsed.collect()] == [True, True]
    assert rows(list_batches(parsed)) == [("2018-12", 2018, 12), ("2019-01", 2019, 1)]
    assert filter_month(parsed, "2019-01").count() == 1


def test_rows_without_a_time_are_in_no_month(spark):
    df = spark.createDataFrame([(None, None), BOUNDARY[0]], TIMES)
    assert rows(list_batches(df)) == [("2018-12", 2018, 12)]
    assert filter_month(df, "2018-12").count() == 1


@pytest.mark.parametrize("batch", ["", None, "2018-13", "2018-1", "2018"])
def test_batches_are_checked(spark, batch):
    with pytest.raises(ValueError):
        filter_month(spark.createDataFrame(BOUNDARY, TIMES), batch)


def test_malformed_values_raise_or_become_null(spark):
    bad = spark.createDataFrame([("soon", BOUNDARY[0][1], "abc"), (*BOUNDARY[1], "2.5")], f"{TIMES}, de_a string")
    for strict in (parse_timestamps(bad), bulk_cast_double(bad, "de_"), list_batches(bad)):
        with pytest.raises(PySparkException):
            strict.collect()
    assert sorted(r[0] is None for r in parse_timestamps(bad, on_error="null").collect()) == [False, True]
    assert sorted((r.de_a for r in bulk_cast_double(bad, "de_", "null").collect()), key=repr) == [2.5, None]
    assert rows(list_batches(bad, on_error="null")) == [("2019-01", 2019, 1)]


def test_other_session_zones_are_refused(spark):
    df = spark.createDataFrame(BOUNDARY, TIMES)
    spark.conf.set("spark.sql.session.timeZone", "Europe/Berlin")
    try:
        with pytest.raises(ValueError, match="UTC"):
            filter_month(df, "2018-12")
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert require_utc(spark) is spark


def test_tied_rows_have_one_winner_whatever_the_partitioning(spark):
    data = [(1, 5, "a", float(i)) for i in range(50)] + [(1, 5, "b", 0.5), (1, 4, "z", 9.0), (None, 1, "a", 1.0)]
    for parts in (1, 3, 7):
        df = spark.createDataFrame(data, "k int, t int, source_file string, v double").repartition(parts)
        assert rows(dedupe_latest(df, ["k"], ["t"])) == [(1, 5, "b", 0.5), (None, 1, "a", 1.0)]


def test_a_hot_key_is_thinned_before_the_shuffle(spark):
    df = spark.range(10_000, numPartitions=8).selectExpr("if(id % 3 = 0, -1, id) AS k", "id AS t")
    latest = dedupe_latest(df, ["k"], ["t"])
    assert latest.where("k = -1").collect() == [(-1, 9_999)]
    plan = latest._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2 and "Partial" in plan


def test_null_profile_counts_and_rounds(spark):
    df = spark.createDataFrame([(None, 1.0)] * 9 + [(1.0, None)] * 711, "a double, b double")
    assert rows(null_profile(df, ["a", "b"])) == [("a", 9, 1.3), ("b", 711, 98.8)]
    assert rows(null_profile(df.limit(0), ["a"])) == [("a", 0, 0.0)]


def test_bronze_and_silver_columns(spark):
    schema = f"{TIMES}, DE_load string, FR_load string, source_file string"
    raw = spark.createDataFrame([(*BOUNDARY[0], "1.50", "7", "f"), (*BOUNDARY[1], None, "7", "f")], schema)
    bronze = bronze_batch(raw, batches=["2018-12"], as_of="2020-01-01 00:00:00")
    assert bronze.columns == [
        "utc_timestamp", "cet_cest_timestamp", "DE_load", "source_file", "batch_id", "ingestion_timestamp",
    ]
    assert [(r.DE_load, r.batch_id) for r in bronze.collect()] == [("1.50", "2018-12")]
    silver = silver_batch(bronze)
    assert dict(silver.dtypes) == {
        "utc_timestamp": "timestamp", "cet_cest_timestamp": "timestamp", "de_load": "double",
        "source_file": "string", "batch_id": "string", "ingestion_timestamp": "timestamp",
        "year": "int", "month": "int",
    }
    assert [(r.de_load, r.year, r.month) for r in silver.collect()] == [(1.5, 2018, 12)]
    assert {r.batch_id for r in bronze_batch(raw).collect()} == {"2018-12", "2019-01"}
