"""CSV year folders: headers that differ, missing folders, lineage."""

import pytest
from py4j.protocol import Py4JJavaError
from pyspark.sql import functions as F

from hourmill import Landing


@pytest.fixture
def put(tmp_path):
    def write(year, name, *lines):
        folder = tmp_path / f"year={year}"
        folder.mkdir(exist_ok=True)
        (folder / name).write_text("\n".join(lines) + "\n", encoding="utf8")

    write.root = str(tmp_path)
    return write


def rows(df, *names):
    return sorted((tuple(r) for r in df.select(*names).collect()), key=repr)


ALL = [("10", "1", 2014), ("20", "2", 2015), ("30", "3", 2015)]


def test_columns_in_another_order_keep_their_names(spark, put):
    put(2014, "a.csv", "utc_timestamp,DE_a", "10,1")
    put(2015, "a.csv", "DE_a,utc_timestamp", "2,20", "3,30")
    landing = Landing(spark, put.root)
    assert rows(landing.scan(), "utc_timestamp", "DE_a", "year") == ALL
    assert rows(landing.scan_year(2015), "utc_timestamp", "DE_a") == [r[:2] for r in ALL[1:]]
    assert sorted(landing.scan_year(2015).columns) == ["DE_a", "utc_timestamp"]


def test_a_folder_with_several_headers(spark, put):
    put(2014, "a.csv", "utc_timestamp,DE_a", "10,1")
    put(2015, "a b.csv", "DE_a,utc_timestamp", "2,20")
    put(2015, "b.csv", "utc_timestamp,DE_a,DE_b", "30,3,x")
    landing = Landing(spark, put.root)
    assert rows(landing.scan(), "utc_timestamp", "DE_a", "year") == ALL
    assert rows(landing.scan(), "DE_b") == [("x",), (None,), (None,)]
    files = {r[0].rsplit("/", 1)[1] for r in landing.scan(lineage=True).select("source_file").collect()}
    assert files == {"a.csv", "a%20b.csv", "b.csv"}


def test_one_header_is_read_as_one_scan(spark, put):
    for year in (2014, 2015, 2016):
        put(year, "a.csv", "utc_timestamp,DE_a", f"{year},1")
    landing = Landing(spark, put.root)
    assert len(landing._scans(f"{put.root}/year=*")) == 1
    assert rows(landing.scan(2015, 2018), "utc_timestamp") == [("2015",), ("2016",)]
    plan = landing.scan(2015, 2015).select("utc_timestamp")._jdf.queryExecution().executedPlan().toString()
    assert "year" in plan.split("PartitionFilters: [")[1].split("]")[0]
    assert "ReadSchema: struct<utc_timestamp:string>" in plan


def test_same_headers_are_checked_by_the_scan(spark, put):
    put(2014, "a.csv", "utc_timestamp,DE_a", "10,1")
    put(2015, "a.csv", "utc_timestamp,DE_a", "20,2", "30,3")
    assert rows(Landing(spark, put.root, headers="same").scan(), "utc_timestamp", "DE_a", "year") == ALL
    put(2016, "a.csv", "DE_a,utc_timestamp", "4,40")
    with pytest.raises(Py4JJavaError, match="CSV header does not conform"):
        Landing(spark, put.root, headers="same").scan().select("utc_timestamp", "DE_a").collect()
    with pytest.raises(ValueError):
        Landing(spark, put.root, headers="any")


def test_quotes_byte_order_marks_and_empty_fields(spark, put):
    put(2014, "a.csv", '\ufeffutc_timestamp,"DE_a, b"', '10,""', "20,")
    df = Landing(spark, put.root).scan()
    assert df.columns == ["utc_timestamp", "DE_a, b", "year"]
    assert rows(df, "utc_timestamp") == [("10",), ("20",)]
    assert df.select(F.count(F.col("`DE_a, b`"))).collect()[0][0] == 0


def test_a_repeated_name_in_a_header_is_an_error(spark, put):
    put(2014, "a.csv", "utc_timestamp,DE_a,DE_a", "1,2,3")
    with pytest.raises(ValueError, match="twice"):
        Landing(spark, put.root).scan()


def test_a_long_file_gives_only_its_first_line(spark, put):
    put(2014, "a.csv", "utc_timestamp,DE_a", *(f"{i},{i}" for i in range(200_000)))
    landing = Landing(spark, put.root)
    assert landing.scan().count() == 200_000


def test_years_without_a_folder_are_empty(spark, put):
    put(2014, "a.csv", "utc_timestamp,DE_a", "10,1")
    assert Landing(spark, put.root).scan_year(1999).count() == 0


def test_the_session_settings_stay(spark, put):
    put(2014, "a.csv", "utc_timestamp,DE_a", "10,1")
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    Landing(spark, put.root).scan().collect()
    assert spark.conf.get("spark.sql.files.maxPartitionBytes") == before


def test_files_that_come_later_are_read_by_name(spark, tmp_path):
    def put(year, name, text):
        folder = tmp_path / f"year={year}"
        folder.mkdir(exist_ok=True)
        (folder / name).write_text(text)

    put(2018, "a.csv", "utc_timestamp,DE_a,DE_b\n2018,1,2\n")
    put(2019, "a.csv", "utc_timestamp,DE_a\n2019,3\n")
    landing = Landing(spark, str(tmp_path))
    assert landing.scan().count() == 2
    put(2020, "a.csv", "utc_timestamp,DE_a,DE_b\n2020,4,5\n")
    put(2018, "b.csv", "utc_timestamp,DE_b,DE_a\n2018,7,6\n")
    rows = {(r.utc_timestamp, r.DE_a, r.DE_b) for r in landing.scan().collect()}
    assert rows == {("2018", "1", "2"), ("2019", "3", None), ("2020", "4", "5"), ("2018", "6", "7")}
