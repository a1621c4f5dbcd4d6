"""The inventory of landing files: what a refresh reads, and what it tells."""

import os

import pytest

from hourmill import Inventory, Landing

HEADER = "utc_timestamp,DE_a"


@pytest.fixture
def area(spark, tmp_path, monkeypatch):
    """Puts files, and notes which are read."""

    class Area:
        root = str(tmp_path / "landing")
        looked, parsed = [], []

        def put(self, year, name, *lines, header=HEADER):
            folder = os.path.join(self.root, f"year={year}")
            os.makedirs(folder, exist_ok=True)
            with open(os.path.join(folder, name), "w", encoding="utf8") as file:
                file.write("\n".join([header, *lines]) + "\n")

    area = Area()
    first_lines, read = Landing.first_lines, Landing.read
    names = lambda paths: sorted("/".join(p.split("/")[-2:]) for p in ([paths] if isinstance(paths, str) else paths))
    monkeypatch.setattr(Landing, "first_lines", lambda self, p: (area.looked.append(names(p)), first_lines(self, p))[1])
    monkeypatch.setattr(Landing, "read", lambda self, h, p: (area.parsed.append(names(p)), read(self, h, p))[1])
    area.inventory = lambda: Inventory(Landing(spark, area.root), str(tmp_path / "inventory"))
    return area


def months(inventory):
    return {r.batch_id: (r.year, r.month, r.first_folder, r.last_folder, r.rows) for r in inventory.months().collect()}


def start(area):
    area.put(2018, "a.csv", "2018-11-30T22:00:00Z,1", "2018-12-01T00:00:00Z,2")
    area.put(2019, "a.csv", "2018-12-31T23:00:00Z,3", "2019-01-01T00:00:00Z,4")
    area.put(2019, "b.csv", "5,2019-01-02T00:00:00Z", header="DE_a,utc_timestamp")
    inventory = area.inventory()
    inventory.refresh()
    return inventory


WANT = {"2018-11": (2018, 11, 2018, 2018, 1), "2018-12": (2018, 12, 2018, 2019, 2), "2019-01": (2019, 1, 2019, 2019, 2)}


def test_months_and_their_folders(area):
    inventory = start(area)
    assert months(inventory) == WANT and inventory.malformed().count() == 0
    assert area.looked == [["year=2018/a.csv", "year=2019/a.csv", "year=2019/b.csv"]]
    assert sorted(sum(area.parsed, [])) == area.looked[0]


def test_without_new_files_nothing_is_read(area):
    start(area)
    area.looked.clear(), area.parsed.clear()
    again = area.inventory()
    before = again.table.versions()
    again.refresh()
    assert months(again) == WANT and not area.looked and not area.parsed and again.table.versions() == before


def test_only_new_and_changed_files_are_read(area):
    inventory = start(area)
    area.looked.clear(), area.parsed.clear()
    area.put(2019, "a.csv", "2019-02-01T00:00:00Z,3")
    area.put(2020, "c d.csv", "2020-01-01T00:00:00Z,9", "no time,9", ",9")
    inventory.refresh()
    assert area.looked == [["year=2019/a.csv", "year=2020/c d.csv"]] and area.parsed == area.looked
    new = {"2018-12": (2018, 12, 2018, 2018, 1), "2019-01": (2019, 1, 2019, 2019, 1), "2019-02": (2019, 2, 2019, 2019, 1)}
    assert months(inventory) == WANT | new | {"2020-01": (2020, 1, 2020, 2020, 1)}
    assert [(r.path.rsplit("/", 1)[1], r.malformed) for r in inventory.malformed().collect()] == [("c%20d.csv", 1)]


def test_files_that_are_gone_leave_it(area):
    inventory = start(area)
    area.looked.clear(), area.parsed.clear()
    os.remove(os.path.join(area.root, "year=2018", "a.csv"))
    inventory.refresh()
    assert set(months(inventory)) == {"2018-12", "2019-01"} and not area.looked and not area.parsed


def test_a_scan_reads_the_files_of_its_months_in_the_columns_of_all(area):
    area.put(2017, "z.csv", "2017-05-01T00:00:00Z,1,2", header="utc_timestamp,DE_a,DE_old")
    inventory = start(area)
    area.looked.clear(), area.parsed.clear()
    rows = inventory.scan(["2018-12"], lineage=True)
    assert rows.columns == ["utc_timestamp", "DE_a", "DE_old", "year", "source_file"] or set(rows.columns) == {
        "utc_timestamp", "DE_a", "DE_old", "year", "source_file",
    }
    assert sorted(r.DE_a for r in rows.collect()) == ["1", "2", "3", "4"] and {r.DE_old for r in rows.collect()} == {None}
    assert area.parsed == [["year=2018/a.csv", "year=2019/a.csv"]] and not area.looked
    assert inventory.scan().count() == 6
    none = inventory.scan(["1999-01"])
    assert none.count() == 0 and set(none.columns) == set(rows.columns) - {"source_file"}


def test_a_file_without_the_key_is_an_error_and_an_empty_one_is_not(area):
    inventory = start(area)
    open(os.path.join(area.root, "year=2019", "empty.csv"), "w").close()
    inventory.refresh()
    assert months(inventory) == WANT
    area.put(2019, "x.csv", "1", header="DE_a")
    with pytest.raises(ValueError, match="no column utc_timestamp"):
        inventory.refresh()
    assert months(inventory) == WANT


def test_a_year_is_scanned_by_its_own_folder(area, spark):
    start(area)
    area.put(2020, "x.csv", "1,2,3", header="utc_timestamp,DE_a,DE_a")  # a header no scan of all folders would take
    area.looked.clear()
    landing = Landing(spark, area.root)
    assert landing.scan_year(2018).count() == 2
    assert area.looked == [["landing/year={2018}"]]
    with pytest.raises(ValueError, match="twice"):
        landing.scan()
