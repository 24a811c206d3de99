"""Batches of unseen and changed files (RM-1, SRC-7)."""

import os

import pytest

from roadledger.plans import incremental
from roadledger.plans.incremental import take_new_files
from roadledger.sources.ledger import FileLedger
from roadledger.sources.tables import Warehouse
from tests import exports

KEY = "fuel_purchase_id"
YEARS = {"year": "year(purchase_date)"}


def purchase(key, day, gallons="10"):
    return [key, "TRIP1", "TRK1", "DRV1", f"{day} 08:00:00" if day else "", "Town", "TX", gallons,
            "3.5", "35.00", "C1"]


class Landing:
    """A folder of export files with set times, loaded into a warehouse of its own."""

    def __init__(self, spark, top):
        self.top, self.folder = str(top), f"{top}/landing"
        self.warehouse = Warehouse(spark, f"{top}/wh")
        os.makedirs(self.folder)

    def put(self, name, lines, time):
        path = f"{self.folder}/{name}"
        exports.write(f"{self.top}/made", {"fuel_purchases": lines})
        with open(f"{self.top}/made/fuel_purchases.csv") as made, open(path, "w") as f:
            f.write(made.read())
        os.utime(path, (1_700_000_000 + time, 1_700_000_000 + time))
        return path

    def take(self, **options):
        return take_new_files(self.warehouse, "fuel_purchases", self.folder, YEARS, **options)

    def table(self):
        rows = self.warehouse.read("silver", "fact_fuel").select(KEY, "gallons", "year").collect()
        return sorted((r[0], float(r[1]), r[2]) for r in rows)

    def ledger(self):
        lines = FileLedger(self.warehouse, "fuel_purchases").read().collect()
        return sorted((os.path.basename(r["file"]), r["rows"], r["batch"]) for r in lines)


@pytest.fixture
def landing(spark, tmp_path):
    return Landing(spark, tmp_path)


def test_a_second_run_reads_no_file_and_a_changed_one_reads_that(landing):
    a = landing.put("a.csv", [purchase("P1", "2023-01-01"), purchase("P2", "2024-01-01")], 1)
    landing.put("b.csv", [purchase("P1", "2023-01-01", "11"), purchase("", "2023-01-01")], 2)
    landing.put("none.csv", [], 3)
    assert landing.take() == [3]
    first = [("P1", 11.0, 2023), ("P2", 10.0, 2024)]
    assert landing.table() == first
    assert landing.ledger() == [("a.csv", 2, 0), ("b.csv", 2, 0), ("none.csv", 0, 0)]
    refused = landing.warehouse.read_all("audit", "refused_files_fact_fuel").collect()
    assert [(r["_reject"], r["batch"]) for r in refused] == [("missing fuel_purchase_id", 0)]
    # Other text under the same size and time would show if a body were read.
    size = os.path.getsize(a)
    with open(a, "w") as f:
        f.write("x" * size)
    os.utime(a, (1_700_000_001, 1_700_000_001))
    assert landing.take() == [] and landing.table() == first and len(landing.ledger()) == 3
    # Rewritten at a later time: a new version, and the newest word on P1 and P2.
    landing.put("a.csv", [purchase("P1", "2023-01-01", "12"), purchase("P2", "2025-01-01")], 9)
    assert landing.take() == [1]
    assert landing.table() == [("P1", 12.0, 2023), ("P2", 10.0, 2025)]
    assert landing.ledger()[:2] == [("a.csv", 2, 0), ("a.csv", 2, 1)]
    # An older file that comes late replaces nothing newer.
    landing.put("late.csv", [purchase("P1", "2023-01-01", "1"), purchase("P3", "2023-01-01")], 5)
    assert landing.take() == [1]
    assert landing.table() == [("P1", 12.0, 2023), ("P2", 10.0, 2025), ("P3", 10.0, 2023)]


def test_batches_of_any_size_give_one_table(spark, tmp_path):
    tables = []
    for n in (1, 2, 100):
        os.makedirs(f"{tmp_path}/{n}")
        landing = Landing(spark, f"{tmp_path}/{n}")
        for t in range(3):
            name = ["a b.csv", "c[1].csv", "d%20{x}*.csv"][t]
            lines = [purchase(f"P{i}", f"2023-0{1 + i}-01", str(10 * t + i)) for i in range(t, 4)]
            landing.put(name, lines, 9 - t)
        assert landing.take(files_per_batch=n) == {1: [1, 1, 1], 2: [2, 1], 100: [3]}[n]
        assert sorted(r[1] for r in landing.ledger()) == [2, 3, 4]
        tables.append(landing.table())
    assert tables[0] == tables[1] == tables[2]
    assert [t[1] for t in tables[0]] == [0.0, 1.0, 2.0, 3.0]


def test_a_run_that_breaks_before_the_ledger_is_repeated(landing, monkeypatch):
    landing.put("a.csv", [purchase("P1", "2023-01-01"), purchase("", "")], 1)

    def fails(*_):
        raise RuntimeError("lost")

    with monkeypatch.context() as m:
        m.setattr(incremental.FileLedger, "record", fails)
        with pytest.raises(RuntimeError):
            landing.take()
    merged = landing.table()
    assert merged == [("P1", 10.0, 2023)] and landing.ledger() == []
    assert landing.take() == [1] and landing.table() == merged
    assert landing.ledger() == [("a.csv", 2, 0)]
    assert landing.warehouse.read_all("audit", "refused_files_fact_fuel").count() == 1


def test_an_empty_folder(landing):
    assert landing.take() == [] and landing.ledger() == []
