"""Seeded export files with the 14 source layouts and known defects."""

from __future__ import annotations

import os
import random
from datetime import date, datetime, timedelta

from roadledger.model import SOURCES

LOADS = 240
DRIVERS, TRUCKS, TRAILERS, CUSTOMERS, FACILITIES, ROUTES = 12, 10, 8, 15, 6, 9


def _key(prefix: str, i: int) -> str:
    return f"{prefix}{i:05d}"


def rows(seed: int = 7) -> dict[str, list[list[str]]]:
    """Source name -> rows of text fields."""
    r = random.Random(seed)
    out: dict[str, list[list[str]]] = {name: [] for name in SOURCES}

    def day(i: int) -> date:
        return date(2022, 1, 1) + timedelta(days=i % 1095)

    for i in range(DRIVERS):
        out["drivers"].append(
            [
                _key("DRV", i),
                f" First{i} ",
                f"Last{i}",
                str(day(i * 30)),
                "",
                f"L{i}",
                "TX",
                "1980-02-30" if i == 3 else "1980-02-03",
                "  ",
                "" if i == 1 else ("Terminated" if i % 5 == 4 else "Active"),
                "A",
                "3.0" if i == 2 else str(i),
            ]
        )
    # A name is missing and a key is blank: both refused.
    out["drivers"].append(["DRV90001", " ", "Nameless"] + [""] * 6 + ["Active", "A", "1"])
    out["drivers"].append(["  ", "No", "Key"] + [""] * 6 + ["Active", "A", "1"])
    for i in range(TRUCKS):
        out["trucks"].append(
            [
                _key("TRK", i),
                f"U{i}",
                ["Volvo", "Mack"][i % 2],
                str(2015 + i % 6),
                f"V{i}",
                str(day(i)),
                "1,234" if i == 4 else "1000",
                "Diesel",
                "200",
                ["Active", "Maintenance", "Inactive", ""][i % 4],
                f"Hub{i % 3}",
            ]
        )
    for i in range(TRAILERS):
        out["trailers"].append(
            [_key("TRL", i), f"N{i}", "Reefer", "53", "2018", f"V{i}", str(day(i)), "Active", "Hub"]
        )
    for i in range(CUSTOMERS):
        out["customers"].append(
            [
                _key("CUST", i),
                f"Name{i // 2}",
                ["Dedicated", "Contract", "Spot"][i % 3],
                "30",
                "Dry",
                "Active" if i % 4 else "Inactive",
                str(day(i)),
                "1e3" if i == 5 else str(1000 * i),
            ]
        )
    for i in range(FACILITIES):
        out["facilities"].append(
            [
                _key("FAC", i),
                f"Dock{i}",
                "Warehouse",
                f"City{i}",
                "TX",
                "29.1234567",
                "-95.5",
                "12",
                "24/7",
            ]
        )
    for i in range(ROUTES):
        out["routes"].append(
            [
                _key("RTE", i),
                f"City{i}",
                "TX",
                "" if i == 7 else f"City{(i + 1) % ROUTES}",
                "GA",
                "0" if i == 0 else str(100 * i),
                "2.25",
                "0.125",
                "2",
            ]
        )
    for i in range(LOADS):
        customer = _key("CUST", i % CUSTOMERS)
        if i % 40 == 1:
            customer = " "
        if i % 40 == 2:
            customer = "CUST99999"
        when = str(day(i * 4))
        if i == 50:
            when = "not a date"
        if i == 51:
            when = "2031-01-01"
        out["loads"].append(
            [
                _key("LOAD", i),
                customer,
                _key("RTE", i % ROUTES),
                when,
                ["Dry Van", " Refrigerated "][i % 2],
                "0" if i % 30 == 0 else str(10000 + i),
                str(i % 20),
                "" if i % 60 == 7 else f"{1000 + i}.005",
                "100.10",
                "20",
                "Completed",
                ["Spot", "Dedicated", "Contract"][i % 3],
            ]
        )
        dispatch = day(i * 4 + 1)
        out["trips"].append(
            [
                _key("TRIP", i),
                _key("LOAD", i),
                "" if i % 50 == 3 else _key("DRV", i % DRIVERS),
                "" if i % 50 == 5 else _key("TRK", i % TRUCKS),
                "TRL99999" if i % 50 == 9 else _key("TRL", i % TRAILERS),
                str(dispatch),
                f"{r.randint(100, 2000)}.5",
                "0" if i % 80 == 0 else f"{r.randint(2, 40)}.25",
                "150.5",
                f"{r.randint(5, 7)}.{r.randint(10, 99)}",
                "1.5",
                "Completed",
            ]
        )
        for kind in ("Pickup", "Delivery"):
            scheduled = datetime(2022, 1, 1) + timedelta(days=(i * 4) % 1095, hours=r.randint(0, 20))
            late = r.randint(-60, 120)
            out["delivery_events"].append(
                [
                    f"EVT{i:05d}{kind[0]}",
                    _key("LOAD", i),
                    _key("TRIP", i),
                    kind,
                    _key("FAC", (i + len(kind)) % FACILITIES),
                    str(scheduled),
                    f"{scheduled + timedelta(minutes=late)}.6",
                    str(r.randint(0, 180)),
                    "maybe" if i % 70 == 0 else str(late <= 0),
                    f"City{i % 5}",
                    "TX",
                ]
            )
        for j in range(2):
            out["fuel_purchases"].append(
                [
                    f"FUEL{i:05d}{j}",
                    _key("TRIP", i),
                    "" if (i + j) % 25 == 0 else _key("TRK", i % TRUCKS),
                    _key("DRV", i % DRIVERS),
                    f"{dispatch} 08:15:00",
                    f"City{i % 5}",
                    "TX",
                    "100.00",
                    "3.505",
                    "350.50",
                    f"C{i}",
                ]
            )
    # One purchase was delivered three times alike, and once with another cost.
    out["fuel_purchases"] += [list(out["fuel_purchases"][0]) for _ in range(2)]
    other = list(out["fuel_purchases"][0])
    other[9] = "99999999999.99"
    out["fuel_purchases"].append(other)
    for i in range(40):
        out["maintenance_records"].append(
            [
                f"MNT{i:05d}",
                _key("TRK", i % TRUCKS),
                "" if i == 11 else str(day(i * 20)),
                ["Repair", "Inspection"][i % 2],
                str(100000 + i),
                "2.5",
                "200",
                "50.25",
                "250.25",
                "Hub0",
                "4",
                f"oil, filter, {i}",
            ]
        )
        flag = ["True", "False", "", "yes"]
        out["safety_incidents"].append(
            [
                f"INC{i:05d}",
                _key("TRIP", i),
                _key("TRK", i % TRUCKS),
                _key("DRV", i % DRIVERS),
                str(day(i * 25)),
                "Collision",
                "City1",
                "TX",
                flag[i % 4],
                flag[(i + 1) % 4],
                "1000",
                "200.5",
                "1200.5",
                flag[(i + 2) % 4],
                "hit, run",
            ]
        )
    for m in range(36):
        month = f"{2022 + m // 12}-{m % 12 + 1:02d}-01"
        for i in range(DRIVERS):
            out["driver_monthly_metrics"].append(
                [_key("DRV", i), month, "5", "1000.5", "2000", "6.5", "150", "0.44", "3"]
            )
        for i in range(TRUCKS):
            out["truck_utilization_metrics"].append(
                [
                    _key("TRK", i),
                    month,
                    "5",
                    "1000.5",
                    "2000",
                    f"6.{i}",
                    str(i % 2),
                    "100.5",
                    "3.5",
                    f"0.{800 + i}",
                ]
            )
    # Two unknown drivers in one month share the Unknown key.
    for _ in range(2):
        out["driver_monthly_metrics"].append(
            ["DRV99999", "2022-01-01", "1", "10", "20", "6", "1", "0.5", "1"]
        )
    out["driver_monthly_metrics"][-1][0] = "DRV99998"
    return out


def write(directory: str, tables: dict[str, list[list[str]]] | None = None) -> None:
    """Write ``<source>.csv`` files; loads end with a short line."""
    os.makedirs(directory, exist_ok=True)
    for name, lines in (tables or rows()).items():
        with open(f"{directory}/{name}.csv", "w", newline="\n") as f:
            f.write(",".join(SOURCES[name].column_names) + "\n")
            for fields in lines:
                f.write(",".join(fields) + "\n")
            if name == "loads":
                f.write("LOAD99999,CUST00001\n")
