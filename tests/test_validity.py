import datetime as dt
import random

from meterlake.operators import validity
from tests.frames import day, frame, out

AS_OF = day("2024-03-10")
DEVICE = (
    "devicelocation string, equipmentnumber string, installation bigint, register string, "
    "logicalregisternumber string, devicevaliditystartdate date, devicevalidityenddate date, "
    "registervaliditystartdate date, registervalidityenddate date"
)
CONTRACT = (
    "equipmentnumber string, register string, devicevaliditystartdate date, devicevalidityenddate date, "
    "utilitiesmoveindate date, utilitiesmoveoutdate date, businesspartnernumber string, "
    "contractaccount bigint, utilitiescontract bigint, regionalstructuregrouping string, "
    "devicelocation string"
)
OPEN = ("2000-01-01", "9999-12-31")


def device(spark, *rows):
    return frame(spark, DEVICE, *[(*r, *OPEN, *OPEN) if len(r) == 5 else r for r in rows])


def contract(spark, *rows):
    return frame(spark, CONTRACT, *rows)


def test_bounds_are_included_and_open_ends_do_not_hold(spark):
    df = frame(
        spark, "id int, a date, b date",
        (1, "2024-03-10", "2024-03-10"),
        (2, "2024-01-01", "2024-03-09"),
        (3, "2024-01-01", None),
        (4, "2024-03-11", "2024-12-31"),
    )
    assert out(validity.valid_at(df, AS_OF, ("a", "b")).select("id")) == [(1,)]


def test_no_row_outside_any_pair(spark):
    df = frame(
        spark, "id int, a date, b date, c date, d date",
        (1, *OPEN, *OPEN),
        (2, *OPEN, "2024-03-11", "2024-12-31"),
        (3, "2000-01-01", "2001-01-01", *OPEN),
    )
    assert out(validity.valid_at(df, AS_OF, ("a", "b"), ("c", "d")).select("id")) == [(1,)]


def test_points_by_location(spark):
    location = frame(spark, "functionallocation string", ("L1",), ("L1",), ("L2",))
    devices = device(
        spark,
        ("L1", "E1", 1, "001", "x"),
        ("L1", "E1", 1, "001", "x"),
        ("L1", "E1", 1, "002", "y"),
        ("L2", "E2", 2, "001", "z", "2000-01-01", "2010-01-01", *OPEN),
        ("L9", "E9", 9, "001", "z"),
    )
    contracts = contract(
        spark,
        ("E1", "001", *OPEN, *OPEN, "bp", 10, 20, "D", "L1"),
        ("E1", "002", *OPEN, "2000-01-01", "2020-01-01", "old", 11, 21, "D", "L1"),
        ("E1", "002", *OPEN, "2020-01-02", "9999-12-31", "new", 12, 22, "D", "L1"),
        ("E2", "001", *OPEN, *OPEN, "bp2", 13, 23, "D", "L2"),
    )
    points = validity.points_by_location(location, devices, contracts, AS_OF)
    got = out(points.select("functionallocation", "register", "businesspartnernumber"), "register")
    assert got == [("L1", "001", "bp"), ("L1", "002", "new")]


def test_points_by_premise_drop_sewers_and_ended_registers(spark):
    premise = frame(
        spark, "utilitiespremise string, utilitiesinstallation bigint, division string",
        ("P1", 1, "W"), ("P2", 2, "SW"), ("P3", 3, None), ("P4", 4, "W"),
    )
    devices = device(
        spark,
        ("L1", "E1", 1, "001", "x"),
        ("L2", "E2", 2, "001", "x"),
        ("L3", "E3", 3, "001", "x"),
        ("L4", "E4", 4, "001", "x", *OPEN, "2000-01-01", "2001-01-01"),
    )
    contracts = contract(
        spark, *[(f"E{i}", "001", *OPEN, *OPEN, "bp", 10, 20, "D", f"C{i}") for i in range(1, 5)]
    )
    points = validity.points_by_premise(premise, devices, contracts, AS_OF)
    assert out(points.select("utilities_premise", "devicelocation")) == [("P1", "C1")]


def test_enrich_on_any_frame(spark):
    reads = frame(spark, "functionallocation string, v int", ("L1", 1), ("L2", 2), ("L3", 3))
    location = frame(spark, "functionallocation string", ("L1",), ("L2",), ("L2",))
    known = validity.enrich_location(reads, location)
    assert out(known.select("v"), "v") == [(1,), (2,)]
    devices = device(spark, ("L1", "E1", 1, "001", "x"))
    assert out(validity.enrich_device(known, devices, AS_OF).select("v", "equipmentnumber")) == [(1, "E1")]
    premises = frame(
        spark, "utilitiespremise string, utilitiesinstallation bigint, division string", ("7", 1, "W")
    )
    by_premise = frame(spark, "utilities_premise string, v int", ("7", 5))
    got = validity.enrich_premise(by_premise, premises, devices, AS_OF)
    assert out(got.select("v", "installation")) == [(5, 1)]


def overlaps_by_hand(rows):
    holds = [r for r in rows if r[0] is not None and r[1] and r[2] and r[1] <= r[2]]
    return sorted(
        (a for i, a in enumerate(holds) if any(i != j and a[0] == b[0] and a[1] <= b[2] and b[1] <= a[2] for j, b in enumerate(holds))),
        key=str,
    )


def test_overlapping(spark):
    rng = random.Random(7)
    rows = [("k", "2024-01-01", "2024-01-05"), ("k", "2024-01-05", "2024-01-09"), ("k", "2024-01-10", "2024-01-10"),
            ("m", "2024-01-01", "2024-01-01"), ("m", "2024-01-01", "2024-01-01"), ("m", "2024-02-02", "2024-02-01"),
            (None, "2024-01-01", "2024-01-05"), (None, "2024-01-01", "2024-01-05"), ("n", None, "2024-01-05"), ("n", "2024-01-01", None)]
    for _ in range(300):
        a = dt.date(2023, 1, 1) + dt.timedelta(days=rng.randrange(300))
        rows.append((f"x{rng.randrange(40)}", str(a), str(a + dt.timedelta(days=rng.randrange(-3, 25)))))
    df = frame(spark, "key string, start date, end date", *rows)
    got = validity.overlapping(df, ["key"], "start", "end")
    assert got.columns == ["key", "start", "end"]
    assert sorted([(r[0], str(r[1]), str(r[2])) for r in got.collect()], key=str) == overlaps_by_hand(rows)
    assert validity.overlapping(df.where("false"), ["key"], "start", "end").count() == 0


def test_ambiguous_points(spark):
    device = frame(
        spark, "devicelocation string, register string, devicevaliditystartdate date, devicevalidityenddate date",
        ("a", "1", "2024-01-01", "2024-12-31"), ("a", "1", "2024-02-01", "2024-12-31"), ("a", "2", "2024-01-01", "2024-12-31"),
    )
    contract = frame(
        spark, "equipmentnumber string, register string, devicevaliditystartdate date, devicevalidityenddate date, "
        "utilitiesmoveindate date, utilitiesmoveoutdate date",
        ("e", "1", "2024-01-01", "2024-12-31", "2020-01-01", "2024-01-31"),
        ("e", "1", "2024-01-01", "2024-12-31", "2024-02-01", "2025-01-31"),
    )
    assert out(validity.ambiguous_points(device, contract, dt.date(2024, 3, 1))) == [("installed_devices", "a", "1", 2)]
    assert out(validity.ambiguous_points(device, contract, dt.date(2024, 1, 15))) == []
