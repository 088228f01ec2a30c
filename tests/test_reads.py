"""The enriched reads on hand-made meters."""

from dataclasses import replace
from decimal import Decimal

import pytest

from pyspark.sql import functions as F

from meterlake import Params
from meterlake.operators import marts
from meterlake.plans import reads
from tests.frames import day, frame, out, ts
from tests.test_validity import OPEN, contract, device

PARAMS = Params(as_of=day("2024-03-10"), slot_begin=ts("2024-03-08 12:00:00"))
CUSTOMER = (
    "meter_id string, transponder_id string, transponder_port string, customer_id bigint, "
    "reading_value double, unit_of_measure string, reading_datetime timestamp_ntz, timezone string, "
    "battery_voltage string, ingest_watermark timestamp_ntz"
)
ACCOUNT = (
    "meter_id string, miu_serial_number string, account_id bigint, reading double, "
    "read_date_time timestamp_ntz, ingest_watermark timestamp_ntz"
)


def customer(spark, *rows):
    """(meter, customer, value, time[, watermark])"""
    full = [(m, "T", "1", c, v, "GAL", t, "CST", "3", (w or [t])[0]) for m, c, v, t, *w in rows]
    return frame(spark, CUSTOMER, *full)


@pytest.fixture(scope="module")
def master(spark):
    location = frame(spark, "functionallocation string", ("7",), ("8",))
    devices = device(spark, ("7", "0E7", 70, "001", "x"), ("7", "0E7", 70, "002", "y"), ("8", "E8", 80, "001", "z"))
    contracts = contract(
        spark,
        ("0E7", "001", *OPEN, *OPEN, "b7", 71, 72, "D1", "7"),
        ("0E7", "002", *OPEN, *OPEN, "b7", 71, 72, "D1", "7"),
        ("E8", "001", *OPEN, *OPEN, "b8", 81, 82, "D2", "8"),
    )
    return location, devices, contracts


def test_hourly(spark, master):
    readings = customer(
        spark,
        ("m7", 7, 1.0, "2024-03-07 23:59:59"),
        ("m7", 7, 2.0, "2024-03-08 00:00:00"),
        ("m7", 7, 4.5, "2024-03-08 01:00:00"),
        ("m9", 9, 4.5, "2024-03-08 01:00:00"),
    )
    df = reads.hourly_reads(readings, *master, PARAMS)
    assert tuple(df.columns) == marts.READ_COLUMNS
    got = out(df.select("read_interval_type", "register", "consumption", "read_interval", "contract", "district"),
              "reading_datetime", "register")
    assert got == [
        ("HOURLY", "001", None, None, 72, "D1"),
        ("HOURLY", "002", None, None, 72, "D1"),
        ("HOURLY", "001", Decimal("2.50"), 3600, 72, "D1"),
        ("HOURLY", "002", Decimal("2.50"), 3600, 72, "D1"),
    ]


def test_zoned_sources(spark, master):
    """Catalog tables may hold timestamps with a zone, and validity dates as timestamps."""
    location, devices, contracts = master
    readings = customer(
        spark, ("m8", 8, 1.0, "2024-03-08 00:00:00"), ("m8", 8, 2.5, "2024-03-11 00:00:00"),
        ("m8", 8, 3.5, "2024-03-11 00:00:01"),
    )
    zoned = readings.withColumn("reading_datetime", F.col("reading_datetime").cast("timestamp"))
    dated = devices.withColumn("devicevalidityenddate", F.lit("2024-03-10 00:00:00").cast("timestamp"))
    df = reads.hourly_reads(zoned, location, dated, contracts, PARAMS)
    assert out(df.select("consumption", "read_interval"), "read_interval") == [(None, None), (Decimal("1.50"), 259200)]


def test_interval_suffix(spark, master):
    readings = customer(spark, ("m8", 8, 1.0, "2024-03-08 00:00:00"))
    df = reads.hourly_reads(readings, *master, replace(PARAMS, interval_suffix="_X"))
    assert out(df.select("read_interval_type")) == [("HOURLY_X",)]


def test_daily_two_registers(spark, master):
    readings = customer(
        spark,
        ("m7", 7, 1.0, "2024-03-08 01:00:00"),
        ("m7", 7, 5.0, "2024-03-08 23:00:00"),
        ("m7", 7, 9.0, "2024-03-09 23:00:00"),
        ("m7", 7, 9.5, "2024-03-10 00:00:00"),
        ("m7", 7, 9.9, "2024-03-10 00:00:01"),
    )
    view = ["reading_value", "register", "consumption", "read_interval"]
    df = reads.daily_reads(readings, *master, PARAMS).select(*view)
    assert out(df, "reading_value", "register") == [
        (5.0, "001", None, None), (5.0, "002", None, None),
        (9.0, "001", Decimal("4.00"), 86400), (9.0, "002", Decimal("4.00"), 86400),
        (9.5, "001", Decimal("0.50"), 3600), (9.5, "002", Decimal("0.50"), 3600),
    ]
    parity = reads.daily_reads(readings, *master, replace(PARAMS, parity=True)).select(*view)
    assert out(parity, "reading_value", "register") == [
        (5.0, "001", None, None), (5.0, "002", Decimal("0.00"), 0),
        (9.0, "001", Decimal("4.00"), 86400), (9.0, "002", Decimal("0.00"), 0),
        (9.5, "001", Decimal("0.50"), 3600), (9.5, "002", Decimal("0.00"), 0),
    ]


def test_daily_repeated_ingest(spark, master):
    """Two ingests of one reading, told apart by their watermark alone."""
    readings = customer(
        spark,
        ("m8", 8, 5.0, "2024-03-08 23:00:00"),
        ("m8", 8, 9.0, "2024-03-09 23:00:00", "2024-03-09 23:30:00"),
        ("m8", 8, 9.0, "2024-03-09 23:00:00", "2024-03-09 23:40:00"),
    )
    view = ["reading_value", "consumption"]
    df = reads.daily_reads(readings, *master, PARAMS).select(*view)
    assert out(df, *view) == [(5.0, None), (9.0, Decimal("4.00"))]
    parity = reads.daily_reads(readings, *master, replace(PARAMS, parity=True)).select(*view)
    assert out(parity, *view) == [(5.0, None), (9.0, Decimal("0.00")), (9.0, Decimal("4.00"))]


def test_account_feed(spark, master):
    premise = frame(
        spark, "utilitiespremise string, utilitiesinstallation bigint, division string",
        ("17", 70, "W"), ("18", 80, "SW"),
    )
    readings = frame(
        spark, ACCOUNT,
        ("a7", "s", 17, 1.0, "2024-03-08 00:00:00", None),
        ("a7", "s", 17, 3.0, "2024-03-08 01:00:00", None),
        ("a8", "s", 18, 3.0, "2024-03-08 01:00:00", None),
    )
    hourly = reads.hourly_reads_account(readings, premise, *master[1:], PARAMS)
    assert tuple(hourly.columns) == (*marts.READ_COLUMNS, "utilities_premise")
    got = out(hourly.where("register = '001'").select(
        "utilities_premise", "functionallocation", "timezone", "unit_of_measure", "consumption"), "consumption")
    assert got == [("17", "7", "GMT", "", None), ("17", "7", "GMT", "", Decimal("2.00"))]
    daily = reads.daily_reads_account(readings, premise, *master[1:], PARAMS)
    assert out(daily.select("register", "reading_value"), "register") == [("001", 3.0), ("002", 3.0)]
    wide = replace(PARAMS, days_minus_hourly=-400)
    late = replace(wide, as_of=day("2024-06-01"))
    assert reads.hourly_reads_account(readings, premise, *master[1:], late).count() == 4
    assert reads.hourly_reads_account(readings, premise, *master[1:], replace(late, parity=True)).count() == 0


def test_backfill(spark, master):
    location, devices, contracts = master
    renamed = contracts.withColumnsRenamed({v: k for k, v in reads.BACKFILL_CONTRACT.items()})
    readings = customer(
        spark,
        ("m7", 7, 1.0, "2024-03-08 12:00:00"),
        ("m7", 7, 2.0, "2024-03-08 12:00:01"),
        ("m7", 7, 4.0, "2025-03-08 12:00:01"),
        ("m8", 8, 4.0, "2025-03-08 12:00:01"),
    )
    params = replace(PARAMS, districts=("D1",))
    hourly = reads.backfill_hourly(readings, location, devices, renamed, params)
    assert tuple(hourly.columns) == reads.BACKFILL_COLUMNS
    assert len(hourly.columns) == 16
    got = out(hourly.where("register = '002'").select("reading_value", "consumption"), "reading_value")
    assert got == [(2.0, None), (4.0, Decimal("2.00"))]
    daily = reads.backfill_daily(readings, location, devices, renamed, params)
    assert daily.count() == 4
    assert reads.backfill_daily(readings, location, devices, renamed, PARAMS).count() == 5
    with pytest.raises(ValueError):
        reads.backfill_hourly(readings, location, devices, renamed, replace(params, slot_begin=None))


def test_backfill_of_a_meter_that_moved(spark, master):
    """The reading before may belong to another district."""
    location, devices, contracts = master
    renamed = contracts.withColumnsRenamed({v: k for k, v in reads.BACKFILL_CONTRACT.items()})
    readings = customer(
        spark,
        ("m", 7, 1.0, "2024-03-09 12:00:00"),
        ("m", 8, 4.0, "2024-03-10 12:00:00"),
        ("other", 7, 4.0, "2024-03-10 12:00:00"),
        (None, 8, 1.0, "2024-03-10 12:00:00"),
    )
    params = replace(PARAMS, districts=("D2",))
    for build in (reads.backfill_hourly, reads.backfill_daily):
        df = build(readings, location, devices, renamed, params)
        got = out(df.select("headend_meter_id", "consumption"), "headend_meter_id")
        assert got == [(None, None), ("m", Decimal("3.00"))]


def test_mart_row(spark):
    df = frame(
        spark, "consumption decimal(18,2), read_interval int, installation string, contract bigint, name string",
        (None, None, "0012", None, None),
    )
    assert out(marts.to_mart_row(df, parity=True)) == [(Decimal("0.00"), 0, "12", "0", None)]
    assert out(marts.to_mart_row(df)) == [(None, None, "0012", None, None)]


def test_combined_reads(spark):
    left = frame(spark, "a int, b int", (1, 2))
    right = frame(spark, "a int, c int", (3, 4))
    assert out(marts.combined_reads(left, right), "a") == [(1, 2, None), (3, None, 4)]


def test_ports_of_a_meter_are_apart(spark, master):
    """Two registers read at the same times; under parity they follow each other as before."""
    rows = [("m", 7, v, t) for t, v in (("2024-03-09 12:00:00", 10.0), ("2024-03-10 12:00:00", 12.0))]
    other = [("m", 7, v, t) for t, v in (("2024-03-09 12:00:00", 500.0), ("2024-03-10 12:00:00", 510.0))]
    two = customer(spark, *other).withColumn("transponder_port", F.lit("2"))
    readings = customer(spark, *rows).unionByName(two)
    for plan in (reads.hourly_reads, reads.daily_reads):
        days = replace(PARAMS, as_of=day("2024-03-11"))
        got = out(plan(readings, *master, days).where("register = '001'").select("reading_value", "consumption"), "reading_value")
        assert got == [(10.0, None), (12.0, Decimal("2.00")), (500.0, None), (510.0, Decimal("10.00"))]
