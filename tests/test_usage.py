"""Billing statistics, high usage, projection and leaks on hand-made accounts."""

from dataclasses import replace
from decimal import Decimal, localcontext

from pyspark.sql import functions as F

from meterlake import Params
from meterlake.functions import deviation_of_moments, merged_moments, moments, total_of_moments
from meterlake.operators import leaks, schedule, usage
from tests.frames import day, frame, out, ts

PARAMS = Params(as_of=day("2024-03-10"))
READS = (
    "read_interval_type string, equipmentnumber string, register string, businesspartnernumber string, "
    "contractaccount string, reading_datetime timestamp_ntz, consumption decimal(18,2)"
)
BILLS = (
    "meter_id string, installation string, register string, meter_reading_time timestamp_ntz, "
    "meter_reading_reason string, consumption_gl double, meter_reading_unit string"
)
METERS = (
    "meter_id string, installation string, register string, isactive string, end_point_type_1 string, "
    "business_partner_number string, connection_contract_number string"
)


def bill(time, amount, register="001", reason="01", unit="U", meter="5"):
    return (meter, "i", register, time, reason, amount, unit)


def meter(register="001", active="Yes", kind="20", number="5"):
    return (number, "i", register, active, kind, "bp", "ca")


def read(time, amount, register="001", equipment="0005", kind="DAILY"):
    return (kind, equipment, register, "bp", "ca", time, amount)


def coming(spark, date="2024-03-20", unit="U"):
    return frame(spark, "meter_reading_unit string, next_read_date date", (unit, date))


EVEN = [bill(f"2024-0{m}-01 00:00:00", 100.0) for m in (1, 2, 3)]


def alerts(spark, reads, bills=EVEN, meters=(meter(),), params=PARAMS, next_read=None):
    df = usage.high_usage(
        frame(spark, READS, *reads), frame(spark, BILLS, *bills), frame(spark, METERS, *meters),
        next_read or coming(spark), params,
    )
    return out(df.select("equipmentnumber", "last_read_time", "current_usage", "high_usage_limit"),
               "high_usage_limit")


def test_high_usage(spark):
    used = [
        read("2024-03-01 00:00:00", "9999"),
        read("2024-03-02 00:00:00", "3000"),
        read("2024-03-03 00:00:00", "500"),
    ]
    assert alerts(spark, used) == [
        ("5", ts("2024-03-01"), Decimal("3500.00"), Decimal("100.00"))
    ]


def test_high_usage_needs_the_floor_and_the_limit(spark):
    assert alerts(spark, [read("2024-03-02 00:00:00", "2999")]) == []
    assert alerts(spark, [read("2024-03-02 00:00:00", "3000")]) == []
    high = [bill(f"2024-0{m}-01 00:00:00", 5000.0) for m in (1, 2, 3)]
    assert alerts(spark, [read("2024-03-02 00:00:00", "4000")], high) == []
    assert alerts(spark, [read("2024-03-02 00:00:00", "200")], params=replace(PARAMS, min_usage=100)) != []


def test_high_usage_filters(spark):
    used = [read("2024-03-02 00:00:00", "3500")]
    assert alerts(spark, used, meters=[meter(active="No")]) == []
    assert alerts(spark, used, meters=[meter(kind="19")]) == []
    assert alerts(spark, used, next_read=coming(spark, unit="other")) == []
    assert alerts(spark, used, [bill(r[3], r[5], reason="02") for r in EVEN]) == []
    assert alerts(spark, [read("2024-03-02 00:00:00", "3500", kind="HOURLY")]) == []
    old = [bill("2022-01-01 00:00:00", 100.0)]
    assert alerts(spark, used, old) == []


def test_sigma_and_months(spark):
    bills = [bill("2024-01-01 00:00:00", 1000.0), bill("2024-02-01 00:00:00", 5000.0)]
    used = [read("2024-03-02 00:00:00", "7000")]
    assert alerts(spark, used, bills) == []
    assert alerts(spark, used, bills, params=replace(PARAMS, sigma=1.0))[0][3] == Decimal("5000.00")
    assert alerts(spark, used, bills, params=replace(PARAMS, months=2))[0][3] == Decimal("5000.00")


def test_two_registers(spark):
    """Default: each register against its own limit. Parity: added up and repeated."""
    bills = EVEN + [bill(b[3], b[5], register="002") for b in EVEN]
    meters = [meter(), meter("002")]
    used = [read("2024-03-02 00:00:00", "2000"), read("2024-03-02 00:00:00", "3500", register="002")]
    assert [a[2] for a in alerts(spark, used, bills, meters)] == [Decimal("3500.00")]
    parity = replace(PARAMS, parity=True)
    assert [a[2] for a in alerts(spark, used, bills, meters, parity)] == [Decimal("11000.00")]
    other = EVEN + [bill(b[3], 200.0, register="002") for b in EVEN]
    got = alerts(spark, used, other, meters, parity)
    assert [(a[2], a[3]) for a in got] == [
        (Decimal("5500.00"), Decimal("100.00")), (Decimal("5500.00"), Decimal("200.00")),
    ]


def project(spark, reads, bills, next_read, meters=(meter(),), params=PARAMS, kinds=("20", "AMI")):
    df = usage.project_consumption(
        frame(spark, READS, *reads), frame(spark, BILLS, *bills), frame(spark, METERS, *meters),
        frame(spark, "id string, endpoint_group string", kinds), next_read,
        frame(spark, "business_partner_number string, connection_contract_number string, premise_id string",
              ("bp", "ca", "P")),
        params,
    )
    return out(df.select("premise_id", "service_period_start", "service_period_end", "curr_read_consumption",
                         "curr_read_date", "per_day_consumption", "days_to_next_read", "projected_consumption"))


RATE = [bill("2024-01-01 00:00:00", 100.0), bill("2024-02-20 00:00:00", 0.0)]


def test_projection(spark):
    used = [read("2024-03-01 00:00:00", "4"), read("2024-03-06 00:00:00", "6")]
    assert project(spark, used, RATE, coming(spark, "2024-03-10")) == [
        ("P", day("2024-02-20"), day("2024-03-10"), Decimal("10.00"), day("2024-03-06"), Decimal("2.00"), 4,
         Decimal("18.00"))
    ]


def test_projection_of_one_bill_and_late_read(spark):
    used = [read("2024-03-10 05:00:00", "10")]
    one = [bill("2024-01-01 00:00:00", 100.0)]
    assert project(spark, used, one, coming(spark, "2024-03-05"))[0][5:] == (Decimal("0.00"), -5, Decimal("10.00"))
    assert project(spark, used, RATE, coming(spark, "2024-03-05"))[0][5:] == (Decimal("2.00"), -5, Decimal("0.00"))


def test_projection_needs_the_endpoint_group(spark):
    used = [read("2024-03-01 00:00:00", "4")]
    assert project(spark, used, RATE, coming(spark), kinds=("20", "AMR")) == []


def test_projection_parity_repeats_per_register(spark):
    used = [read("2024-03-01 00:00:00", "4"), read("2024-03-01 00:00:00", "4", register="002")]
    meters = [meter(), meter("002")]
    rows = project(spark, used, RATE, coming(spark, "2024-03-05"), meters)
    assert [r[3] for r in rows] == [Decimal("4.00")] * 2
    rows = project(spark, used, RATE, coming(spark, "2024-03-05"), meters, replace(PARAMS, parity=True))
    assert [r[3] for r in rows] == [Decimal("16.00")]


def test_next_read(spark):
    df = frame(
        spark, "meterreadingunit string, scheduledmeterreadingdate date",
        ("A", "2024-03-09"), ("A", "2024-03-12"), ("A", "2024-03-11"), ("B", "2024-03-10"), ("C", "2024-01-01"),
    )
    assert out(schedule.next_read(df, day("2024-03-10")), "meter_reading_unit") == [
        ("A", day("2024-03-11")), ("B", day("2024-03-10")),
    ]


HOURS = "read_interval_type string, businesspartnernumber string, contractaccount string, " \
    "reading_datetime timestamp_ntz, consumption decimal(18,2)"


def leak(spark, values, **kw):
    rows = [("HOURLY", "b", "c", f"2024-03-09 0{i + 1}:00:00", v) for i, v in enumerate(values)]
    rows += [("DAILY", "b", "c", "2024-03-09 05:00:00", "0"), ("HOURLY", "b", "c", "2024-03-09 00:00:00", "0")]
    return out(leaks.leak_alerts(frame(spark, HOURS, *rows), ts("2024-03-10"), 24, 5, **kw))


def test_leaks(spark):
    assert leak(spark, ["6", "7", "8"]) == [("b", "c")]
    assert leak(spark, ["6", "5", "8"]) == []
    assert leak(spark, ["6", None, "7"]) == [("b", "c")]
    assert leak(spark, ["6", None, "7"], parity=True) == []
    assert leak(spark, ["6", "7"], min_readings=3) == []
    assert leak(spark, [None, None]) == []


def deviation(spark, values, parts=1):
    rows = spark.createDataFrame([(str(v), i % parts) for i, v in enumerate(values)], "v string, part int")
    amounts = rows.selectExpr("CAST(v AS DECIMAL(28,10)) AS v", "part")
    merged = amounts.groupBy("part").agg(*moments(F.col("v"))).agg(*merged_moments())
    found = merged.select(total_of_moments().alias("t"), deviation_of_moments().alias("d")).first()
    exact = [Decimal(str(v)) for v in values]
    n = len(exact)
    variance = n * sum(v * v for v in exact) - sum(exact) ** 2
    assert found["t"] == sum(exact)
    want = float(variance.sqrt()) / n
    assert abs(found["d"] - want) <= 1e-14 * max(want, 1e-300)
    return found["d"]


def test_deviation_is_exact(spark):
    assert deviation(spark, ["33.3333"] * 15) == 0
    assert deviation(spark, ["0.0007"] * 9, 3) == 0
    with localcontext() as c:
        c.prec = 90
        assert deviation(spark, ["0.0000000001", "0.0000000003"]) == 1e-10
        assert deviation(spark, ["99.9999999999", "100", "100.0000000001"], 2) > 0
        assert deviation(spark, ["123456789012.3456789012", "123456789012.3456789013", "-5"], 3) > 0
        deviation(spark, ["-0.0000000001", "-99.9999999999", "-100.5", "250", "1e9"], 2)
        deviation(spark, [f"{i * 7919 % 1000}.{i * 104729 % 10**10:010}" for i in range(500)], 7)


def test_a_register_without_bills_has_rate_zero(spark):
    used = [read("2024-03-01 00:00:00", "4"), read("2024-03-01 00:00:00", "6", register="002")]
    rows = project(spark, used, RATE, coming(spark, "2024-03-05"), [meter(), meter("002")])
    assert sorted((r[3], r[5], r[7]) for r in rows) == [
        (Decimal("4.00"), Decimal("2.00"), Decimal("12.00")), (Decimal("6.00"), Decimal("0.00"), Decimal("6.00")),
    ]


def test_a_register_without_bills_goes_on_to_each_date_of_its_account_once(spark):
    dates = frame(spark, "meter_reading_unit string, next_read_date date", ("U", "2024-03-05"), ("V", "2024-03-09"))
    used = [read("2024-03-01 00:00:00", "4"), read("2024-03-01 00:00:00", "6", register="002"),
            read("2024-03-01 00:00:00", "8", register="003")]
    bills = [*RATE, *[(*b[:6], "V") for b in RATE], bill("2024-02-20 00:00:00", 0.0, register="003"),
             bill("2024-01-01 00:00:00", 49.0, register="003")]
    rows = project(spark, used, bills, dates, [meter(), meter("002"), meter("003")])
    assert sorted((r[3], r[2].day, r[5], r[6]) for r in rows) == [
        (Decimal("4.00"), 5, Decimal("2.00"), 4), (Decimal("4.00"), 9, Decimal("2.00"), 8),
        (Decimal("6.00"), 5, Decimal("0.00"), 4), (Decimal("6.00"), 9, Decimal("0.00"), 8),
        (Decimal("8.00"), 5, Decimal("0.98"), 4),
    ]
