"""Properties over random readings and accounts."""

import random
from dataclasses import replace
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from meterlake import Params
from meterlake.operators import intervals, leaks, schedule, usage, validity
from tests.frames import day, out, ts

KEYS, TS, VALUE = ["meter_id"], "reading_datetime", "reading_value"


def make(spark, seed, meters=12, readings=40):
    rng = random.Random(seed)
    rows = []
    for m in range(meters):
        value = 0
        for second in sorted(rng.sample(range(500_000), readings)):
            value += rng.randint(0, 900)
            rows.append((f"m{m}", second, value))
    rng.shuffle(rows)
    df = spark.createDataFrame(rows, "meter_id string, s int, cents int")
    return df.select(
        "meter_id",
        (F.expr("timestamp_ntz'2024-02-28'") + F.expr("make_dt_interval(0,0,0,s)")).alias(TS),
        (F.col("cents") / 100).cast("decimal(18,2)").alias(VALUE),
    )


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_deltas_add_up(spark, seed):
    df = make(spark, seed)
    deltas = intervals.interval_delta(df, KEYS, TS, VALUE)
    got = out(deltas.groupBy("meter_id").agg(F.sum("consumption"), F.sum("read_interval")), "meter_id")
    want = df.groupBy("meter_id").agg(
        (F.max(VALUE) - F.min(VALUE)).cast("decimal(28,2)"),
        (F.unix_timestamp(F.max(TS)) - F.unix_timestamp(F.min(TS))),
    )
    assert got == out(want, "meter_id")


@pytest.mark.parametrize("seed", [1, 2])
def test_order_of_input_does_not_matter(spark, seed):
    df = make(spark, seed)
    def rows(d):
        return sorted(map(str, intervals.interval_delta(d, KEYS, TS, VALUE).collect()))
    assert rows(df) == rows(df.orderBy(F.rand(seed)).repartition(7))


@pytest.mark.parametrize("seed", [1, 2])
def test_one_row_per_meter_and_day(spark, seed):
    df = make(spark, seed)
    doubled = df.unionByName(df)
    last = intervals.last_per_day(doubled, KEYS, TS, prefer=[VALUE])
    assert last.groupBy("meter_id", F.to_date(TS)).count().where("count > 1").count() == 0
    latest = intervals.max_ts_per_day(df, KEYS, TS)
    assert last.join(latest, [*KEYS, TS], "left_semi").count() == latest.count()


def test_valid_rows_hold_at_the_date(spark):
    df = spark.range(300).select(
        F.date_add(F.lit(day("2024-01-01")), (F.col("id") % 90).cast("int")).alias("a"),
        F.date_add(F.lit(day("2024-01-01")), ((F.col("id") * 7) % 120).cast("int")).alias("b"),
    )
    kept = validity.valid_at(df, day("2024-02-15"), ("a", "b"))
    assert kept.where("a > DATE'2024-02-15' OR b < DATE'2024-02-15'").count() == 0
    assert kept.count() == df.where("DATE'2024-02-15' BETWEEN a AND b").count()


def test_leaks_shrink_with_the_threshold(spark):
    rng = random.Random(4)
    rows = [("HOURLY", f"b{i % 30}", "c", rng.randint(0, 2000) / 100) for i in range(120)]
    reads = spark.createDataFrame(
        rows, "read_interval_type string, businesspartnernumber string, contractaccount string, consumption double"
    ).withColumn(TS, F.expr("timestamp_ntz'2024-03-09 12:00:00'"))
    found = [
        set(out(leaks.leak_alerts(reads, ts("2024-03-10"), 24, level))) for level in (0, 2, 5, 10, 19)
    ]
    assert all(later <= earlier for earlier, later in zip(found, found[1:]))
    assert found[0] and len(found[-1]) < len(found[0])


def test_high_usage_shrinks_with_sigma(spark):
    rng = random.Random(5)
    accounts = [str(i) for i in range(1, 25)]
    meters = spark.createDataFrame(
        [(a, "i", "001", "Yes", "20", f"b{a}", f"c{a}") for a in accounts],
        "meter_id string, installation string, register string, isactive string, end_point_type_1 string, "
        "business_partner_number string, connection_contract_number string",
    )
    bills = spark.createDataFrame(
        [(a, "i", "001", m, "01", rng.uniform(100, 5000), "U") for a in accounts for m in range(1, 7)],
        "meter_id string, installation string, register string, m int, meter_reading_reason string, "
        "consumption_gl double, meter_reading_unit string",
    ).withColumn("meter_reading_time", F.expr("make_date(2023, m, 1)").cast("timestamp_ntz"))
    reads = spark.createDataFrame(
        [("DAILY", a.zfill(8), "001", f"b{a}", f"c{a}", rng.uniform(0, 9000)) for a in accounts],
        "read_interval_type string, equipmentnumber string, register string, businesspartnernumber string, "
        "contractaccount string, consumption double",
    ).withColumn(TS, F.expr("timestamp_ntz'2023-07-01'"))
    plan = spark.sql("SELECT 'U' AS meterreadingunit, DATE'2024-01-01' AS scheduledmeterreadingdate")
    coming = schedule.next_read(plan, day("2023-08-01"))
    params = Params(as_of=day("2023-08-01"), min_usage=500)
    found = [
        {r["equipmentnumber"] for r in
         usage.high_usage(reads, bills, meters, coming, replace(params, sigma=s)).collect()}
        for s in (0, 1, 2, 3)
    ]
    assert all(later <= earlier for earlier, later in zip(found, found[1:]))
    assert found[0] and len(found[-1]) < len(found[0])


def test_amounts_are_exact(spark):
    """A sum of cents in any order is the same number."""
    df = make(spark, 9)
    deltas = intervals.interval_delta(df, KEYS, TS, VALUE)
    total = deltas.agg(F.sum("consumption").alias("t")).first()["t"]
    assert isinstance(total, Decimal)
    assert total == deltas.repartition(13).agg(F.sum("consumption").alias("t")).first()["t"]
