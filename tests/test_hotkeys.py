"""Windows cut at midnight give the same rows as plain windows."""

import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from meterlake.operators import hotkeys, intervals

KEYS, TS, VALUE = ["meter_id"], "reading_datetime", "reading_value"


@pytest.fixture(scope="module")
def readings(spark):
    """One meter with a third of all rows, bunched in a few minutes; copies of one reading."""
    rng = random.Random(7)
    rows = []
    for m in range(20):
        value = 0
        for i in range(300 if m == 0 else 30):
            value += rng.randint(0, 500)
            second = rng.randint(0, 900) if m == 0 and i % 3 else rng.randint(0, 260_000)
            rows.append((f"m{m}", second, value / 100))
    rows += [rows[5]] * 200
    df = spark.createDataFrame(rows, "meter_id string, s int, v double")
    return df.select(
        "meter_id",
        (F.expr("timestamp_ntz'2024-01-01'") + F.expr("make_dt_interval(0,0,0,s)")).alias(TS),
        F.col("v").cast("decimal(18,2)").alias(VALUE),
    )


@pytest.mark.parametrize("slot", [60, 86_400])
def test_delta_is_that_of_a_plain_window(readings, monkeypatch, slot):
    monkeypatch.setattr(hotkeys, "SLOT_SECONDS", slot)
    once = readings.groupBy(*KEYS, TS).agg(F.max(VALUE).alias(VALUE))
    w = Window.partitionBy(*KEYS).orderBy(TS)
    prev = {"_prev_ts": F.lag(TS).over(w), "_prev_value": F.lag(VALUE).over(w)}
    plain = once.withColumns(prev).withColumns(intervals.delta_columns(VALUE, TS)).drop(*prev)
    got = intervals.interval_delta(readings, KEYS, TS, VALUE).select(*plain.columns)
    assert sorted(map(str, got.collect())) == sorted(map(str, plain.collect()))


@pytest.mark.parametrize("slot", [60, 86_400])
def test_parity_delta_does_not_depend_on_slots(readings, monkeypatch, slot):
    whole = sorted(map(str, intervals.interval_delta(readings, KEYS, TS, VALUE, parity=True).collect()))
    monkeypatch.setattr(hotkeys, "SLOT_SECONDS", slot)
    cut = sorted(map(str, intervals.interval_delta(readings, KEYS, TS, VALUE, parity=True).collect()))
    assert cut == whole


@pytest.mark.parametrize("slot", [60, 86_400])
def test_running_total(readings, monkeypatch, slot):
    monkeypatch.setattr(hotkeys, "SLOT_SECONDS", slot)
    rows = readings.distinct()
    order = [TS, VALUE]
    w = Window.partitionBy(*KEYS).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    plain = rows.withColumn("total", F.sum(VALUE).over(w))
    df = hotkeys.running_total(hotkeys.slotted(rows, KEYS, TS), KEYS, order, VALUE, "total")
    got = hotkeys.without_slots(df, rows, KEYS).select(*plain.columns)
    assert sorted(map(str, got.collect())) == sorted(map(str, plain.collect()))


def test_rows_of_one_day_are_the_most_that_a_task_sorts(readings):
    days = hotkeys.slotted(readings, KEYS, TS).groupBy("_key_meter_id", hotkeys.SLOT).count()
    assert days.where("_key_meter_id = 'm0'").count() >= 3


def test_newest_first_reduces_before_the_shuffle(readings, capsys):
    hotkeys.newest_first(readings, [*KEYS, TS], [F.desc(VALUE)]).explain()
    plan = capsys.readouterr().out
    assert "Partial" in plan.split("Exchange")[1]
