import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from meterlake import functions as fn
from tests.frames import frame, out


def one(spark, col):
    return spark.range(1).select(col.alias("x")).first()["x"]


@pytest.mark.parametrize("text, want", [("000120", "120"), ("0", ""), ("120", "120"), ("0a0", "a0")])
def test_leading_zeros(spark, text, want):
    assert one(spark, fn.ltrim0(F.lit(text))) == want


@pytest.mark.parametrize("value, want", [(1.005, "1.01"), (2.675, "2.68"), (-1.005, "-1.01"), (0.004, "0.00")])
def test_round_half_up(spark, value, want):
    assert one(spark, fn.round2(F.lit(value))) == Decimal(want)


def test_days_truncate_toward_zero(spark):
    early, late = fn.ntz(dt.date(2024, 3, 5)), fn.ntz(dt.datetime(2024, 3, 10, 5))
    assert one(spark, fn.day_part(early, late)) == -5
    assert one(spark, fn.days_span(early, late)) == 5


def test_per_day_of_no_days(spark):
    assert one(spark, fn.per_day(F.lit(Decimal("10")), F.lit(0))) == 0.0
    assert one(spark, fn.per_day(F.lit(Decimal("10")), F.lit(4))) == 2.5


@pytest.mark.parametrize(
    "url, want",
    [("https://h/api/leak-alert", "leak-alert"), ("no slash", ""), ("ends/", ""), ("", "")],
)
def test_event_type(spark, url, want):
    assert one(spark, fn.event_type(F.lit(url))) == want


def test_payload(spark):
    when = fn.ntz(dt.datetime(2024, 3, 10, 5, 6, 7, 890123))
    got = one(spark, fn.payload(F.lit("12"), F.lit("34"), when))
    assert got == (
        '{"businessPartnerNumber":"12","contractAccountNumber":"34",'
        '"alertDateTime":"2024-03-10T05:06:07Z"}'
    )


def test_limit_of_exact_sums(spark):
    df = frame(spark, "v decimal(18,4)", ("100",), ("100",), ("100",), ("130.55",))
    parts = df.agg(*fn.moments(F.col("v")), F.stddev_pop("v").alias("d"), F.avg("v").alias("m"))
    row = parts.select(
        fn.limit(F.col("m"), fn.deviation_of_moments(), 2.5).alias("limit"), fn.deviation_of_moments().alias("dev"), "d"
    ).first()
    assert row["dev"] == pytest.approx(row["d"], abs=1e-9)
    assert row["limit"] == Decimal("140.71")
    lone = frame(spark, "v decimal(18,4)", ("123456.78",)).agg(*fn.moments(F.col("v")), F.avg("v").alias("m"))
    assert out(lone.select(fn.limit(F.col("m"), fn.deviation_of_moments(), 2.5))) == [(Decimal("123456.78"),)]


def test_day_offset_and_epoch(spark):
    assert one(spark, fn.day_offset(dt.date(2024, 3, 1), -1)) == dt.datetime(2024, 2, 29)
    assert one(spark, fn.epoch(fn.ntz(dt.date(1970, 1, 2)))) == 86400


def test_epoch_does_not_depend_on_the_session_zone(spark):
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        gap = fn.epoch(fn.ntz(dt.datetime(2024, 3, 10, 4))) - fn.epoch(fn.ntz(dt.datetime(2024, 3, 10, 1)))
        assert one(spark, gap) == 3 * 3600
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
