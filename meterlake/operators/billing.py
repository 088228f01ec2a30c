"""Billing history per account: last reading, usage statistics, daily rate.

The billing readings are reduced to exact sums per meter, register and reading unit before anything
is joined; meters, endpoint types and schedules meet those few rows. The sums merge without loss, so
the order of aggregation and joins is free. The last reading looks at all history but three columns;
the statistics read the recent months only, a filter that reaches the scan.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meterlake.functions import (
    deviation_of_moments,
    days_span,
    limit,
    merged_moments,
    moments,
    per_day,
    round2,
    total_of_moments,
)
from meterlake.operators.horizon import after, where_code

# Account key, reason code of a billing reading, flag of an active meter.
ACCOUNT = ("meter_id", "business_partner_number", "connection_contract_number")
BILLING_REASON = "01"
ACTIVE = "Yes"


def billed(bills: DataFrame) -> DataFrame:
    return where_code(bills, "meter_reading_reason", BILLING_REASON)


def bill_totals(
    bills: DataFrame, keys: Sequence[str], as_of_ts: dt.datetime, months: int
) -> DataFrame:
    """Billing readings of the last ``months`` months, summed per ``keys`` and reading unit."""
    recent = after(billed(bills), "meter_reading_time", as_of_ts, months=months)
    return recent.groupBy(*keys, "meter_reading_unit").agg(
        *moments(F.col("consumption_gl")),
        F.min("meter_reading_time").alias("_start"),
        F.max("meter_reading_time").alias("_end"),
    )


def with_endpoint(meters: DataFrame, types: DataFrame, group: str) -> DataFrame:
    """Meters whose endpoint type belongs to ``group``."""
    wanted = where_code(types, "endpoint_group", group).select(F.col("id").alias("end_point_type_1"))
    return meters.join(wanted, "end_point_type_1")


def active_meters(meters: DataFrame) -> DataFrame:
    return where_code(meters, "isactive", ACTIVE)


def bills_with_meters(totals: DataFrame, meters: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Reduced bills joined with the meters, which carry the account and the register."""
    wanted = [*keys, *[c for c in (*ACCOUNT, "register") if c not in keys]]
    return totals.join(meters.select(*wanted), list(keys))


def with_next_read(df: DataFrame, next_read: DataFrame) -> DataFrame:
    """Add the next scheduled date of the reading unit. Units without one drop out."""
    return df.join(next_read, "meter_reading_unit")


def last_bill(bills: DataFrame, meters: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Time of the last billing reading per account meter, over all history."""
    latest = billed(bills).groupBy(*keys).agg(F.max("meter_reading_time").alias("_last"))
    rows = bills_with_meters(latest, meters, keys)
    return rows.groupBy(*ACCOUNT).agg(F.max("_last").alias("last_read_time"))


def billing_stats(base: DataFrame, keys: Sequence[str], sigma: float) -> DataFrame:
    """Totals, mean, deviation, usage limit, day span and daily rate of the billing window."""
    merged = base.groupBy(*keys).agg(
        *merged_moments(),
        F.min("_start").alias("start_date"),
        F.max("_end").alias("end_date"),
    )
    some = F.when(F.col("_n") > 0, total_of_moments())
    named = merged.withColumns({"total_consumption": some, "_deviation": deviation_of_moments()})
    total = F.col("total_consumption")
    mean = total.cast("double") / F.nullif(F.col("_n"), F.lit(0))
    return named.select(
        *keys,
        total,
        round2(mean).alias("avg_consumption"),
        round2(F.col("_deviation")).alias("std_dev_consumption"),
        limit(mean, F.col("_deviation"), sigma).alias("high_usage_limit"),
        days_span(F.col("start_date"), F.col("end_date")).alias("total_days"),
        "start_date",
        "end_date",
    ).withColumn("per_day_consumption", per_day(total, F.col("total_days")))
