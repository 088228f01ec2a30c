"""Continuous flow: the smallest interval consumption never falls to the threshold."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meterlake.functions import DATE, EXACT, amount
from meterlake.operators.horizon import after, having, where_code


def min_over(
    df: DataFrame, keys: Sequence[str], col: str, threshold: float, min_readings: int = 1
) -> DataFrame:
    """Keys whose smallest ``col`` is above ``threshold``. NULLs do not count as readings."""
    least = df.groupBy(*keys).agg(
        F.min(amount(F.col(col))).alias("_least"), F.count(col).alias("_readings")
    )
    steady = F.col("_least") > F.lit(threshold).cast(EXACT)
    return having(least, steady & (F.col("_readings") >= min_readings)).select(*keys)


def leak_alerts(
    reads: DataFrame,
    as_of_ts: dt.datetime,
    hours: int,
    min_consumption: float,
    *,
    min_readings: int = 1,
    suffix: str = "",
    parity: bool = False,
) -> DataFrame:
    """Accounts with flow in every hourly reading of the last ``hours`` hours.

    With ``parity`` a missing consumption counts as 0, and so clears the account. Of a mart with a folder for each
    day only those of these hours are read.
    """
    hourly = where_code(reads, "read_interval_type", f"HOURLY{suffix}")
    if DATE in reads.columns:
        first = as_of_ts - dt.timedelta(hours=hours)
        hourly = hourly.where(F.col(DATE) >= F.lit(first.date()))
    recent = after(hourly, "reading_datetime", as_of_ts, hours=hours)
    if parity:
        recent = recent.fillna(0, subset=["consumption"])
    keys = ["businesspartnernumber", "contractaccount"]
    return min_over(recent, keys, "consumption", min_consumption, min_readings)
