"""Time and code predicates. Each compares a bare column with a constant, so it reaches the scan."""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from meterlake.functions import day_offset, ntz


def in_horizon(df: DataFrame, ts: str, as_of: dt.date, lo: int, hi: int) -> DataFrame:
    """Rows from midnight of ``as_of + lo`` days to midnight of ``as_of + hi`` days, both included."""
    return df.where(F.col(ts).between(day_offset(as_of, lo), day_offset(as_of, hi)))


def since(df: DataFrame, ts: str, start: dt.datetime) -> DataFrame:
    return df.where(F.col(ts) > ntz(start))


def after(
    df: DataFrame, ts: str, as_of_ts: dt.datetime, *, hours: int = 0, months: int = 0
) -> DataFrame:
    """Rows later than the run time less the given hours and calendar months."""
    return df.where(F.col(ts) > cutoff(as_of_ts, hours=hours, months=months))


def cutoff(as_of_ts: dt.datetime, *, hours: int = 0, months: int = 0) -> Column:
    back = F.make_ym_interval(F.lit(0), F.lit(months))
    back_hours = F.make_dt_interval(F.lit(0), F.lit(hours))
    return ntz(as_of_ts) - back - back_hours


def after_event(df: DataFrame, ts: str, event_ts: str) -> DataFrame:
    return df.where(F.col(ts) > F.col(event_ts))


def having(df: DataFrame, predicate: Column) -> DataFrame:
    """Filter on aggregated columns."""
    return df.where(predicate)


def where_code(df: DataFrame, col: str, value: str, negate: bool = False) -> DataFrame:
    """Keep a code, or with ``negate`` all others. A missing code is dropped either way."""
    return df.where(F.col(col) != value if negate else F.col(col) == value)


def in_districts(df: DataFrame, districts: Iterable[str], col: str) -> DataFrame:
    """Keep the listed districts; an empty list keeps all."""
    wanted = list(districts)
    return df.where(F.col(col).isin(wanted)) if wanted else df
