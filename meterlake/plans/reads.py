"""Hourly and daily reads of both feeds, enriched with the master data in force.

Every plan has the same three steps: consumption per meter from the readings alone; one table of the
service points in force, built from the master data; one join of the two. The readings are distinct
and the service points are distinct, so the joined rows need no DISTINCT of their own.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meterlake.operators import borders, horizon, intervals, marts, validity
from meterlake.operators.hotkeys import previous, slotted, without_slots
from meterlake.operators.feeds import METER, PORT, TS, VALUE, normalise_account_feed, normalise_customer_feed
from meterlake.params import Params

NEWEST = "ingest_watermark"
# Days of the account feed, whose own settings are ignored under parity.
PARITY_HOURLY, PARITY_DAILY = -2, -62


def account_days(params: Params, hourly: bool) -> int:
    """First day of the account feed's window, from the run date."""
    if params.parity:
        return PARITY_HOURLY if hourly else PARITY_DAILY
    return params.days_minus_hourly if hourly else params.days_minus_daily


def _reading(df: DataFrame, place: str, *more: str) -> DataFrame:
    """Columns of a reading that a mart row shows. Only these are shuffled."""
    return df.select(METER, place, TS, "timezone", VALUE, "unit_of_measure", *more)


def series(params: Params) -> list[str]:
    """What a register's readings follow each other by: a port of a meter, or with parity the meter."""
    return [METER] if params.parity else [METER, PORT]


def last_readings(feed: DataFrame, params: Params, before: dt.date) -> DataFrame:
    """The border table of a normalised feed: the last reading of each port of a meter before a day."""
    return borders.last_before(feed, series(params), TS, VALUE, NEWEST, before)


def merged_readings(old: DataFrame, new: DataFrame, params: Params) -> DataFrame:
    """The later reading of each port of a meter out of two border tables."""
    return borders.merged(old, new, series(params), TS, VALUE, NEWEST)


def hourly_deltas(
    readings: DataFrame, place: str, params: Params, before: DataFrame | None = None
) -> DataFrame:
    """Every reading with its consumption, before enrichment. ``before`` is the border table of the window."""
    if params.parity:
        rows = _reading(readings, place)
        return intervals.interval_delta(rows, [METER], TS, VALUE, parity=True)
    rows = _reading(readings, place, PORT, NEWEST)
    if before is None:
        return intervals.interval_delta(rows, series(params), TS, VALUE, prefer=[NEWEST]).drop(NEWEST)
    rows = borders.with_borders(rows, before)
    return borders.without_borders(
        intervals.interval_delta(rows, series(params), TS, VALUE, prefer=[NEWEST]).drop(NEWEST)
    )


def daily_deltas(last: DataFrame, params: Params, before: DataFrame | None = None) -> DataFrame:
    """Daily rows with the change since the day before, or since the border row."""
    if before is None:
        return intervals.day_delta(last, series(params), TS, VALUE)
    rows = borders.with_borders(last, before.drop(NEWEST))
    return borders.without_borders(intervals.day_delta(rows, series(params), TS, VALUE))


def daily_last(readings: DataFrame, place: str, params: Params) -> DataFrame:
    """Last reading of each port of a meter and day. With parity per meter, all readings of that moment, with copies."""
    if not params.parity:
        last = intervals.last_per_day(
            _reading(readings, place, PORT, NEWEST), series(params), TS, prefer=[NEWEST, VALUE, place]
        )
        return last.drop(NEWEST)
    last = intervals.last_per_day(readings.distinct(), [METER], TS, keep_ties=True)
    return intervals.with_copies(_reading(last, place))


def daily_enriched(
    last: DataFrame, points: DataFrame, place: str, params: Params, before: DataFrame | None = None
) -> DataFrame:
    """Daily rows with consumption and service point.

    The change from day to day is taken per port of a meter and then joined; with parity it is taken after the
    join, so that registers of one meter follow each other with delta 0. A meter is cut into its days there
    too, so that one with much of the data is spread over them.
    """
    if not params.parity:
        return daily_deltas(last, params, before).join(points, place)
    joined = last.join(points, place)
    rest = [c for c in joined.columns if c not in (METER, TS, VALUE, intervals.COPIES)]
    order = [TS, VALUE, "register", *[c for c in rest if c != "register"]]
    rows = previous(slotted(joined, [METER], TS), [METER], order, {"_prev_ts": TS, "_prev_value": VALUE})
    rows = rows.withColumns(intervals.delta_columns(VALUE, TS)).drop("_prev_ts", "_prev_value")
    return intervals.repeated_as_zero(without_slots(rows, joined, [METER]))


def _typed(df: DataFrame, kind: str, params: Params) -> DataFrame:
    return df.withColumn("read_interval_type", F.lit(f"{kind}{params.interval_suffix}"))


def _customer_mart(df: DataFrame) -> DataFrame:
    return marts.select_mart(df, marts.READS_MAPPING, *marts.READ_COLUMNS)


def _account_mart(df: DataFrame) -> DataFrame:
    return marts.select_mart(df, marts.READS_MAPPING, *marts.READ_COLUMNS, "utilities_premise")


def hourly_reads(
    readings: DataFrame,
    location: DataFrame,
    device: DataFrame,
    contract: DataFrame,
    params: Params,
    before: DataFrame | None = None,
) -> DataFrame:
    """Readings of the recent days up to tomorrow's midnight, customer feed; 17 columns."""
    feed = normalise_customer_feed(readings)
    recent = horizon.in_horizon(feed, TS, params.as_of, params.days_minus_hourly, 1)
    points = validity.points_by_location(location, device, contract, params.as_of)
    deltas = hourly_deltas(recent, "functionallocation", params, before)
    rows = deltas.join(points, "functionallocation")
    return _customer_mart(_typed(rows, "HOURLY", params))


def daily_reads(
    readings: DataFrame,
    location: DataFrame,
    device: DataFrame,
    contract: DataFrame,
    params: Params,
    before: DataFrame | None = None,
) -> DataFrame:
    """Last reading of each day up to today's midnight, customer feed; 17 columns."""
    feed = normalise_customer_feed(readings)
    recent = horizon.in_horizon(feed, TS, params.as_of, params.days_minus_daily, 0)
    points = validity.points_by_location(location, device, contract, params.as_of)
    last = daily_last(recent, "functionallocation", params)
    rows = daily_enriched(last, points, "functionallocation", params, before)
    return _customer_mart(_typed(rows, "DAILY", params))


def hourly_reads_account(
    readings: DataFrame,
    premise: DataFrame,
    device: DataFrame,
    contract: DataFrame,
    params: Params,
    before: DataFrame | None = None,
) -> DataFrame:
    """As ``hourly_reads`` for the account feed, located by premise; 18 columns."""
    recent = horizon.in_horizon(normalise_account_feed(readings), TS, params.as_of, account_days(params, True), 1)
    points = validity.points_by_premise(premise, device, contract, params.as_of)
    deltas = hourly_deltas(recent, "utilities_premise", params, before)
    rows = deltas.join(points, "utilities_premise")
    return _account_mart(_typed(rows, "HOURLY", params))


def daily_reads_account(
    readings: DataFrame,
    premise: DataFrame,
    device: DataFrame,
    contract: DataFrame,
    params: Params,
    before: DataFrame | None = None,
) -> DataFrame:
    """As ``daily_reads`` for the account feed, located by premise; 18 columns."""
    recent = horizon.in_horizon(normalise_account_feed(readings), TS, params.as_of, account_days(params, False), 0)
    points = validity.points_by_premise(premise, device, contract, params.as_of)
    last = daily_last(recent, "utilities_premise", params)
    rows = daily_enriched(last, points, "utilities_premise", params, before)
    return _account_mart(_typed(rows, "DAILY", params))


# Column names of the contract table that the backfills read.
BACKFILL_CONTRACT = {
    "moveindate": "utilitiesmoveindate",
    "moveoutdate": "utilitiesmoveoutdate",
    "contract": "utilitiescontract",
    "district": "regionalstructuregrouping",
}
BACKFILL_COLUMNS = tuple(c for c in marts.READ_COLUMNS if c != "read_interval_type")


def meters_seen_at(feed: DataFrame, points: DataFrame, place: str, params: Params) -> DataFrame:
    """Readings of the meters that have a reading at one of the service points.

    A few districts need few of all meters. The filter keeps whole meters, as the reading before may
    have been taken at another place.
    """
    if not params.districts:
        return feed
    here = feed.select(METER, place).join(points.select(place).distinct(), place, "left_semi")
    meters = here.select(F.col(METER).alias("_meter")).distinct()
    return feed.join(meters, F.col(METER).eqNullSafe(F.col("_meter")), "left_semi")


def _slot_begin(params: Params) -> dt.datetime:
    if params.slot_begin is None:
        raise ValueError("a backfill needs slot_begin")
    return params.slot_begin


def backfill_points(
    location: DataFrame, device: DataFrame, contract: DataFrame, params: Params
) -> DataFrame:
    """Service points of the districts, which both backfills join."""
    twice = [c for c in BACKFILL_CONTRACT.values() if c in contract.columns]
    current = marts.select_mart(contract.drop(*twice), BACKFILL_CONTRACT)
    wanted = horizon.in_districts(current, params.districts, "regionalstructuregrouping")
    return validity.points_by_location(location, device, wanted, params.as_of)


def backfill_window(readings: DataFrame, params: Params) -> DataFrame:
    """Customer feed after ``slot_begin``."""
    return horizon.since(normalise_customer_feed(readings), TS, _slot_begin(params))


def backfill_feed(recent: DataFrame, points: DataFrame, params: Params) -> DataFrame:
    """Readings of the window of the meters seen at the points, which both backfills start from."""
    return meters_seen_at(recent, points, "functionallocation", params)


def hourly_backfilled(feed: DataFrame, points: DataFrame, params: Params) -> DataFrame:
    """All readings of ``backfill_feed`` at the points, with consumption; 16 columns."""
    deltas = hourly_deltas(feed, "functionallocation", params)
    rows = deltas.join(points, "functionallocation")
    return marts.select_mart(rows, marts.READS_MAPPING, *BACKFILL_COLUMNS)


def daily_backfilled(feed: DataFrame, points: DataFrame, params: Params) -> DataFrame:
    """Last reading of each day of ``backfill_feed`` at the points; 16 columns."""
    last = daily_last(feed, "functionallocation", params)
    rows = daily_enriched(last, points, "functionallocation", params)
    return marts.select_mart(rows, marts.READS_MAPPING, *BACKFILL_COLUMNS)


def backfill_hourly(
    readings: DataFrame,
    location: DataFrame,
    device: DataFrame,
    contract: DataFrame,
    params: Params,
) -> DataFrame:
    """All readings after ``slot_begin`` in the districts, with consumption; 16 columns."""
    recent = backfill_window(readings, params)
    points = backfill_points(location, device, contract, params)
    return hourly_backfilled(backfill_feed(recent, points, params), points, params)


def backfill_daily(
    readings: DataFrame,
    location: DataFrame,
    device: DataFrame,
    contract: DataFrame,
    params: Params,
) -> DataFrame:
    """Last reading of each day after ``slot_begin`` in the districts; 16 columns."""
    recent = backfill_window(readings, params)
    points = backfill_points(location, device, contract, params)
    return daily_backfilled(backfill_feed(recent, points, params), points, params)
