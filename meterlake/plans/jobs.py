"""Job selection: the chosen steps in their fixed order, from source tables to marts.

Steps can be run again. The reads of a run replace the days that it covers, alerts and audit rows are written
once for each message, and whole tables are switched to a new version. A run with an id notes each finished
step, and a repetition of that run goes on with the others.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Iterable
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meterlake import sinks
from meterlake.operators import alerts, horizon, leaks, marts, schedule, usage
from meterlake.operators.feeds import TS, normalise_account_feed, normalise_customer_feed
from meterlake.params import Params
from meterlake.plans import reads
from meterlake.session import exists
from meterlake.sources import Tables, read_sql, run_sql

CUSTOMER, ACCOUNT = "customer", "account"
STEPS = (
    "hourly",
    "daily",
    "hourly_account",
    "daily_account",
    "next_read",
    "projection",
    "high_usage",
    "leaks",
    "audit",
    "backfill",
)


@dataclass(frozen=True)
class Marts:
    """Result tables under one folder."""

    root: str

    def _at(self, name: str) -> str:
        return f"{self.root.rstrip('/')}/{name}"

    @property
    def reads(self) -> sinks.Target:
        return sinks.Target.reads(self._at("meter_ami_reads"))

    @property
    def borders(self) -> sinks.Target:
        """Last readings before the windows of the runs; a version's label is the feed and the day."""
        return sinks.Target.published(self._at("meter_last_readings"))

    @property
    def next_read(self) -> sinks.Target:
        return sinks.Target.published(self._at("meter_next_read"))

    @property
    def projected(self) -> sinks.Target:
        return sinks.Target.published(self._at("meter_ami_projected_consumption"))

    @property
    def outbox(self) -> sinks.Target:
        return sinks.Target(self._at("alert_outbox"), ("run_date",), schema=alerts.OUTBOX_SCHEMA)

    @property
    def audit(self) -> sinks.Target:
        return sinks.Target(self._at("ami_alerts_audit"), ("run_date",), schema=alerts.AUDIT_SCHEMA)

    @property
    def hourly(self) -> sinks.Target:
        return sinks.Target.published(self._at("meter_ami_reads_hourly"), sinks.READS_ORDER)

    @property
    def daily(self) -> sinks.Target:
        return sinks.Target.published(self._at("meter_ami_reads_daily"), sinks.READS_ORDER)

    @property
    def backfill_points(self) -> sinks.Target:
        """Service points of the last backfill."""
        return sinks.Target.published(self._at("meter_backfill_points"))

    @property
    def backfill_readings(self) -> sinks.Target:
        """Readings of the districts' meters of the last backfill."""
        return sinks.Target.published(self._at("meter_backfill_readings"))

    @property
    def runs(self) -> sinks.Target:
        """Finished steps of the runs with an id."""
        return sinks.Target(self._at("job_runs"))


def _mart_rows(df: DataFrame, feed: str, params: Params) -> DataFrame:
    return marts.reads_row(df, params.parity).withColumn("feed", F.lit(feed))


def customer_reads(
    tables: Tables, params: Params, hourly: bool, before: DataFrame | None = None
) -> DataFrame:
    build = reads.hourly_reads if hourly else reads.daily_reads
    names = ("customer_readings", "locations", "installed_devices", "contracts")
    return _mart_rows(build(*map(tables.load, names), params, before), CUSTOMER, params)


def account_reads(
    tables: Tables, params: Params, hourly: bool, before: DataFrame | None = None
) -> DataFrame:
    build = reads.hourly_reads_account if hourly else reads.daily_reads_account
    names = ("account_readings", "premises", "installed_devices", "contracts")
    return _mart_rows(build(*map(tables.load, names), params, before), ACCOUNT, params)


def _feed(tables: Tables, feed: str) -> DataFrame:
    if feed == CUSTOMER:
        return normalise_customer_feed(tables.load("customer_readings"))
    return normalise_account_feed(tables.load("account_readings"))


def last_readings(tables: Tables, out: Marts, params: Params, feed: str, start: dt.date) -> DataFrame:
    """The border table of a feed before ``start``, stored.

    It is made from the newest stored one that is not later, and from the readings between the two days only.
    The first run of a feed has nothing to start from: what it reads has no predecessors, as before.
    """
    known, label = {}, f"{feed} {start.isoformat()}"
    for stored in sinks.labels(tables.spark, out.borders):
        of, _, day = stored.partition(" ")
        if of == feed and day <= start.isoformat():
            known[day] = stored
    if start.isoformat() in known:
        return sinks.read(tables.spark, out.borders, label)
    if not known:
        rows = reads.last_readings(_feed(tables, feed).where(F.lit(False)), params, start)
    else:
        day = max(known)
        rows = sinks.read(tables.spark, out.borders, known[day])
        since = dt.date.fromisoformat(day)
        if since < start:
            between = horizon.in_horizon(_feed(tables, feed), TS, since, 0, (start - since).days)
            rows = reads.merged_readings(rows, reads.last_readings(between, params, start), params)
    sinks.publish(rows, out.borders, label=label)
    return sinks.read(tables.spark, out.borders, label)


def _stored(tables: Tables, target: sinks.Target) -> DataFrame:
    return sinks.read(tables.spark, target)


def run_reads(tables: Tables, out: Marts, params: Params, feed: str, hourly: bool) -> int:
    """Load one feed's reads; the days that the run covers are replaced.

    With parity the customer feed appends, and the account feed replaces all days of its interval type, in
    one slice for both feeds.
    """
    build = customer_reads if feed == CUSTOMER else account_reads
    if params.parity:
        rows = build(tables, params, hourly).withColumn("feed", F.lit("all"))
        if feed == CUSTOMER:
            return sinks.append(rows, out.reads)
        kind = f"{'HOURLY' if hourly else 'DAILY'}{params.interval_suffix}"
        return sinks.replace_kind(rows, out.reads, feed="all", read_interval_type=kind)
    days = params.days_minus_hourly if hourly else params.days_minus_daily
    before = last_readings(tables, out, params, feed, params.as_of + dt.timedelta(days=days))
    return sinks.replace_slice(build(tables, params, hourly, before), out.reads)


def run_next_read(tables: Tables, out: Marts, params: Params) -> int:
    return sinks.replace_all(schedule.next_read(tables.load("schedules"), params.as_of), out.next_read)


def run_projection(tables: Tables, out: Marts, params: Params) -> int:
    projected = usage.project_consumption(
        _stored(tables, out.reads),
        tables.load("billing_reads"),
        tables.load("billing_meters"),
        tables.load("endpoint_types"),
        _stored(tables, out.next_read),
        tables.load("connection_contracts"),
        params,
    )
    return sinks.replace_all(projected, out.projected)


def _sent(tables: Tables, target: sinks.Target, params: Params) -> DataFrame | None:
    """This run date's rows of a table by message, if there is one."""
    if not exists(tables.spark, target.path):
        return None
    return sinks.read(tables.spark, target).where(F.col("run_date") == F.lit(params.as_of_ts.date()))


def _send(tables: Tables, out: Marts, params: Params, found: DataFrame, endpoint: str) -> int:
    messages = alerts.alert_outbox(found, endpoint, params.as_of_ts, parity=params.parity)
    if not params.parity:
        messages = alerts.new_messages(messages, _sent(tables, out.outbox, params))
    return sinks.append(messages, out.outbox)


def run_high_usage(tables: Tables, out: Marts, params: Params) -> int:
    found = usage.high_usage(
        _stored(tables, out.reads),
        tables.load("billing_reads"),
        tables.load("billing_meters"),
        _stored(tables, out.next_read),
        params,
    )
    return _send(tables, out, params, found, params.high_usage_endpoint)


def run_leaks(tables: Tables, out: Marts, params: Params) -> int:
    found = leaks.leak_alerts(
        _stored(tables, out.reads),
        params.as_of_ts,
        params.leak_hours,
        params.leak_min,
        min_readings=params.min_readings,
        suffix=params.interval_suffix,
        parity=params.parity,
    )
    return _send(tables, out, params, found, params.leak_endpoint)


def run_audit(tables: Tables, out: Marts, params: Params, results: DataFrame | None = None) -> int:
    """Audit rows of this run date's messages that have none yet.

    With the sender's ``results`` those messages that have a reply; without, all that are left, with no reply.
    """
    sent = _sent(tables, out.outbox, params)
    if sent is None:
        return 0
    done = None if params.parity else _sent(tables, out.audit, params)
    messages = sent if params.parity else alerts.new_messages(sent, done)
    if results is not None and not params.parity:
        messages = alerts.answered(messages, results)
    rows = alerts.audit_records(messages, params.as_of_ts, params.job_id, results, keyed=True)
    return sinks.append(rows, out.audit)


def publish_backfill(
    hourly: DataFrame, daily: DataFrame, next_read: DataFrame, out: Marts
) -> dict[str, int]:
    """Switch the backfill marts to new versions; the schedule only when it has rows. Returns the rows of each."""
    return {
        "hourly": sinks.replace_all(hourly, out.hourly),
        "daily": sinks.replace_all(daily, out.daily),
        "next_read": sinks.publish(next_read, out.next_read, if_any=True),
    }


def _kept(rows: DataFrame, target: sinks.Target) -> DataFrame:
    """The rows, written once for all that read them."""
    sinks.publish(rows, target)
    return sinks.read(rows.sparkSession, target)


def run_backfill(tables: Tables, out: Marts, params: Params) -> int:
    """Both backfills and the schedule. Returns the rows of the two.

    Both read the same service points, and of some districts the same few readings: these are stored once.
    """
    readings, *master = map(tables.load, ("customer_readings", "locations", "installed_devices", "contracts"))
    recent = reads.backfill_window(readings, params)
    points = _kept(reads.backfill_points(*master, params), out.backfill_points)
    feed = reads.backfill_feed(recent, points, params)
    if params.districts:
        feed = _kept(feed, out.backfill_readings)
    coming = schedule.next_read(tables.load("schedules"), params.as_of)
    hourly, daily = (build(feed, points, params) for build in (reads.hourly_backfilled, reads.daily_backfilled))
    written = publish_backfill(hourly, daily, coming, out)
    return written["hourly"] + written["daily"]


_RUN = "run_id string, step string, rows long, finished_at timestamp_ntz"


def finished_steps(tables: Tables, out: Marts, run_id: str) -> dict[str, int]:
    """Rows of the steps that the run has finished."""
    if not exists(tables.spark, out.runs.path):
        return {}
    rows = sinks.read(tables.spark, out.runs).where(F.col("run_id") == run_id)
    return {r["step"]: r["rows"] for r in rows.select("step", "rows").collect()}


def run(
    steps: Iterable[str], tables: Tables, out: Marts, params: Params, run_id: str | None = None
) -> dict[str, int]:
    """Run the chosen steps in their order. Returns the rows that each wrote, counted in its own write.

    With ``run_id`` a finished step is noted in the run table, and skipped (with the rows it had) when the same
    run is started again. Rows of a step that failed half-way are replaced or passed over by its repetition.
    """
    wanted = set(steps)
    unknown = wanted - set(STEPS)
    if unknown:
        raise ValueError(f"unknown steps: {sorted(unknown)}")
    actions: dict[str, Callable[[], int]] = {
        "hourly": lambda: run_reads(tables, out, params, CUSTOMER, True),
        "daily": lambda: run_reads(tables, out, params, CUSTOMER, False),
        "hourly_account": lambda: run_reads(tables, out, params, ACCOUNT, True),
        "daily_account": lambda: run_reads(tables, out, params, ACCOUNT, False),
        "next_read": lambda: run_next_read(tables, out, params),
        "projection": lambda: run_projection(tables, out, params),
        "high_usage": lambda: run_high_usage(tables, out, params),
        "leaks": lambda: run_leaks(tables, out, params),
        "audit": lambda: run_audit(tables, out, params),
        "backfill": lambda: run_backfill(tables, out, params),
    }
    done = finished_steps(tables, out, run_id) if run_id else {}
    rows = {}
    for step in (s for s in STEPS if s in wanted):
        rows[step] = done[step] if step in done else actions[step]()
        if run_id and step not in done:
            note = tables.spark.createDataFrame([(run_id, step, rows[step], params.as_of_ts)], _RUN)
            sinks.append(note.coalesce(1), out.runs)
    return rows


def export_query(tables: Tables, sql_path: str, new_dir: str, args: dict | None = None) -> None:
    """Run the SQL text of a file and write all its rows as quoted CSV with a header."""
    text = read_sql(tables.spark, sql_path)
    sinks.export_csv(run_sql(tables.spark, text, args), new_dir)
