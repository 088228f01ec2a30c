"""Registered queries: every operator over whole test tables."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, DecimalType

from meterlake import Params, sinks
from meterlake.checks.views import Views
from meterlake.functions import deviation_of_moments, ltrim0, merged_moments, round2
from meterlake.operators import alerts, billing, horizon, intervals, leaks, marts, schedule
from meterlake.operators import usage as use
from meterlake.operators import validity
from meterlake.operators.feeds import METER, TS, VALUE
from meterlake.plans import jobs, reads
from meterlake.session import scratch
from meterlake.sources import Tables, drop, register, run_sql

READS_DAY = dt.date(2024, 1, 20)
BACKFILL_START = dt.datetime(2024, 1, 10)
BILLS_DAY = dt.date(2001, 8, 2)
PROJECTION_DAY = dt.date(2001, 6, 1)
SCHEDULE_DAY = dt.date(2001, 1, 1)
LEAK_TIME = dt.datetime(2024, 1, 30)
EVENT_TIME = dt.datetime(2024, 1, 31, 6, 30, 15)
DISTRICTS = ("NATION_0", "NATION_1")
LEAK_URL = "https://alerts.example.org/api/leak-alert"
USAGE_URL = "https://alerts.example.org/api/high-usage-alert"
ALL_MONTHS = 120

READS = Params(as_of=READS_DAY, slot_begin=BACKFILL_START)
BILLS = Params(as_of=BILLS_DAY, months=ALL_MONTHS)
PROJECTION = Params(as_of=PROJECTION_DAY)


def plain(df: DataFrame) -> DataFrame:
    """Decimals as doubles and dates as timestamps, the types of the test tables themselves."""
    out = []
    for f in df.schema.fields:
        col = F.col(f.name)
        if isinstance(f.dataType, DecimalType):
            col = col.cast("double")
        elif isinstance(f.dataType, DateType):
            col = col.cast("timestamp_ntz")
        out.append(col.alias(f.name))
    return df.select(*out)


# Readings


def _delta(df: DataFrame, **kw) -> DataFrame:
    rows = df.select(METER, TS, VALUE)
    return intervals.interval_delta(rows, [METER], TS, VALUE, **kw)


def interval_delta(v: Views) -> DataFrame:
    return _delta(v.readings())


def interval_delta_digits(v: Views) -> DataFrame:
    return _delta(v.fine_readings())


def dedupe_delta(v: Views) -> DataFrame:
    once = v.readings()
    return _delta(once.unionByName(once))


def dedupe_delta_parity(v: Views) -> DataFrame:
    once = v.readings()
    return _delta(once.unionByName(once), parity=True)


def reads_horizon(v: Views) -> DataFrame:
    rows = v.readings().select(METER, TS, VALUE)
    return horizon.in_horizon(rows, TS, READS_DAY, READS.days_minus_hourly, 1)


def reads_backfill(v: Views) -> DataFrame:
    register(v.readings(), "readings_to_backfill")
    text = (
        "SELECT meter_id, reading_datetime, reading_value FROM readings_to_backfill "
        "WHERE reading_datetime > CAST(:slot_begin AS TIMESTAMP_NTZ)"
    )
    rows = run_sql(v.spark, text, {"slot_begin": BACKFILL_START.isoformat(sep=" ")})
    drop(v.spark, "readings_to_backfill")
    return rows


def last_per_day(v: Views) -> DataFrame:
    return intervals.last_per_day(v.readings().select(METER, TS, VALUE), [METER], TS, prefer=[VALUE])


def max_ts_per_day(v: Views) -> DataFrame:
    return intervals.max_ts_per_day(v.readings(), [METER], TS)


def daily_delta(v: Views) -> DataFrame:
    return intervals.day_delta(last_per_day(v), [METER], TS, VALUE)


def mart_row_coercion(v: Views) -> DataFrame:
    rows = interval_delta(v).withColumn("installation", F.concat(F.lit("00"), F.col(METER)))
    return marts.to_mart_row(rows, parity=True)


# Enrichment


def valid_at(v: Views) -> DataFrame:
    orders = v.table("orders").select(
        "o_orderkey",
        F.col("o_orderdate").cast("date").alias("valid_from"),
        F.date_add("o_orderdate", 90).alias("valid_to"),
    )
    return validity.valid_at(orders, dt.date(1998, 6, 30), ("valid_from", "valid_to"))


def leading_zero_join(v: Views) -> DataFrame:
    devices = v.device().select(
        "equipmentnumber", "register", ltrim0(F.col("equipmentnumber")).alias("account")
    )
    orders = v.table("orders").select(F.col("o_custkey").cast("string").alias("account"), "o_orderkey")
    return orders.join(devices, "account").select("equipmentnumber", "register", "o_orderkey")


def _customer(v: Views) -> tuple[DataFrame, ...]:
    return v.readings(), v.location(), v.device(), v.contract()


def _account(v: Views) -> tuple[DataFrame, ...]:
    return v.account_readings(), v.premise(), v.device(), v.contract()


def _params(v: Views, params: Params, **changes) -> Params:
    return replace(params, **changes)


def hourly_enriched(v: Views) -> DataFrame:
    return reads.hourly_reads(*_customer(v), _params(v, READS))


def hourly_enriched_parity(v: Views) -> DataFrame:
    once, *master = _customer(v)
    return reads.hourly_reads(once.unionByName(once), *master, _params(v, READS, parity=True))


def hourly_enriched_ports(v: Views) -> DataFrame:
    """Two ports of each meter."""
    _, *master = _customer(v)
    return reads.hourly_reads(v.readings(ports=2), *master, READS)


def daily_enriched_ports(v: Views) -> DataFrame:
    _, *master = _customer(v)
    return reads.daily_reads(v.readings(ports=2), *master, READS)


def hourly_enriched_account(v: Views) -> DataFrame:
    return reads.hourly_reads_account(*_account(v), _params(v, READS))


def daily_enriched(v: Views) -> DataFrame:
    return reads.daily_reads(*_customer(v), _params(v, READS))


def daily_enriched_parity(v: Views) -> DataFrame:
    return reads.daily_reads(*_customer(v), _params(v, READS, parity=True))


def daily_enriched_account(v: Views) -> DataFrame:
    return reads.daily_reads_account(*_account(v), _params(v, READS))


def account_parity(v: Views) -> DataFrame:
    """Both account plans under parity, whose days are fixed whatever the settings."""
    params = _params(v, READS, parity=True, days_minus_hourly=-9, days_minus_daily=-9)
    both = reads.hourly_reads_account(*_account(v), params)
    return both.unionByName(reads.daily_reads_account(*_account(v), params))


def district_reads(v: Views) -> DataFrame:
    return horizon.in_districts(hourly_enriched(v), DISTRICTS, "district")


def _backfill(v: Views) -> tuple[DataFrame, ...]:
    return v.readings(), v.location(), v.device(), v.backfill_contract()


def backfill_hourly(v: Views) -> DataFrame:
    return reads.backfill_hourly(*_backfill(v), _params(v, READS, districts=DISTRICTS))


def backfill_daily(v: Views) -> DataFrame:
    return reads.backfill_daily(*_backfill(v), _params(v, READS, districts=DISTRICTS))


def combined_reads(v: Views) -> DataFrame:
    return marts.combined_reads(hourly_enriched(v), hourly_enriched_account(v))


def reads_row_counts(v: Views) -> DataFrame:
    both = marts.combined_reads(combined_reads(v), daily_enriched(v))
    return both.groupBy("read_interval_type").agg(F.count(F.lit(1)).alias("rows_loaded"))


def presorted_reads(v: Views) -> DataFrame:
    return marts.presort(hourly_enriched(v), "headend_meter_id", TS, "register")


def validity_overlaps(v: Views) -> DataFrame:
    """Orders of a customer whose 90 days share a day with those of another of the customer's orders."""
    orders = v.table("orders").select(
        "o_custkey",
        "o_orderkey",
        F.col("o_orderdate").cast("date").alias("valid_from"),
        F.date_add("o_orderdate", 90).alias("valid_to"),
    )
    return validity.overlapping(orders, ["o_custkey"], "valid_from", "valid_to")


# Loading again


def _tables(v: Views, **frames: DataFrame) -> Tables:
    """The views as source tables."""
    given = {
        "customer_readings": v.readings(),
        "account_readings": v.account_readings(),
        "locations": v.location(),
        "installed_devices": v.device(),
        "contracts": v.contract(),
        "premises": v.premise(),
    }
    return Tables(v.spark, frames=given | frames)


def reload_daily(v: Views) -> DataFrame:
    """Usage after two daily runs whose windows overlap, the second one twice."""
    out = jobs.Marts(scratch(v.spark, "reload"))
    for day in (15, 20, 20):
        jobs.run(["daily"], _tables(v), out, Params(as_of=dt.date(2024, 1, day), days_minus_daily=-10))
    keys = ("equipmentnumber", "register", "contractaccount")
    return sinks.read(v.spark, out.reads).groupBy(*keys).agg(
        F.count(F.lit(1)).alias("days"), F.count("consumption").alias("deltas"), F.sum("consumption").alias("usage")
    )


def _stored_tables(v: Views, root: str, **frames: DataFrame) -> Tables:
    """The views as source tables in files, so that no step computes a view again."""
    paths = {}

    def store(name: str, df: DataFrame) -> DataFrame:
        paths[name] = f"{name}_v1"
        df.write.parquet(f"{root}/raw/{paths[name]}")
        return v.spark.read.parquet(f"{root}/raw/{paths[name]}")

    readings = store("customer_readings", v.readings())
    given = {
        "account_readings": v.account_readings(readings),
        "locations": v.location(),
        "installed_devices": v.device(),
        "contracts": v.contract(),
        "premises": v.premise(),
    }
    for name, df in (given | frames).items():
        store(name, df)
    return Tables(v.spark, root, schemas={"": "raw"}, names=paths)


def incremental_equals_whole(v: Views) -> DataFrame:
    """The mart after two hourly runs, each over its own days, of both feeds."""
    root = scratch(v.spark, "incremental")
    tables, out = _stored_tables(v, root), jobs.Marts(f"{root}/marts")
    for day, back in ((16, -3), (20, -3)):
        params = Params(as_of=dt.date(2024, 1, day), days_minus_hourly=back)
        jobs.run(["hourly", "hourly_account"], tables, out, params)
    return sinks.read(v.spark, out.reads).drop(sinks.DATE)


RUN = Params(
    as_of=READS_DAY,
    as_of_ts=dt.datetime(2024, 1, 20, 12),
    min_usage=1,
    leak_hours=40,
    leak_min=-1,
    districts=DISTRICTS,
    slot_begin=BACKFILL_START,
    high_usage_endpoint=USAGE_URL,
    leak_endpoint=LEAK_URL,
)


def run_all_steps(v: Views) -> DataFrame:
    """The run table of a whole job from stored source tables, which is started three times under one id."""
    root = scratch(v.spark, "source")
    time = F.expr("timestamp_ntz'2024-01-10' - make_dt_interval(cast(meter_id as int) % 200)")
    later = F.date_add("scheduledmeterreadingdate", 365 * 24)
    frames = {
        # The backfills read some columns under other names.
        "contracts": v.contract().withColumns({k: F.col(c) for k, c in reads.BACKFILL_CONTRACT.items()}),
        "schedules": v.segment_schedule().withColumn("scheduledmeterreadingdate", later),
        "billing_reads": v.bills().withColumns({"meter_reading_time": time, "consumption_gl": F.lit(1.0)}),
        "billing_meters": v.meters(),
        "endpoint_types": v.endpoint_types(),
        "connection_contracts": v.connection_contracts(),
    }
    tables = _stored_tables(v, root, **frames)
    out = jobs.Marts(f"{root}/marts")
    for steps in (jobs.STEPS[:3], jobs.STEPS, jobs.STEPS):
        jobs.run(steps, tables, out, RUN, run_id="check")
    return sinks.read(v.spark, out.runs).select("run_id", "step", "rows", "finished_at")


def rejected_rows(v: Views) -> DataFrame:
    """Events as texts, some of which are no number, no time or have no meter."""
    number = F.when(F.col("event_id") % 97 == 0, F.lit("n/a")).otherwise(F.col("value").cast("decimal(18,2)").cast("string"))
    time = F.when(F.col("event_id") % 89 == 0, F.lit("soon")).otherwise(F.col("ts").cast("string"))
    meter = F.when(F.col("event_id") % 83 != 0, F.col("user_id").cast("string"))
    raw = v.table("events").select(
        "event_id",
        meter.alias("meter_id"),
        *[F.lit("x").alias(c) for c in ("transponder_id", "transponder_port", "unit_of_measure", "timezone", "battery_voltage")],
        F.col("user_id").alias("customer_id"),
        number.alias("reading_value"),
        time.alias("reading_datetime"),
        F.col("ts").alias("ingest_watermark"),
    )
    tables = Tables(v.spark, frames={"customer_readings": raw}, checked=True)
    fits = tables.load("customer_readings").agg(
        F.lit("customer_readings").alias("table"), F.lit("fits").alias("reason"), F.count(F.lit(1)).cast("string").alias("event")
    )
    out = tables.rejected("customer_readings")
    return out.select("table", "reason", F.get_json_object("row", "$.event_id").alias("event")).unionByName(fits)


# Billing, usage, alerts


def _ami_meters(v: Views) -> DataFrame:
    return billing.with_endpoint(billing.active_meters(v.meters()), v.endpoint_types(), "AMI")


def last_bill(v: Views) -> DataFrame:
    return billing.last_bill(v.bills(), _ami_meters(v), ["meter_id"])


def billing_stats(v: Views) -> DataFrame:
    totals = billing.bill_totals(v.bills(), ["meter_id"], BILLS.as_of_ts, BILLS.months)
    base = billing.bills_with_meters(totals, _ami_meters(v), ["meter_id"])
    stats = billing.billing_stats(base, [*billing.ACCOUNT, "register"], BILLS.sigma)
    return stats.withColumn("per_day_consumption", round2(F.col("per_day_consumption")))


def billing_stats_digits(v: Views) -> DataFrame:
    """Deviations of bills that differ by millionths only, in millionths."""
    near = F.lit("33.3333").cast("decimal(28,10)") + (F.col("number") % 7).cast("decimal(10,0)") / 1_000_000
    orders = v.table("orders").select(
        F.col("o_custkey").cast("string").alias("meter_id"),
        F.lit("01").alias("meter_reading_reason"),
        F.lit("U").alias("meter_reading_unit"),
        F.col("o_orderdate").alias("meter_reading_time"),
        F.col("o_orderkey").alias("number"),
    )
    totals = billing.bill_totals(
        orders.withColumn("consumption_gl", near.cast("decimal(28,10)")), ["meter_id"], BILLS.as_of_ts, BILLS.months
    )
    found = totals.groupBy("meter_id").agg(*merged_moments())
    return found.select("meter_id", "_n", round2(deviation_of_moments() * 1_000_000).alias("std_dev_millionths"))


def usage_since_bill(v: Views) -> DataFrame:
    recent = use.reads_after_bill(use.daily_usage(v.usage()), last_bill(v))
    return use.usage_since(recent, billing.ACCOUNT)


def _high_usage(v: Views, registers: bool = False, apart: bool = False, **changes) -> DataFrame:
    params = _params(v, BILLS, **changes)
    coming = schedule.next_read(v.segment_schedule(), BILLS_DAY)
    return use.high_usage(v.usage(apart), v.bills(registers, apart), v.meters(registers), coming, params)


def high_usage(v: Views) -> DataFrame:
    return _high_usage(v)


def high_usage_registers(v: Views) -> DataFrame:
    """Two registers with bills and usage of their own."""
    return _high_usage(v, registers=True, apart=True)


def high_usage_parity(v: Views) -> DataFrame:
    return _high_usage(v, registers=True, parity=True)


def next_read(v: Views) -> DataFrame:
    return schedule.next_read(v.order_schedule(), SCHEDULE_DAY)


def _projected(v: Views, registers: bool = False, apart: bool = False, **changes) -> DataFrame:
    return use.project_consumption(
        v.usage(apart),
        v.bills(apart, apart),
        v.meters(registers),
        v.endpoint_types(),
        schedule.next_read(v.segment_schedule(), PROJECTION_DAY),
        v.connection_contracts(),
        _params(v, PROJECTION, **changes),
    )


def projected_consumption(v: Views) -> DataFrame:
    return _projected(v)


def projected_consumption_registers(v: Views) -> DataFrame:
    return _projected(v, registers=True, apart=True)


def projected_consumption_parity(v: Views) -> DataFrame:
    return _projected(v, registers=True, parity=True)


def leak_alerts(v: Views) -> DataFrame:
    return leaks.leak_alerts(v.event_reads(), LEAK_TIME, 24, 5)


def alert_payload(v: Views) -> DataFrame:
    return alerts.alert_outbox(leak_alerts(v), LEAK_URL, EVENT_TIME).select(
        "event_type", "target", "payload", "businesspartnernumber", "contractaccount", "run_date"
    )


def _replies(outbox: DataFrame) -> DataFrame:
    return outbox.select(
        *alerts.OUTBOX_KEY,
        F.lit("{}").alias("event_result"),
        F.lit("HTTP/1.1 200 OK").alias("event_result_info1"),
        F.lit("OK").alias("event_extra_info1"),
    )


def audit_records(v: Views) -> DataFrame:
    outbox = alerts.alert_outbox(high_usage(v), USAGE_URL, EVENT_TIME)
    return alerts.audit_records(outbox, EVENT_TIME, "check", _replies(outbox))


def alerts_rerun(v: Views) -> DataFrame:
    """The outbox after three leak runs of one day."""
    out = jobs.Marts(scratch(v.spark, "alerts"))
    rows = v.event_reads().withColumns(
        {"feed": F.lit("customer"), "headend_meter_id": F.col("businesspartnernumber"), "register": F.lit("001")}
    )
    sinks.append(rows, out.reads)
    params = Params(as_of=LEAK_TIME.date(), leak_endpoint=LEAK_URL)
    for _ in range(3):
        jobs.run(["leaks"], Tables(v.spark), out, params)
    return sinks.read(v.spark, out.outbox).select(
        "event_type", "target", "payload", "businesspartnernumber", "contractaccount", "run_date"
    )


def audit_duplicates(v: Views) -> DataFrame:
    """Each message twice in the outbox and twice answered, two audit runs: one row for each alert."""
    out = jobs.Marts(scratch(v.spark, "audit"))
    messages = alerts.alert_outbox(high_usage(v), USAGE_URL, EVENT_TIME)
    sinks.append(messages.unionByName(messages), out.outbox)
    replies = _replies(sinks.read(v.spark, out.outbox))
    late = replies.withColumn("event_result", F.lit(None).cast("string"))
    params = Params(as_of=EVENT_TIME.date(), as_of_ts=EVENT_TIME, job_id="check")
    for _ in range(2):
        jobs.run_audit(Tables(v.spark), out, params, replies.unionByName(late))
    return sinks.read(v.spark, out.audit).drop(alerts.MESSAGE, "run_date")


# Writing and reading back


def _mart(df: DataFrame) -> DataFrame:
    return marts.to_mart_row(df).withColumn("feed", F.lit("customer"))


def _back(v: Views, target: sinks.Target) -> DataFrame:
    return sinks.read(v.spark, target).drop(sinks.DATE)


def append_reads(v: Views) -> DataFrame:
    target = sinks.Target.reads(scratch(v.spark, "append"))
    rows = _mart(hourly_enriched(v))
    sinks.append(rows, target)
    sinks.append(rows, target)
    return _back(v, target).drop("utilities_premise")


def mart_both_feeds(v: Views) -> DataFrame:
    """Readings of one feed as doubles, of the other as decimals, in one mart."""
    target = sinks.Target.reads(scratch(v.spark, "feeds"))
    once, *master = _customer(v)
    doubles = once.withColumn("reading_value", F.col("reading_value").cast("double"))
    for feed, rows in (
        ("account", hourly_enriched_account(v)),
        ("customer", reads.hourly_reads(doubles, *master, READS)),
    ):
        sinks.append(marts.reads_row(rows).withColumn("feed", F.lit(feed)), target)
    return _back(v, target)


def replace_slice(v: Views) -> DataFrame:
    """The hourly slice is written twice and stays once; the daily slice and an empty frame
    leave it alone."""
    target = sinks.Target.reads(scratch(v.spark, "slice"))
    hourly, daily = _mart(hourly_enriched(v)), _mart(daily_enriched(v))
    for rows in (hourly, daily, hourly, daily.where(F.lit(False))):
        sinks.replace_slice(rows, target)
    return _back(v, target)


def replace_all(v: Views) -> DataFrame:
    target = sinks.Target.published(scratch(v.spark, "all"))
    sinks.replace_all(last_bill(v), target)
    sinks.replace_all(next_read(v), target)
    return _back(v, target)


def overwrite_if_any(v: Views) -> DataFrame:
    """The backfill marts; then a schedule without rows, which leaves the stored one in place."""
    out = jobs.Marts(scratch(v.spark, "backfill"))
    jobs.publish_backfill(backfill_hourly(v), backfill_daily(v), next_read(v), out)
    empty = schedule.next_read(v.order_schedule(), dt.date(2100, 1, 1))
    sinks.overwrite_if_any(empty, out.next_read)
    return _back(v, out.next_read)


def publish_versions(v: Views) -> DataFrame:
    """All three backfill marts, published twice, first with other rows."""
    out = jobs.Marts(scratch(v.spark, "versions"))
    hourly, daily, coming = backfill_hourly(v), backfill_daily(v), next_read(v)
    jobs.publish_backfill(daily, hourly, coming.limit(0), out)
    jobs.publish_backfill(hourly, daily, coming, out)
    columns = ("headend_meter_id", "reading_datetime", "register", "consumption")
    found = [
        _back(v, target).select(F.lit(name).alias("mart"), *columns)
        for name, target in (("hourly", out.hourly), ("daily", out.daily))
    ]
    units = _back(v, out.next_read).select(
        F.lit("next_read").alias("mart"),
        F.col("meter_reading_unit").alias("headend_meter_id"),
        F.col("next_read_date").cast("timestamp_ntz").alias("reading_datetime"),
    )
    return found[0].unionByName(found[1]).unionByName(units, allowMissingColumns=True)


def export_csv(v: Views) -> DataFrame:
    """SQL text in a file, run over a view, written as CSV and read back."""
    folder = scratch(v.spark, "export")
    text = "SELECT r.meter_id, r.reading_datetime, r.reading_value FROM readings_to_export r"
    v.spark.createDataFrame([(text,)], "value string").coalesce(1).write.text(f"{folder}/sql")
    register(v.readings(), "readings_to_export")
    jobs.export_query(Tables(v.spark), f"{folder}/sql", f"{folder}/csv")
    drop(v.spark, "readings_to_export")
    kind = "meter_id string, reading_datetime timestamp_ntz, reading_value decimal(28,2)"
    return v.spark.read.schema(kind).option("header", True).csv(f"{folder}/csv")


CHECKS: dict[str, Callable[[Views], DataFrame]] = {
    f.__name__: f
    for f in (
        interval_delta,
        interval_delta_digits,
        dedupe_delta,
        dedupe_delta_parity,
        reads_horizon,
        reads_backfill,
        last_per_day,
        max_ts_per_day,
        daily_delta,
        mart_row_coercion,
        valid_at,
        validity_overlaps,
        reload_daily,
        incremental_equals_whole,
        rejected_rows,
        run_all_steps,
        leading_zero_join,
        hourly_enriched,
        hourly_enriched_parity,
        hourly_enriched_ports,
        hourly_enriched_account,
        daily_enriched,
        daily_enriched_parity,
        daily_enriched_ports,
        daily_enriched_account,
        account_parity,
        district_reads,
        backfill_hourly,
        backfill_daily,
        combined_reads,
        reads_row_counts,
        presorted_reads,
        last_bill,
        billing_stats,
        billing_stats_digits,
        usage_since_bill,
        high_usage,
        high_usage_registers,
        high_usage_parity,
        next_read,
        projected_consumption,
        projected_consumption_registers,
        projected_consumption_parity,
        leak_alerts,
        alert_payload,
        audit_records,
        alerts_rerun,
        audit_duplicates,
        append_reads,
        mart_both_feeds,
        replace_slice,
        replace_all,
        overwrite_if_any,
        publish_versions,
        export_csv,
    )
}


def _query(check: Callable[[Views], DataFrame]):
    def run(spark: SparkSession, folder: str) -> DataFrame:
        return plain(check(Views(spark, folder)))

    return run


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {name: _query(check) for name, check in CHECKS.items()}
