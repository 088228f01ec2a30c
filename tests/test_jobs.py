"""The job run from source tables to marts, over the views of the smallest test data."""

import datetime as dt
from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from meterlake import Params
from meterlake.__main__ import main
from meterlake.checks.views import Views
from meterlake import sinks
from meterlake.plans import jobs, reads
from meterlake.sources import Tables
from meterlake.operators import alerts
from tests.frames import out

PARAMS = Params(
    as_of=dt.date(2024, 1, 20),
    as_of_ts=dt.datetime(2024, 1, 20, 12),
    months=15,
    min_usage=1,
    leak_hours=40,
    leak_min=-1,
    high_usage_endpoint="https://h/api/usage",
    leak_endpoint="https://h/api/leak",
    slot_begin=dt.datetime(2024, 1, 10),
)


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    root = tmp_path_factory.mktemp("source")
    v = Views(spark, "/root/testdata/sf0.001")
    bill_time = F.expr("timestamp_ntz'2024-01-10' - make_dt_interval(cast(meter_id as int) % 200)")
    frames = {
        "customer_readings": v.readings(),
        "account_readings": v.account_readings(),
        "locations": v.location(),
        "installed_devices": v.device(),
        "contracts": v.contract().withColumns({k: F.col(c) for k, c in reads.BACKFILL_CONTRACT.items()}),
        "premises": v.premise(),
        "schedules": v.segment_schedule().withColumn(
            "scheduledmeterreadingdate", F.date_add("scheduledmeterreadingdate", 365 * 24)
        ),
        "billing_reads": v.bills().withColumns(
            {"meter_reading_time": bill_time, "consumption_gl": F.lit(1.0)}
        ),
        "billing_meters": v.meters(),
        "endpoint_types": v.endpoint_types(),
        "connection_contracts": v.connection_contracts(),
    }
    for name, df in frames.items():
        df.write.parquet(str(root / name))
    return Tables(spark, str(root))


def test_all_steps(spark, tables, tmp_path):
    marts = jobs.Marts(str(tmp_path))
    done = jobs.run(jobs.STEPS, tables, marts, PARAMS)
    assert list(done) == list(jobs.STEPS)
    stored = spark.read.parquet(marts.reads.path)
    counts = {(r["feed"], r["read_interval_type"]): r["count"]
              for r in stored.groupBy("feed", "read_interval_type").count().collect()}
    assert counts == {
        ("customer", "HOURLY"): done["hourly"],
        ("customer", "DAILY"): done["daily"],
        ("account", "HOURLY"): done["hourly_account"],
        ("account", "DAILY"): done["daily_account"],
    }
    assert all(n > 0 for n in counts.values())
    assert dict(stored.dtypes)["installation"] == "string"
    assert sinks.read(spark, marts.next_read).count() == done["next_read"] == 5
    assert sinks.read(spark, marts.projected).count() == done["projection"] > 0
    assert done["backfill"] == sinks.read(spark, marts.hourly).count() + sinks.read(spark, marts.daily).count() > 0
    kinds = {r["event_type"] for r in spark.read.parquet(marts.outbox.path).collect()}
    assert kinds == {"usage", "leak"}

    assert done["audit"] == done["high_usage"] + done["leaks"] > 0
    assert jobs.run_audit(tables, marts, PARAMS) == 0
    assert jobs.run(["high_usage", "leaks"], tables, marts, PARAMS) == {"high_usage": 0, "leaks": 0}
    audit = spark.read.parquet(marts.audit.path)
    assert audit.count() == spark.read.parquet(marts.outbox.path).count()
    assert {r["source_hostname"] for r in audit.collect()} == {"meterlake"}

    again = jobs.run(["hourly", "hourly_account"], tables, marts, PARAMS)
    slices = {(r["feed"], r["read_interval_type"]): r["count"]
              for r in spark.read.parquet(marts.reads.path).groupBy("feed", "read_interval_type").count().collect()}
    assert slices[("customer", "HOURLY")] == again["hourly"] == done["hourly"]
    assert slices[("account", "HOURLY")] == again["hourly_account"]
    assert slices[("customer", "DAILY")] == done["daily"]


def test_a_repeated_run_goes_on_where_it_stopped(spark, tables, tmp_path, monkeypatch):
    marts = jobs.Marts(str(tmp_path))

    def fails(*_):
        raise RuntimeError("lost")

    with monkeypatch.context() as patch:
        patch.setattr(jobs, "run_next_read", fails)
        with pytest.raises(RuntimeError):
            jobs.run(["hourly", "next_read"], tables, marts, PARAMS, run_id="r1")
    first = jobs.finished_steps(tables, marts, "r1")
    assert list(first) == ["hourly"]
    with monkeypatch.context() as patch:
        patch.setattr(jobs, "run_reads", fails)
        assert jobs.run(["hourly", "next_read"], tables, marts, PARAMS, run_id="r1") == {**first, "next_read": 5}
    assert jobs.finished_steps(tables, marts, "r2") == {}


def test_replies_that_come_later(spark, tables, tmp_path):
    marts = jobs.Marts(str(tmp_path))
    found = spark.createDataFrame([("b1", "c1"), ("b2", "c2")], "businesspartnernumber string, contractaccount string")
    messages = alerts.alert_outbox(found, PARAMS.leak_endpoint, PARAMS.as_of_ts)
    sinks.append(messages, marts.outbox)
    reply = messages.select(*alerts.OUTBOX_KEY, *[F.lit("x").alias(c) for c in alerts.RESULTS])
    for some, rows in ((reply.limit(0), 0), (reply.where("contractaccount = 'c1'"), 1), (reply, 1), (reply, 0)):
        assert jobs.run_audit(tables, marts, PARAMS, some) == rows
    assert sinks.read(spark, marts.audit).where("event_result = 'x'").count() == 2


def test_border_tables(spark, tables, tmp_path):
    """What a run reads begins with the reading before its window, wherever the windows of earlier runs began."""
    marts = jobs.Marts(str(tmp_path))
    whole = reads.last_readings(jobs._feed(tables, "customer"), PARAMS, dt.date(2024, 1, 12))
    seen = reads.last_readings(jobs._feed(tables, "customer").where("reading_datetime >= '2024-01-05'"), PARAMS, dt.date(2024, 1, 12))
    for day, want in ((5, None), (9, None), (12, seen), (12, seen)):
        got = jobs.last_readings(tables, marts, PARAMS, "customer", dt.date(2024, 1, day))
        if want is not None:
            assert out(got, "meter_id") == out(want, "meter_id")
        elif day == 5:
            assert got.count() == 0
    assert len(sinks.labels(spark, marts.borders)) == 3
    assert 0 < seen.count() <= whole.count()


def test_parity_account_feed_replaces_the_type(spark, tables, tmp_path):
    marts = jobs.Marts(str(tmp_path))
    done = jobs.run(["hourly", "hourly_account"], tables, marts, replace(PARAMS, parity=True))
    stored = spark.read.parquet(marts.reads.path)
    assert stored.count() == done["hourly_account"]
    assert stored.where("consumption IS NULL").count() == 0


def test_unknown_step(tables, tmp_path):
    with pytest.raises(ValueError):
        jobs.run(["hourly", "nonsense"], tables, jobs.Marts(str(tmp_path)), PARAMS)


def test_empty_account_result_keeps_the_slice(spark, tables, tmp_path):
    marts = jobs.Marts(str(tmp_path))
    jobs.run(["hourly_account"], tables, marts, PARAMS)
    before = spark.read.parquet(marts.reads.path).count()
    later = replace(PARAMS, as_of=dt.date(2030, 1, 1), as_of_ts=None)
    assert jobs.run(["hourly_account"], tables, marts, later) == {"hourly_account": 0}
    assert spark.read.parquet(marts.reads.path).count() == before


def test_command_line(spark, tables, tmp_path, capsys):
    main(["--steps", "hourly, next_read", "--marts", str(tmp_path), "--tables", tables.root,
          "--params", '{"as_of": "2024-01-20"}'])
    printed = capsys.readouterr().out
    assert "hourly: " in printed and "next_read: 5 rows" in printed


def test_export_query(spark, tables, tmp_path):
    tables.load("locations").createOrReplaceTempView("places")
    sql = tmp_path / "q.sql"
    sql.write_text("SELECT p.functionallocation AS `p.place` FROM places p WHERE length(functionallocation) < :n")
    jobs.export_query(tables, str(sql), str(tmp_path / "csv"), {"n": 2})
    back = spark.read.option("header", True).csv(str(tmp_path / "csv"))
    assert back.columns == ["place"]
    assert len(out(back)) == 10


def test_both_backfills_read_stored_points_and_readings(spark, tables, tmp_path, monkeypatch):
    """Service points and the districts' readings are made once, and the rows are those of the plans from the sources."""
    given, publish = [], jobs.publish_backfill

    def kept(hourly, daily, *rest):
        given.extend([hourly, daily])
        return publish(hourly, daily, *rest)

    monkeypatch.setattr(jobs, "publish_backfill", kept)
    marts = jobs.Marts(str(tmp_path))
    source = [tables.load(n) for n in ("customer_readings", "locations", "installed_devices", "contracts")]
    found = reads.backfill_hourly(*source, PARAMS).groupBy("district").count().orderBy("district").first()
    for districts in ((found["district"],), ()):
        params = replace(PARAMS, districts=districts)
        whole = [reads.backfill_hourly(*source, params), reads.backfill_daily(*source, params)]
        assert jobs.run_backfill(tables, marts, params) == sum(df.count() for df in whole) > 0
        for target, want in zip((marts.hourly, marts.daily), whole, strict=True):
            got = sinks.read(spark, target).select(*want.columns)
            assert got.exceptAll(want).isEmpty() and want.exceptAll(got).isEmpty()
    files = {f for df in given for f in df.inputFiles()}
    assert not any("/installed_devices/" in f or "/contracts/" in f for f in files)
    assert not any("/customer_readings/" in f for df in given[:2] for f in df.inputFiles())
    with pytest.raises(ValueError):
        jobs.run_backfill(tables, jobs.Marts(str(tmp_path / "none")), replace(PARAMS, slot_begin=None))
    assert not (tmp_path / "none").exists()
