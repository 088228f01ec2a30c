import datetime as dt

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from meterlake import sinks
from meterlake.operators import marts
from meterlake.session import scratch
from meterlake.sinks import tables
from tests.frames import frame, out

ROW = "feed string, read_interval_type string, headend_meter_id string, reading_datetime timestamp_ntz, " \
    "register string, v int"


def rows(spark, kind, *values):
    return frame(spark, ROW, *[("f", kind, f"m{v}", "2024-01-01 00:00:00", "001", v) for v in values])


def stored(spark, target):
    return out(sinks.read(spark, target).select("read_interval_type", "v"), "read_interval_type", "v")


def test_append_twice_repeats(spark, tmp_path):
    target = sinks.Target.reads(str(tmp_path / "t"))
    for _ in range(2):
        sinks.append(rows(spark, "HOURLY", 1), target)
    assert stored(spark, target) == [("HOURLY", 1), ("HOURLY", 1)]


def test_replace_slice(spark, tmp_path):
    target = sinks.Target.reads(str(tmp_path / "t"))
    sinks.replace_slice(rows(spark, "HOURLY", 1, 2), target)
    sinks.replace_slice(rows(spark, "DAILY", 3), target)
    sinks.replace_slice(rows(spark, "HOURLY", 4), target)
    sinks.replace_slice(rows(spark, "HOURLY", 4), target)
    want = [("DAILY", 3), ("HOURLY", 4)]
    assert stored(spark, target) == want
    sinks.replace_slice(rows(spark, "HOURLY", 5).where(F.lit(False)), target)
    assert stored(spark, target) == want
    with pytest.raises(ValueError):
        sinks.replace_slice(rows(spark, "HOURLY", 5), sinks.Target(str(tmp_path / "u")))


def test_replace_all_and_if_any(spark, tmp_path):
    target = sinks.Target.published(str(tmp_path / "t"))
    none = rows(spark, "DAILY", 1).where("v > 5")
    with pytest.raises(FileNotFoundError):
        sinks.read(spark, target)
    assert sinks.replace_all(rows(spark, "DAILY", 1, 2), target) == 2
    assert not sinks.overwrite_if_any(none, target)
    assert stored(spark, target) == [("DAILY", 1), ("DAILY", 2)]
    assert sinks.overwrite_if_any(rows(spark, "DAILY", 3), target)
    assert stored(spark, target) == [("DAILY", 3)]
    sinks.replace_all(none, target)
    assert stored(spark, target) == []


def test_observed_rows(spark, tmp_path):
    df, seen = marts.observe_rows(rows(spark, "DAILY", 1, 2, 3), "written")
    df.write.parquet(str(tmp_path / "t"))
    assert seen.get["rows"] == 3


def test_export_csv(spark, tmp_path):
    df = spark.sql("SELECT 'a,\"b' AS `t.name`, TIMESTAMP_NTZ'2024-01-01 01:02:03.000456' AS at, 5 AS n, NULL AS x")
    sinks.export_csv(df.coalesce(1), str(tmp_path / "out"))
    text = next((tmp_path / "out").glob("*.csv")).read_text().splitlines()
    assert text[0] == '"name","at","n","x"'
    assert text[1] == '"a,\\"b","2024-01-01 01:02:03.000456","5","null"'
    with pytest.raises(AnalysisException):
        sinks.export_csv(df, str(tmp_path / "out"))


def test_csv_names():
    assert tables.csv_names(["r.id", "s.id", "id_2", "a.b.c", ".x"]) == ["id", "id_2", "id_2_2", "b.c", ".x"]


def test_jdbc_write_options():
    got = tables.jdbc_write_options("jdbc:x", "t", {"user": "u", "batchsize": "5"})
    assert got == {"batchsize": "5", "user": "u", "url": "jdbc:x", "dbtable": "t"}


def test_scratch_is_under_the_shared_folder(spark):
    shared = spark.conf.get("spark.checkpoint.dir")
    first, second = scratch(spark, "x"), scratch(spark, "x")
    assert first.startswith(f"{shared}/x-") and first != second


def test_dates_are_not_shifted(spark, tmp_path):
    target = sinks.Target(str(tmp_path / "t"))
    sinks.replace_all(frame(spark, "d date", ("2024-03-10",)), target)
    assert out(spark.read.parquet(target.path)) == [(dt.date(2024, 3, 10),)]
    with pytest.raises(ValueError):
        sinks.overwrite_if_any(frame(spark, "d date", ("2024-03-10",)), target)


def dated(spark, *days, kind="DAILY", v=1):
    return frame(spark, ROW, *[("f", kind, "m", f"2024-01-{d:02} 00:00:00", "001", v) for d in days])


def test_only_the_days_of_a_load_are_replaced(spark, tmp_path):
    target = sinks.Target.reads(str(tmp_path / "t"))
    assert sinks.replace_slice(dated(spark, 1, 2, 3), target) == 3
    for _ in range(2):
        sinks.replace_slice(dated(spark, 3, 4, v=2), target)
    sinks.replace_slice(dated(spark, 3, kind="HOURLY", v=9), target)
    got = sinks.read(spark, target).where("read_interval_type = 'DAILY'").select("reading_datetime", "v")
    assert [(r[0].day, r[1]) for r in out(got, "reading_datetime")] == [(1, 1), (2, 1), (3, 2), (4, 2)]
    assert sinks.replace_kind(dated(spark, 7, v=5), target, feed="f", read_interval_type="DAILY") == 1
    assert sinks.replace_kind(dated(spark, 7).limit(0), target, feed="f", read_interval_type="DAILY") == 0
    assert stored(spark, target) == [("DAILY", 5), ("HOURLY", 9)]
    with pytest.raises(ValueError):
        sinks.replace_kind(dated(spark, 7), target, read_interval_type="DAILY")


def test_a_failing_write_keeps_the_old_rows(spark, tmp_path):
    target = sinks.Target.published(str(tmp_path / "t"), ("v",))
    sinks.publish(spark.range(0, 5).selectExpr("id AS v"), target)
    fails = spark.range(0, 100).selectExpr("IF(id = 99, raise_error('broken'), id) AS v")
    with pytest.raises(Exception, match="broken"):
        sinks.publish(fails, target)
    assert sinks.read(spark, target).count() == 5
    assert sinks.publish(spark.range(3).selectExpr("id AS v"), target) == 3
    assert sinks.read(spark, target).count() == 3


def test_a_reader_keeps_the_version_it_began_with(spark, tmp_path):
    target = sinks.Target.published(str(tmp_path / "t"))
    sinks.publish(spark.range(5), target)
    before = sinks.read(spark, target)
    sinks.publish(before.where("id > 1"), target)
    assert before.count() == 5 and sinks.read(spark, target).count() == 3
    sinks.publish(spark.range(7), target, label="other")
    assert sinks.read(spark, target).count() == 3 and sinks.read(spark, target, "other").count() == 7


def test_a_publication_runs_its_plan_once(spark, tmp_path):
    seen = spark.sparkContext.accumulator(0)

    def count(batches):
        for batch in batches:
            seen.add(batch.num_rows)
            yield batch

    df = spark.range(0, 100, 1, 4).mapInArrow(count, "id long")
    assert sinks.publish(df, sinks.Target.published(str(tmp_path / "t")), if_any=True) == 100
    assert seen.value == 100


def test_files_are_bounded_and_hold_neighbouring_meters(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(tables, "FILE_ROWS", 200)
    target = sinks.Target.reads(str(tmp_path / "t"))
    rows = spark.range(0, 3000).selectExpr(
        "'f' AS feed", "'HOURLY' AS read_interval_type", "lpad(id % 100, 4, '0') AS headend_meter_id",
        "timestamp_ntz'2024-01-01' + make_dt_interval(0, 0, cast(id AS int)) AS reading_datetime", "'001' AS register",
    )
    assert sinks.append(rows, target) == 3000
    files = spark.read.parquet(target.path).groupBy(F.input_file_name().alias("file")).agg(
        F.count("*").alias("n"), F.min("headend_meter_id").alias("low"), F.max("headend_meter_id").alias("high")
    ).collect()
    days = len({f["file"].rsplit("/", 2)[1] for f in files})
    assert max(f["n"] for f in files) <= 200 and len(files) <= 3000 / 200 + 4 * days
    holds = [f for f in files if f["low"] <= "0042" <= f["high"]]
    assert len(holds) <= len(files) / 2
