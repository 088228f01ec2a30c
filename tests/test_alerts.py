import math
from decimal import Decimal

from pyspark.sql import functions as F

from meterlake.operators import alerts
from tests.frames import day, frame, out, ts

WHEN = ts("2024-03-10 05:06:07.5")
LEAK = "businesspartnernumber string, contractaccount string"
USAGE = LEAK + ", equipmentnumber string, register string, last_read_time timestamp_ntz, " \
    "current_usage decimal(18,2), high_usage_limit decimal(18,2)"


def test_outbox_of_leaks(spark):
    df = alerts.alert_outbox(frame(spark, LEAK, ("b", "c")), "https://h/x/leak", WHEN)
    row = df.first()
    assert (row["event_type"], row["target"], row["run_date"]) == ("leak", "https://h/x/leak", day("2024-03-10"))
    assert row["payload"].endswith('"alertDateTime":"2024-03-10T05:06:07Z"}')
    assert row["equipmentnumber"] is None and row["current_usage"] is None
    parity = alerts.alert_outbox(frame(spark, LEAK, ("b", "c")), "https://h/x/leak", WHEN, parity=True)
    assert math.isnan(parity.first()["high_usage_limit"])


def test_audit_of_usage_alerts(spark):
    found = frame(
        spark, USAGE,
        ("b", "c", "5", "001", "2024-03-01 00:00:00", "3500.50", "100"),
        ("b", "c", "5", "002", "2024-03-01 00:00:00", "3600.50", "100"),
    )
    outbox = alerts.alert_outbox(found, "https://h/x/usage", WHEN)
    replies = outbox.where("register = '001'").select(
        *alerts.OUTBOX_KEY, F.lit("{}").alias("event_result"), F.lit("200").alias("event_result_info1"),
        F.lit("OK").alias("event_extra_info1"),
    )
    audit = alerts.audit_records(outbox, WHEN, "job", replies)
    assert audit.columns == [
        "source_hostname", "event_type", "event_result", "event_result_info1", "event_extra_info1",
        "event_extra_info2", "event_extra_info3", "businesspartnernumber", "contractaccount",
        "equipmentnumber", "last_read_time", "sum_consumption", "current_usage", "high_usage_limit",
        "created_at",
    ]
    got = out(audit.select("source_hostname", "event_result", "event_extra_info1", "sum_consumption",
                           "current_usage", "created_at"), "sum_consumption")
    assert got == [("job", "{}", "OK", 3500.5, 3500.5, WHEN), ("job", None, None, 3600.5, 3600.5, WHEN)]
    assert alerts.audit_records(outbox, WHEN, "job").where("event_result IS NULL").count() == 2
    assert Decimal("3500.50") == Decimal(str(got[0][3])).quantize(Decimal("0.01"))
