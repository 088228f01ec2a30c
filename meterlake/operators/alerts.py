"""Alert messages to be delivered by an outside sender, and the audit trail of their delivery."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from meterlake.functions import event_type, ntz, payload
from meterlake.operators.hotkeys import newest_first

#: Identity of an alert: one per kind, account meter and run date.
OUTBOX_KEY = (
    "event_type",
    "businesspartnernumber",
    "contractaccount",
    "equipmentnumber",
    "register",
    "run_date",
)
# The audit columns that hold a reply.
RESULTS = ("event_result", "event_result_info1", "event_extra_info1")

MESSAGE = "message_id"
_WHO = "businesspartnernumber string, contractaccount string, equipmentnumber string"
OUTBOX_SCHEMA = (
    f"event_type string, target string, payload string, {_WHO}, register string, last_read_time timestamp_ntz, "
    "current_usage double, high_usage_limit double, message_id string, run_date date"
)
AUDIT_SCHEMA = (
    "source_hostname string, event_type string, event_result string, event_result_info1 string, "
    f"event_extra_info1 string, event_extra_info2 string, event_extra_info3 string, {_WHO}, "
    "last_read_time timestamp_ntz, sum_consumption double, current_usage double, high_usage_limit double, "
    "created_at timestamp_ntz, message_id string, run_date date"
)


def message_id() -> Column:
    """The same id for the same alert in every run: a digest of the outbox key, with missing parts as such."""
    parts = [F.coalesce(F.concat(F.lit("="), F.col(c).cast("string")), F.lit("-")) for c in OUTBOX_KEY]
    return F.sha2(F.concat_ws("\x1f", *parts), 256)


def _once(df: DataFrame, key: str) -> DataFrame:
    """One row for each key, the greatest by all columns; copies are reduced before the shuffle."""
    return newest_first(df, [key], [F.desc_nulls_last(c) for c in df.columns if c != key])


def new_messages(messages: DataFrame, known: DataFrame | None) -> DataFrame:
    """Each message once, and not those in ``known``: a repeated run sends and audits nothing twice."""
    once = _once(messages, MESSAGE)
    return once if known is None else once.join(known.select(MESSAGE), MESSAGE, "left_anti").select(*messages.columns)


def replies_by_message(results: DataFrame) -> DataFrame:
    """(message_id and the reply columns), one reply for each message; ``results`` has the outbox key."""
    return _once(results.select(message_id().alias(MESSAGE), *RESULTS), MESSAGE)


def answered(messages: DataFrame, results: DataFrame) -> DataFrame:
    """The messages that the sender has a reply for."""
    return messages.join(results.select(message_id().alias(MESSAGE)), MESSAGE, "left_semi").select(*messages.columns)


def alert_outbox(
    alerts: DataFrame, target: str, event_ts: dt.datetime, *, parity: bool = False
) -> DataFrame:
    """One message per alert: where to send it and the JSON text.

    Leak alerts have no meter and no amounts: NULL, or with ``parity`` NaN for the amounts.
    """
    have = set(alerts.columns)
    none = F.lit(float("nan")) if parity else F.lit(None).cast("double")

    def text(name: str):
        return (F.col(name) if name in have else F.lit(None)).cast("string").alias(name)

    def number(name: str):
        return (F.col(name).cast("double") if name in have else none).alias(name)

    last = F.col("last_read_time") if "last_read_time" in have else F.lit(None)
    rows = alerts.select(
        event_type(F.lit(target)).alias("event_type"),
        F.lit(target).alias("target"),
        payload(
            F.col("businesspartnernumber"), F.col("contractaccount").cast("string"), ntz(event_ts)
        ).alias("payload"),
        text("businesspartnernumber"),
        text("contractaccount"),
        text("equipmentnumber"),
        text("register"),
        last.cast("timestamp_ntz").alias("last_read_time"),
        number("current_usage"),
        number("high_usage_limit"),
        F.lit(event_ts.date()).alias("run_date"),
    )
    return rows.withColumn(MESSAGE, message_id())


def audit_records(
    outbox: DataFrame,
    event_ts: dt.datetime,
    source: str,
    results: DataFrame | None = None,
    *,
    keyed: bool = False,
) -> DataFrame:
    """Audit row of each message. ``results`` holds the replies, by the outbox key, one of them for each message.

    Without ``results`` the reply columns are NULL: prepared, not yet delivered. With ``keyed`` the message id
    and the run date are kept, by which a later run knows the messages that have a row.
    """
    if results is None:
        rows = outbox.withColumns({c: F.lit(None).cast("string") for c in RESULTS})
    else:
        rows = outbox.join(replies_by_message(results), MESSAGE, "left")
    return rows.select(
        F.lit(source).alias("source_hostname"),
        "event_type",
        "event_result",
        "event_result_info1",
        "event_extra_info1",
        F.col("payload").alias("event_extra_info2"),
        F.col("target").alias("event_extra_info3"),
        "businesspartnernumber",
        "contractaccount",
        "equipmentnumber",
        "last_read_time",
        F.col("current_usage").alias("sum_consumption"),
        "current_usage",
        "high_usage_limit",
        ntz(event_ts).alias("created_at"),
        *([MESSAGE, "run_date"] if keyed else []),
    )
