"""Declared schemas of the source tables, and rows that do not fit them.

A source column of another type is converted; a row with a value that does not convert, or without a value
that it must have, is set aside with the reason. Where the types agree nothing is converted, so filters on
the column still reach the scan.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_VALIDITY = "devicevaliditystartdate date, devicevalidityenddate date"

# The columns of the source tables, by logical name.
SCHEMAS = {
    "customer_readings": "meter_id string, transponder_id string, transponder_port string, customer_id string, "
    "reading_value decimal(28,10), unit_of_measure string, reading_datetime timestamp_ntz, timezone string, "
    "battery_voltage string, ingest_watermark timestamp_ntz",
    "account_readings": "meter_id string, miu_serial_number string, account_id string, reading decimal(28,10), "
    "read_date_time timestamp_ntz, ingest_watermark timestamp_ntz",
    "locations": "functionallocation string",
    "installed_devices": "devicelocation string, equipmentnumber string, installation string, register string, "
    f"logicalregisternumber string, {_VALIDITY}, registervaliditystartdate date, registervalidityenddate date",
    "contracts": f"equipmentnumber string, register string, {_VALIDITY}, utilitiesmoveindate date, "
    "utilitiesmoveoutdate date, businesspartnernumber string, contractaccount string, utilitiescontract string, "
    "regionalstructuregrouping string, devicelocation string",
    "premises": "utilitiespremise string, utilitiesinstallation string, division string",
    "schedules": "meterreadingunit string, scheduledmeterreadingdate date",
    "billing_reads": "meter_id string, installation string, register string, meter_reading_time timestamp_ntz, "
    "meter_reading_reason string, consumption_gl decimal(28,10), meter_reading_unit string",
    "billing_meters": "meter_id string, installation string, register string, isactive string, "
    "end_point_type_1 string, business_partner_number string, connection_contract_number string",
    "endpoint_types": "id string, endpoint_group string",
    "connection_contracts": "business_partner_number string, connection_contract_number string, premise_id string",
}
#: Values that a row must have: without them it can be neither ordered nor joined.
REQUIRED = {
    "customer_readings": ("meter_id", "reading_datetime"),
    "account_readings": ("meter_id", "read_date_time"),
    "billing_reads": ("meter_id", "meter_reading_time"),
    "schedules": ("meterreadingunit", "scheduledmeterreadingdate"),
}


def declared(table: str) -> list[tuple[str, str]]:
    """(column, type) of a source table."""
    columns, part, depth = [], "", 0
    for ch in SCHEMAS[table] + ",":
        depth += {"(": 1, ")": -1}.get(ch, 0)
        if ch == "," and not depth:
            name, _, kind = part.strip().partition(" ")
            columns.append((name, kind))
            part = ""
        else:
            part += ch
    return columns


def _checked(df: DataFrame, table: str) -> tuple[dict[str, Column], list[Column]]:
    """The converted columns, and for each thing that can be wrong a text or null."""
    have = dict(df.dtypes)
    missing = [name for name, _ in declared(table) if name not in have]
    if missing:
        raise ValueError(f"{table} has no column {', '.join(missing)}")
    values, wrong = {}, []
    for name, kind in declared(table):
        source = F.col(f"`{name}`")
        values[name] = source
        if have[name] != kind:
            values[name] = source.try_cast(kind)
            text = F.concat(F.lit(f"{name}: "), source.cast("string"))
            wrong.append(F.when(source.isNotNull() & values[name].isNull(), text))
        if name in REQUIRED.get(table, ()):
            wrong.append(F.when(source.isNull(), F.lit(f"{name}: missing")))
    return values, wrong


def conforming(df: DataFrame, table: str) -> DataFrame:
    """The rows that fit, with the declared columns and types."""
    values, wrong = _checked(df, table)
    rows = df
    if wrong:
        rows = df.where(reduce(lambda a, b: a & b, [w.isNull() for w in wrong]))
    return rows.select(*(c.alias(n) for n, c in values.items()))


def rejected(df: DataFrame, table: str) -> DataFrame:
    """(table, reason, row) of the rows that do not fit; the row as JSON, as it came."""
    _, wrong = _checked(df, table)
    reason = F.concat_ws("; ", *wrong) if wrong else F.lit("")
    row = F.to_json(F.struct(*[F.col(f"`{c}`").cast("string").alias(c) for c in df.columns]))
    return df.select(F.lit(table).alias("table"), reason.alias("reason"), row.alias("row")).where("reason <> ''")
