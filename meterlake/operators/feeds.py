"""Both reading feeds in one schema."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meterlake.functions import to_id

METER = "meter_id"
PORT = "transponder_port"
TS = "reading_datetime"
VALUE = "reading_value"


def normalise_customer_feed(df: DataFrame) -> DataFrame:
    """Readings located by customer id."""
    return df.select(
        to_id(F.col("meter_id")).alias("meter_id"),
        "transponder_id",
        "transponder_port",
        to_id(F.col("customer_id")).alias("functionallocation"),
        "reading_value",
        "unit_of_measure",
        "reading_datetime",
        "timezone",
        "battery_voltage",
        "ingest_watermark",
    )


def normalise_account_feed(df: DataFrame) -> DataFrame:
    """Readings located by account id. Unit, zone, port and battery are constants in this feed."""
    return df.select(
        to_id(F.col("meter_id")).alias("meter_id"),
        F.col("miu_serial_number").alias("transponder_id"),
        F.lit("1").alias("transponder_port"),
        to_id(F.col("account_id")).alias("utilities_premise"),
        F.col("reading").alias("reading_value"),
        F.lit("").alias("unit_of_measure"),
        F.col("read_date_time").alias("reading_datetime"),
        F.lit("GMT").alias("timezone"),
        F.lit("").alias("battery_voltage"),
        "ingest_watermark",
    )
