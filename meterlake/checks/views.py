"""Meter data derived from the star-schema test tables.

Every view is a plain DataFrame over whole tables; ``oracle.py`` states the same view in SQL.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from meterlake.functions import MONEY
from meterlake.operators.hotkeys import running_total, slotted, without_slots

FOREVER = "9999-12-31"


class Views:
    """Views over one data folder."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.folder = folder
        self._tables: dict[str, DataFrame] = {}

    def table(self, name: str) -> DataFrame:
        if name not in self._tables:
            self._tables[name] = self.spark.read.parquet(f"{self.folder}/{name}.parquet")
        return self._tables[name]

    def readings(self, ports: int = 1) -> DataFrame:
        """Customer feed: events as readings of a register that adds up the event values.

        With more ``ports`` each user's events go to the registers of that many ports.
        """
        events = self.table("events").select(
            F.lpad(F.col("user_id").cast("string"), 8, "0").alias("meter_id"),
            F.col("user_id").alias("customer_id"),
            F.col("ts").alias("reading_datetime"),
            "event_id",
            F.col("value").cast(MONEY).alias("_value"),
            (F.col("event_id") % ports + 1).cast("string").alias("transponder_port"),
        )
        keys, order = ["meter_id", "transponder_port"], ["reading_datetime", "event_id"]
        rows = slotted(events, keys, "reading_datetime")
        rows = without_slots(running_total(rows, keys, order, "_value", "reading_value"), events, keys)
        return rows.select(
            "meter_id",
            F.concat(F.lit("T"), F.col("customer_id")).alias("transponder_id"),
            "transponder_port",
            "customer_id",
            F.col("reading_value").cast(MONEY).alias("reading_value"),
            F.lit("GAL").alias("unit_of_measure"),
            "reading_datetime",
            F.lit("UTC").alias("timezone"),
            F.lit("").alias("battery_voltage"),
            F.col("reading_datetime").alias("ingest_watermark"),
        )

    def fine_readings(self) -> DataFrame:
        """Readings of six digits: the event number's millionths are added to the register."""
        rows = self.table("events").select(
            F.col("user_id").cast("string").alias("meter_id"),
            F.col("ts").alias("reading_datetime"),
            (F.col("value").cast(MONEY) + F.col("event_id").cast("decimal(18,0)") / 1_000_000)
            .cast("decimal(28,10)")
            .alias("reading_value"),
        )
        return rows

    def account_readings(self, readings: DataFrame | None = None) -> DataFrame:
        """Account feed: the same readings, also from a table that holds them."""
        return (self.readings() if readings is None else readings).select(
            "meter_id",
            F.col("transponder_id").alias("miu_serial_number"),
            F.col("customer_id").alias("account_id"),
            F.col("reading_value").alias("reading"),
            F.col("reading_datetime").alias("read_date_time"),
            "ingest_watermark",
        )

    def location(self) -> DataFrame:
        key = F.col("c_custkey").cast("string")
        return self.table("customer").select(key.alias("functionallocation"))

    def _registers(self) -> DataFrame:
        """Customers by register: one, or two for every tenth customer."""
        two = F.array(F.lit("001"), F.lit("002"))
        each = F.when(F.col("c_custkey") % 10 == 0, two).otherwise(F.array(F.lit("001")))
        return self.table("customer").withColumn("register", F.explode(each))

    @staticmethod
    def _device_columns() -> list[Column]:
        key = F.col("c_custkey")
        ended = F.when(key % 7 == 0, F.lit("2010-01-01")).otherwise(F.lit(FOREVER))
        return [
            F.lpad(key.cast("string"), 10, "0").alias("equipmentnumber"),
            "register",
            F.lit("2000-01-01").cast("date").alias("devicevaliditystartdate"),
            ended.cast("date").alias("devicevalidityenddate"),
        ]

    def device(self) -> DataFrame:
        key = F.col("c_custkey")
        return self._registers().select(
            key.cast("string").alias("devicelocation"),
            (key + 100000).alias("installation"),
            F.concat(F.lit("L"), F.col("register")).alias("logicalregisternumber"),
            *self._device_columns(),
            F.lit("2000-01-01").cast("date").alias("registervaliditystartdate"),
            F.lit(FOREVER).cast("date").alias("registervalidityenddate"),
        )

    def contract(self) -> DataFrame:
        key = F.col("c_custkey")
        left = F.when(key % 11 == 0, F.lit("2020-01-01")).otherwise(F.lit(FOREVER))
        nation = self.table("nation").select(F.col("n_nationkey").alias("c_nationkey"), "n_name")
        return (
            self._registers()
            .join(nation, "c_nationkey")
            .select(
                *self._device_columns(),
                F.lit("2005-01-01").cast("date").alias("utilitiesmoveindate"),
                left.cast("date").alias("utilitiesmoveoutdate"),
                key.cast("string").alias("businesspartnernumber"),
                (key + 500000).alias("contractaccount"),
                (key + 700000).alias("utilitiescontract"),
                F.col("n_name").alias("regionalstructuregrouping"),
                key.cast("string").alias("devicelocation"),
            )
        )

    def backfill_contract(self) -> DataFrame:
        return self.contract().withColumnsRenamed(
            {
                "utilitiesmoveindate": "moveindate",
                "utilitiesmoveoutdate": "moveoutdate",
                "utilitiescontract": "contract",
                "regionalstructuregrouping": "district",
            }
        )

    def premise(self) -> DataFrame:
        sewer = F.when(F.col("c_mktsegment") == "BUILDING", F.lit("SW")).otherwise(F.lit("W"))
        return self.table("customer").select(
            F.col("c_custkey").cast("string").alias("utilitiespremise"),
            (F.col("c_custkey") + 100000).alias("utilitiesinstallation"),
            sewer.alias("division"),
        )

    def bills(self, registers: bool = False, apart: bool = False) -> DataFrame:
        """Orders as billing readings: finished orders carry the billing reason.

        With ``registers`` every tenth customer's bills are on two registers; ``apart`` halves those of
        the second one.
        """
        key = F.col("o_custkey")
        reason = F.when(F.col("o_orderstatus") == "F", F.lit("01")).otherwise(F.lit("02"))
        unit = self.table("customer").select(
            F.col("c_custkey").alias("o_custkey"), F.col("c_mktsegment").alias("meter_reading_unit")
        )
        two = F.when(key % 10 == 0, F.array(F.lit("001"), F.lit("002")))
        each = F.coalesce(two, F.array(F.lit("001"))) if registers else F.array(F.lit("001"))
        return (
            self.table("orders")
            .join(unit, "o_custkey")
            .select(
                key.cast("string").alias("meter_id"),
                (key + 100000).cast("string").alias("installation"),
                F.explode(each).alias("register"),
                F.col("o_orderdate").alias("meter_reading_time"),
                reason.alias("meter_reading_reason"),
                F.col("o_totalprice").alias("consumption_gl"),
                "meter_reading_unit",
            )
            .withColumn(
                "consumption_gl",
                F.when(F.lit(apart) & (F.col("register") == "002"), F.col("consumption_gl") / 2).otherwise(
                    F.col("consumption_gl")
                ),
            )
        )

    def meters(self, registers: bool = False) -> DataFrame:
        """Meters of the customers; with ``registers`` every tenth has a second register.

        One nation in five has endpoint type 18, which is not in the AMI group, and the others 20.
        """
        key = F.col("c_custkey")
        kind = F.when(F.col("c_nationkey") % 5 == 0, F.lit("18")).otherwise(F.lit("20"))
        source = self._registers() if registers else self.table("customer").withColumn(
            "register", F.lit("001")
        )
        return source.select(
            key.cast("string").alias("meter_id"),
            (key + 100000).cast("string").alias("installation"),
            "register",
            F.lit("Yes").alias("isactive"),
            kind.alias("end_point_type_1"),
            key.cast("string").alias("business_partner_number"),
            (key + 500000).cast("string").alias("connection_contract_number"),
        )

    def endpoint_types(self) -> DataFrame:
        """Endpoint types 18 to 22 from the regions; all but type 18 are in the AMI group."""
        kind = (F.col("r_regionkey") + 18).cast("string")
        group = F.when(kind == "18", F.lit("AMR")).otherwise(F.lit("AMI"))
        return self.table("region").select(kind.alias("id"), group.alias("endpoint_group"))

    def connection_contracts(self) -> DataFrame:
        key = F.col("c_custkey")
        return self.table("customer").select(
            key.cast("string").alias("business_partner_number"),
            (key + 500000).cast("string").alias("connection_contract_number"),
            F.concat(F.lit("P"), key).alias("premise_id"),
        )

    def order_schedule(self) -> DataFrame:
        """Order dates as scheduled reads of a unit per customer."""
        return self.table("orders").select(
            F.col("o_custkey").cast("string").alias("meterreadingunit"),
            F.col("o_orderdate").cast("date").alias("scheduledmeterreadingdate"),
        )

    def _shipments(self) -> DataFrame:
        lines = self.table("lineitem").select(
            F.col("l_orderkey").alias("o_orderkey"), "l_shipdate", "l_extendedprice"
        )
        return lines.join(self.table("orders").select("o_orderkey", "o_custkey"), "o_orderkey")

    def segment_schedule(self) -> DataFrame:
        """Ship dates as scheduled reads of a unit per market segment.

        The orders get their segment first, so that the lines, the largest table, are shuffled only once.
        """
        unit = self.table("customer").select(F.col("c_custkey").alias("o_custkey"), "c_mktsegment")
        orders = self.table("orders").select("o_orderkey", "o_custkey").join(unit, "o_custkey")
        lines = self.table("lineitem").select(F.col("l_orderkey").alias("o_orderkey"), "l_shipdate")
        return lines.join(orders.select("o_orderkey", "c_mktsegment"), "o_orderkey").select(
            F.col("c_mktsegment").alias("meterreadingunit"),
            F.col("l_shipdate").cast("date").alias("scheduledmeterreadingdate"),
        )

    def usage(self, registers: bool = False) -> DataFrame:
        """Shipped lines as daily rows of the reads mart; with ``registers``, of odd orders on the second one."""
        key = F.col("o_custkey")
        second = F.lit(registers) & (key % 10 == 0) & (F.col("o_orderkey") % 2 == 1)
        return self._shipments().select(
            F.lit("DAILY").alias("read_interval_type"),
            F.lpad(key.cast("string"), 10, "0").alias("equipmentnumber"),
            F.when(second, F.lit("002")).otherwise(F.lit("001")).alias("register"),
            key.cast("string").alias("businesspartnernumber"),
            (key + 500000).cast("string").alias("contractaccount"),
            F.col("l_shipdate").alias("reading_datetime"),
            F.col("l_extendedprice").alias("consumption"),
        )

    def event_reads(self) -> DataFrame:
        """Events as hourly rows of the reads mart, the value being the consumption."""
        key = F.col("user_id")
        return self.table("events").select(
            F.lit("HOURLY").alias("read_interval_type"),
            key.cast("string").alias("businesspartnernumber"),
            (key + 500000).cast("string").alias("contractaccount"),
            F.col("ts").alias("reading_datetime"),
            F.col("value").alias("consumption"),
        )
