"""Master data that holds at a date, and its joins.

The master tables are joined with each other first. The readings then meet one table in one join,
keyed by location or premise, instead of three.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from meterlake.functions import to_id
from meterlake.operators.horizon import where_code

# Column names of the master data and the code of the sewer division.
DEVICE = ("devicevaliditystartdate", "devicevalidityenddate")
REGISTER = ("registervaliditystartdate", "registervalidityenddate")
OCCUPANCY = ("utilitiesmoveindate", "utilitiesmoveoutdate")

SEWER = "SW"
DEVICE_COLUMNS = ("equipmentnumber", "installation", "register", "logicalregisternumber")
CONTRACT_COLUMNS = (
    "businesspartnernumber",
    "contractaccount",
    "utilitiescontract",
    "regionalstructuregrouping",
)


def valid_at(df: DataFrame, as_of: dt.date, *pairs: tuple[str, str]) -> DataFrame:
    """Rows whose every (start, end) pair includes ``as_of``. An open (NULL) end does not hold."""
    day = F.lit(as_of)
    holds = F.lit(True)
    for start, end in pairs:
        holds = holds & (F.col(start) <= day) & (F.col(end) >= day)
    return df.where(holds)


def known_locations(location: DataFrame) -> DataFrame:
    return location.select(to_id(F.col("functionallocation")).alias("functionallocation")).distinct()


def enrich_location(df: DataFrame, location: DataFrame) -> DataFrame:
    """Keep rows whose functional location is in the location master."""
    return df.join(known_locations(location), "functionallocation")


def enrich_device(df: DataFrame, device: DataFrame, as_of: dt.date) -> DataFrame:
    """Add the registers of the devices installed at the functional location."""
    installed = valid_at(device, as_of, DEVICE).select(
        to_id(F.col("devicelocation")).alias("functionallocation"), *DEVICE_COLUMNS
    )
    return df.join(installed.distinct(), "functionallocation")


def premise_registers(premise: DataFrame, device: DataFrame, as_of: dt.date) -> DataFrame:
    """Registers installed at each premise, sewer division aside."""
    served = where_code(premise, "division", SEWER, negate=True).select(
        to_id(F.col("utilitiespremise")).alias("utilities_premise"),
        F.col("utilitiesinstallation").alias("installation"),
    )
    installed = valid_at(device, as_of, DEVICE, REGISTER).select(*DEVICE_COLUMNS)
    return served.distinct().join(installed.distinct(), "installation")


def enrich_premise(
    df: DataFrame, premise: DataFrame, device: DataFrame, as_of: dt.date
) -> DataFrame:
    """Add the registers of the devices at the premise's installations."""
    return df.join(premise_registers(premise, device, as_of), "utilities_premise")


def enrich_contract(
    df: DataFrame, contract: DataFrame, as_of: dt.date, *, location: bool = False
) -> DataFrame:
    """Add the contract of the register; with ``location`` also the contract's device location."""
    extra = ("devicelocation",) if location else ()
    current = valid_at(contract, as_of, DEVICE, OCCUPANCY).select(
        "equipmentnumber", "register", *CONTRACT_COLUMNS, *extra
    )
    return df.join(current.distinct(), ["equipmentnumber", "register"])


def points_by_location(
    location: DataFrame, device: DataFrame, contract: DataFrame, as_of: dt.date
) -> DataFrame:
    """Device, register and contract in force per functional location. Rows are distinct."""
    registers = enrich_device(known_locations(location), device, as_of)
    return enrich_contract(registers, contract, as_of)


def points_by_premise(
    premise: DataFrame, device: DataFrame, contract: DataFrame, as_of: dt.date
) -> DataFrame:
    """Device, register and contract in force per premise. Rows are distinct."""
    registers = premise_registers(premise, device, as_of)
    return enrich_contract(registers, contract, as_of, location=True)


def overlapping(df: DataFrame, keys: Sequence[str], start: str, end: str) -> DataFrame:
    """Rows whose validity shares a day with that of another row of the same key, each once, all columns.

    Such rows multiply the readings that they are joined with. Days are inclusive at both ends; a row with a
    missing or reversed pair holds on no day, and rows with a missing key match nothing.

    A sweep over the ordered starts: a row overlaps an earlier one if the latest end before it is not before its
    start, a later one if the next start is not after its end. The sweep sees one row for each key and start day
    (reduced in every task), so a key with much of the data has no more than its days there, and the rows
    come back by key and start. No pairs are made.
    """
    named = df.select(F.struct(*df.columns).alias("_row"))
    parts = {f"_k{i}": F.col("_row")[k] for i, k in enumerate(keys)}
    days = {"_from": F.col("_row")[start].cast("date"), "_to": F.col("_row")[end].cast("date")}
    rows = named.withColumns({**parts, **days}).where(F.col("_from") <= F.col("_to"))
    starts = rows.groupBy(*parts, "_from").agg(F.max("_to").alias("_latest"), F.count(F.lit(1)).alias("_rows"))
    ordered = Window.partitionBy(*parts).orderBy("_from")
    before = F.max("_latest").over(ordered.rowsBetween(Window.unboundedPreceding, -1))
    swept = starts.select(
        *parts, "_from", "_rows", before.alias("_before"), F.lead("_from", 1).over(ordered).alias("_next")
    )
    overlaps = (F.col("_rows") > 1) | (F.col("_before") >= F.col("_from")) | (F.col("_next") <= F.col("_to"))
    return rows.join(swept, [*parts, "_from"]).where(overlaps).select("_row.*")


def ambiguous_points(device: DataFrame, contract: DataFrame, as_of: dt.date) -> DataFrame:
    """(table, key, register, matches) of the devices of a place and the contracts of a device that hold twice or
    more at ``as_of``: what makes one reading several rows."""
    devices = valid_at(device, as_of, DEVICE).groupBy(
        to_id(F.col("devicelocation")).alias("key"), "register"
    )
    contracts = valid_at(contract, as_of, DEVICE, OCCUPANCY).groupBy(
        to_id(F.col("equipmentnumber")).alias("key"), "register"
    )
    found = [
        group.agg(F.count(F.lit(1)).alias("matches")).where("matches > 1").select(F.lit(name).alias("table"), "*")
        for name, group in (("installed_devices", devices), ("contracts", contracts))
    ]
    return found[0].unionByName(found[1])
