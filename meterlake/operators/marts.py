"""Shaping results into mart rows."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from meterlake.functions import to_id

# The columns of the reads mart, and the result columns stored under another name.
READS_MAPPING = {
    "meter_id": "headend_meter_id",
    "utilitiescontract": "contract",
    "regionalstructuregrouping": "district",
    "devicelocation": "functionallocation",
}
READ_COLUMNS = (
    "read_interval_type",
    "headend_meter_id",
    "functionallocation",
    "reading_datetime",
    "timezone",
    "reading_value",
    "unit_of_measure",
    "consumption",
    "read_interval",
    "equipmentnumber",
    "installation",
    "register",
    "logicalregisternumber",
    "businesspartnernumber",
    "contractaccount",
    "contract",
    "district",
)
#: The reads mart has one schema, whichever feed a row is from. All other columns are text.
READS_TYPES = {
    "reading_datetime": "timestamp_ntz",
    "reading_value": "decimal(28,10)",
    "consumption": "decimal(18,2)",
    "read_interval": "int",
}
NUMBERS = ("reading_value", "consumption", "read_interval")
LONG_IDS = ("installation", "contractaccount", "contract")


def select_mart(df: DataFrame, mapping: Mapping[str, str], *columns: str) -> DataFrame:
    """Rename by name, never by position, and keep ``columns`` (all when none are given)."""
    renamed = df.withColumnsRenamed({k: v for k, v in mapping.items() if k in df.columns})
    return renamed.select(*columns) if columns else renamed


def to_mart_row(df: DataFrame, parity: bool = False) -> DataFrame:
    """Mart types: identifiers as text.

    With ``parity`` a missing number becomes 0, and the identifiers that were read as whole numbers
    lose leading zeros and turn a missing value into ``"0"``.
    """
    out = {}
    for name in df.columns:
        if name in LONG_IDS:
            number = F.coalesce(F.col(name).cast("bigint"), F.lit(0).cast("bigint"))
            out[name] = to_id(number) if parity else to_id(F.col(name))
        elif parity and name in NUMBERS:
            out[name] = F.coalesce(F.col(name), F.lit(0).cast(df.schema[name].dataType))
    return df.withColumns(out) if out else df


def reads_row(df: DataFrame, parity: bool = False) -> DataFrame:
    """``to_mart_row`` in the schema of the reads mart: 18 columns, a premise that the feed lacks being NULL."""
    rows = to_mart_row(df, parity)
    columns = (*READ_COLUMNS, "utilities_premise")
    value = {c: F.col(c) if c in rows.columns else F.lit(None) for c in columns}
    return rows.select(*[value[c].cast(READS_TYPES.get(c, "string")).alias(c) for c in columns])


def combined_reads(customer_reads: DataFrame, account_reads: DataFrame) -> DataFrame:
    """Rows of both feeds; a column that one feed lacks is NULL there."""
    return customer_reads.unionByName(account_reads, allowMissingColumns=True)


def presort(df: DataFrame, *cols: str) -> DataFrame:
    """Total order, for a result that is read in order. Tables are sorted per file instead."""
    return df.orderBy(*cols)


def observe_rows(df: DataFrame, name: str) -> tuple[DataFrame, Observation]:
    """Count rows while ``df`` is written; read ``observation.get["rows"]`` afterwards.

    It belongs right before the write: what stands behind it may run it more than once (a range partitioning
    takes a sample first). The sinks count what they write in this way.
    """
    seen = Observation(name)
    return df.observe(seen, F.count(F.lit(1)).alias("rows")), seen
