"""Next scheduled read per meter-reading unit."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def next_read(schedule: DataFrame, as_of: dt.date) -> DataFrame:
    """Earliest scheduled date on or after ``as_of``."""
    coming = schedule.where(F.col("scheduledmeterreadingdate") >= F.lit(as_of))
    return coming.groupBy(F.col("meterreadingunit").alias("meter_reading_unit")).agg(
        F.min("scheduledmeterreadingdate").cast("date").alias("next_read_date")
    )
