"""The last reading of every register before a moment: the predecessor of the first reading of a run.

A run reads only the days of its window. A border table has one row for each key, the last reading before
the window's first midnight; it joins the readings as one more reading of its key, so the difference and the
gap of the first reading of the window are the same as in a run over all history.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meterlake.functions import ntz

BORDER = "_border"


def _latest(rows: DataFrame, keys: Sequence[str], ts: str, value: str, newest: str) -> DataFrame:
    last = F.max_by(F.struct(ts, value, newest), F.struct(ts, newest, value)).alias("_last")
    return rows.groupBy(*keys).agg(last).select(*keys, "_last.*")


def last_before(
    rows: DataFrame, keys: Sequence[str], ts: str, value: str, newest: str, before: dt.date
) -> DataFrame:
    """The last reading of each key before midnight of ``before``; of one moment the newest, then the greatest.

    Keys may be missing: readings without a meter or port are a key of their own. Reduced in every task
    before the shuffle, to one row for each key.
    """
    earlier = rows.where(F.col(ts) < ntz(before)).select(*keys, ts, value, newest)
    return _latest(earlier, keys, ts, value, newest)


def merged(old: DataFrame, new: DataFrame, keys: Sequence[str], ts: str, value: str, newest: str) -> DataFrame:
    """The later of two border rows of each key."""
    return _latest(old.unionByName(new), keys, ts, value, newest)


def with_borders(rows: DataFrame, borders: DataFrame) -> DataFrame:
    """The readings and, marked, their border rows."""
    return rows.withColumn(BORDER, F.lit(False)).unionByName(
        borders.withColumn(BORDER, F.lit(True)), allowMissingColumns=True
    )


def without_borders(rows: DataFrame) -> DataFrame:
    return rows.where(~F.col(BORDER)).drop(BORDER)
