"""Consumption between cumulative register readings, and the last reading of each day."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from meterlake.functions import amount, day_key, epoch, money
from meterlake.operators.hotkeys import first_in_slot, newest_first, previous, slotted, without_slots

COPIES = "_copies"


def max_ts_per_day(df: DataFrame, keys: Sequence[str], ts: str) -> DataFrame:
    """Time of the last reading per key and calendar day."""
    by_day = df.groupBy(*keys, day_key(F.col(ts)).alias("reading_day"))
    return by_day.agg(F.max(ts).alias(ts))


def last_per_day(
    df: DataFrame,
    keys: Sequence[str],
    ts: str,
    *,
    prefer: Sequence[str] = (),
    keep_ties: bool = False,
) -> DataFrame:
    """Whole row of the last reading per key and calendar day.

    Readings at the same last moment: the one greatest in the ``prefer`` columns, or, with
    ``keep_ties``, all of them.
    """
    order = [F.desc(ts)] if keep_ties else [F.desc(ts), *[F.desc_nulls_last(c) for c in prefer]]
    by_day = df.withColumn("_day", day_key(F.col(ts)))
    return newest_first(by_day, [*keys, "_day"], order, ties=keep_ties).drop("_day")


def dedupe(df: DataFrame, keys: Sequence[str], prefer: Sequence[str] = ()) -> DataFrame:
    """One row per ``keys``, the greatest in ``prefer``; distinct rows when no keys are given."""
    if not keys:
        return df.distinct()
    rest = [c for c in df.columns if c not in keys and c not in prefer]
    return newest_first(df, keys, [F.desc_nulls_last(c) for c in [*prefer, *rest]])


def with_copies(df: DataFrame) -> DataFrame:
    """Distinct rows with the number of their copies."""
    return df.groupBy(*df.columns).agg(F.count(F.lit(1)).alias(COPIES))


def delta_columns(value: str, ts: str) -> dict:
    """``consumption`` and ``read_interval`` from a row and the ``_prev_`` columns before it."""
    gap = epoch(F.col(ts)) - epoch(F.col("_prev_ts"))
    return {
        "consumption": money(amount(F.col(value)) - amount(F.col("_prev_value"))),
        "read_interval": gap.cast("int"),
    }


def repeated_as_zero(df: DataFrame) -> DataFrame:
    """Give each row with copies one further row with delta 0, and drop the copy count.

    It is what a ``lag`` over the copies followed by DISTINCT leaves of them.
    """
    again = F.when(F.col(COPIES) > 1, F.array(F.lit(False), F.lit(True)))
    rows = df.withColumn("_again", F.explode(F.coalesce(again, F.array(F.lit(False)))))
    zero = {
        "consumption": F.when(F.col("_again"), F.lit(0)).otherwise(F.col("consumption")),
        "read_interval": F.when(F.col("_again"), F.lit(0)).otherwise(F.col("read_interval")),
    }
    zero = {name: col.cast(df.schema[name].dataType) for name, col in zero.items()}
    return rows.withColumns(zero).drop("_again", COPIES).distinct()


def interval_delta(
    df: DataFrame,
    keys: Sequence[str],
    ts: str,
    value: str,
    *,
    prefer: Sequence[str] = (),
    parity: bool = False,
) -> DataFrame:
    """Add ``consumption`` (rounded change of the register) and ``read_interval`` (seconds).

    Repeated readings of one moment are reduced to one, the greatest in ``prefer`` and then in
    ``value``. With ``parity`` they all stay, and repeats show up as rows with delta 0.

    One shuffle by key and day serves both the de-duplication and the difference; the first reading of
    a day meets the last one before it through a table with one row per key and day. Under parity the
    copies are counted before the shuffle.
    """
    keys = list(keys)
    if parity:
        rest = [c for c in df.columns if c not in (*keys, ts, value)]
        order = [ts, value, *rest]
        rows = slotted(with_copies(df), keys, ts)
    else:
        order = [ts]
        rows = slotted(df, keys, ts)
        newest = [*prefer, value]
        more = [c for c in df.columns if c not in (*keys, ts, *newest)]
        rows = first_in_slot(rows, keys, [ts], [F.desc_nulls_last(c) for c in [*newest, *more]])
    rows = previous(rows, keys, order, {"_prev_ts": ts, "_prev_value": value})
    rows = rows.withColumns(delta_columns(value, ts)).drop("_prev_ts", "_prev_value")
    rows = without_slots(rows, df, keys)
    return repeated_as_zero(rows) if parity else rows


def day_delta(df: DataFrame, keys: Sequence[str], ts: str, value: str) -> DataFrame:
    """The same columns over one row per key and day: a key has no more rows than days."""
    w = Window.partitionBy(*keys).orderBy(ts)
    rows = df.withColumns({"_prev_ts": F.lag(ts, 1).over(w), "_prev_value": F.lag(value, 1).over(w)})
    return rows.withColumns(delta_columns(value, ts)).drop("_prev_ts", "_prev_value")
