"""Order-dependent windows that stay spread when one key holds much of the data.

A plain window sorts all rows of a key in one task. Here every key is cut into days, in one fixed plan
for all keys: rows are shuffled once by key and day, the window runs inside the day, and what crosses
midnight is carried over from a table with one row per key and day, made from the same shuffle.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from meterlake.functions import epoch

SLOT = "_slot"
SLOT_SECONDS = 86_400


def _parts(keys: Sequence[str]) -> list[str]:
    """The columns that stand for ``keys`` in a slotted table; a missing key is a key of its own."""
    return [f"_{kind}_{k}" for k in keys for kind in ("key", "none")]


def slotted(df: DataFrame, keys: Sequence[str], ts: str) -> DataFrame:
    """``df`` with its slot, shuffled by key and slot. Parts stand for the keys; ``without_slots`` undoes it."""
    parts = {}
    for k in keys:
        parts[f"_key_{k}"] = F.coalesce(F.col(k).cast("string"), F.lit(""))
        parts[f"_none_{k}"] = F.isnull(F.col(k))
    slot = F.floor(epoch(F.col(ts)) / SLOT_SECONDS).cast("bigint")
    slot = F.coalesce(slot, F.lit(-(1 << 40)).cast("bigint"))
    return df.withColumns({**parts, SLOT: slot}).drop(*keys).repartition(*_parts(keys), SLOT)


def without_slots(df: DataFrame, like: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The keys in place of their parts, with the types they have in ``like``."""
    back = {
        k: F.when(~F.col(f"_none_{k}"), F.col(f"_key_{k}")).cast(like.schema[k].dataType) for k in keys
    }
    return df.withColumns(back).drop(*_parts(keys), SLOT)


def newest_first(
    df: DataFrame, keys: Sequence[str], order: Sequence[Column], ties: bool = False
) -> DataFrame:
    """First row of each key in ``order``; with ``ties`` all rows that share the first place.

    Spark keeps only the leading rows of each key in every task before the shuffle, so a key with
    many copies does not reach one task whole.
    """
    place = F.rank() if ties else F.row_number()
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_place", place.over(w)).where(F.col("_place") == 1).drop("_place")


def first_in_slot(df: DataFrame, keys: Sequence[str], more: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """``newest_first`` by key and ``more`` of a slotted table, without another shuffle."""
    return newest_first(df, [*_parts(keys), SLOT, *more], order)


def _carry(rows: DataFrame, borders: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Join the table of slot borders (one row per slot, column ``_carried``) on the slotted rows."""
    return rows.join(borders, [*_parts(keys), SLOT], "left")


def previous(
    rows: DataFrame, keys: Sequence[str], order: Sequence[str], values: dict[str, str]
) -> DataFrame:
    """Add, for each ``values`` entry new→old, the old column's value in the row before, in a slotted table."""
    parts = _parts(keys)
    in_slot = Window.partitionBy(*parts, SLOT).orderBy(*order)
    across = Window.partitionBy(*parts).orderBy(SLOT)
    # The order names every column, so that both uses of the rows read the same columns and share a shuffle.
    whole = [*order, *[c for c in rows.columns if c not in (*order, *parts, SLOT)]]
    last = F.max_by(F.struct(*values.values()), F.struct(*whole)).alias("_last")
    borders = rows.groupBy(*parts, SLOT).agg(last)
    borders = borders.select(*parts, SLOT, F.lag("_last", 1).over(across).alias("_carried"))
    inside = {new: F.lag(old, 1).over(in_slot) for new, old in values.items()}
    joined = _carry(rows.withColumns({**inside, "_first": F.row_number().over(in_slot) == 1}), borders, keys)
    chosen = {
        new: F.when(F.col("_first"), F.col("_carried")[old]).otherwise(F.col(new)) for new, old in values.items()
    }
    return joined.withColumns(chosen).drop("_first", "_carried")


def running_total(rows: DataFrame, keys: Sequence[str], order: Sequence[str], value: str, out: str) -> DataFrame:
    """Add ``out``, the sum of ``value`` up to and including each row, to a slotted table."""
    parts = _parts(keys)
    in_slot = Window.partitionBy(*parts, SLOT).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    before = Window.partitionBy(*parts).orderBy(SLOT).rowsBetween(Window.unboundedPreceding, -1)
    totals = rows.groupBy(*parts, SLOT).agg(F.sum(value).alias("_total"))
    borders = totals.select(*parts, SLOT, F.sum("_total").over(before).alias("_carried"))
    inside = rows.withColumn(out, F.sum(value).over(in_slot))
    start = F.coalesce("_carried", F.lit(0))
    kind = inside.schema[out].dataType
    return _carry(inside, borders, keys).withColumn(out, (F.col(out) + start).cast(kind)).drop("_carried")
