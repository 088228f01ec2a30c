"""Scalar and aggregate expressions.

Amounts are DECIMAL so that sums do not depend on the order in which tasks finish: a retried
stage gives the same alert as the first attempt. ``round`` on a double is never used, as its result
at a half differs between engines.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType

#: Register values, interval and billing consumption. Results are rounded once, at the end.
AMOUNT = DecimalType(28, 10)
#: Ratios and limits from doubles, before they are rounded. Eight digits take away the noise of a division.
EXACT = DecimalType(38, 8)
#: Rounded results.
MONEY = DecimalType(18, 2)
#: The day of a reading, a partition of the reads mart.
DATE = "reading_date"
#: An amount is split at 100 into two whole numbers: hundreds, and the rest in steps of 1e-10.
SPLIT_AT, STEPS, LIMB = 100, 10**10, 10**12
WHOLE = DecimalType(38, 0)


def amount(col: Column) -> Column:
    return col.cast(AMOUNT)


def round2(col: Column) -> Column:
    """Half-up rounding of a double to two digits, in decimal arithmetic."""
    return F.round(col.cast(EXACT), 2).cast(MONEY)


def money(col: Column) -> Column:
    """Half-up rounding of a decimal to two digits, once and from all its digits."""
    return F.round(col, 2).cast(MONEY)


def ntz(value: dt.date | dt.datetime) -> Column:
    """Timestamp literal without zone. Folds to a constant, so comparisons reach the scan."""
    if not isinstance(value, dt.datetime):
        value = dt.datetime.combine(value, dt.time())
    return F.lit(value.isoformat(sep=" ")).cast("timestamp_ntz")


def day_offset(as_of: dt.date, days: int) -> Column:
    """Midnight at the start of the day ``days`` after ``as_of``."""
    return ntz(as_of + dt.timedelta(days=days))


def epoch(ts: Column) -> Column:
    return F.unix_timestamp(ts)


def day_key(ts: Column) -> Column:
    """Calendar day. The year is always part of it."""
    return F.to_date(ts)


def to_id(col: Column) -> Column:
    return col.cast("string")


def ltrim0(col: Column) -> Column:
    """Strip leading zeros: ``000120`` to ``120``, ``0`` to the empty string."""
    return F.ltrim(col.cast("string"), F.lit("0"))


def day_part(later: Column, earlier: Column) -> Column:
    """Whole days between two timestamps, truncated toward zero."""
    span = later.cast("timestamp_ntz") - earlier.cast("timestamp_ntz")
    return F.extract(F.lit("DAY"), span).cast("int")


def days_span(lo: Column, hi: Column) -> Column:
    return day_part(hi, lo)


def per_day(total: Column, days: Column) -> Column:
    """Daily rate as a double; zero when all readings fall on one day."""
    return F.when(days > 0, total.cast("double") / days).otherwise(F.lit(0.0))


def limbs(value: Column) -> tuple[Column, Column]:
    """An AMOUNT as two whole numbers: ``value = 100 * high + low / 1e10``, with ``0 <= low < 1e12``.

    Their products and the sums of these are exact, where a product of two AMOUNTs has more digits than a decimal.
    """
    below = F.floor(amount(value), F.lit(-2))
    high = (below / F.lit(SPLIT_AT)).cast(DecimalType(17, 0))
    low = ((amount(value) - below).cast(DecimalType(13, 10)) * F.lit(STEPS)).cast(DecimalType(13, 0))
    return high, low


#: Names of the sums that mean and deviation come from, and how they are merged: by adding them up.
MOMENTS = ("_n", "_high", "_low", "_high_high", "_high_low", "_low_low")


def moments(value: Column) -> list[Column]:
    """Count, sums and sums of products of the limbs. They merge without loss, in any order."""
    high, low = limbs(value)
    sums = (high, low, high * high, high * low, low * low)
    return [F.count(value).alias("_n"), *(F.sum(s).cast(WHOLE).alias(n) for s, n in zip(sums, MOMENTS[1:], strict=True))]


def merged_moments() -> list[Column]:
    return [F.sum("_n").alias("_n"), *(F.sum(n).cast(WHOLE).alias(n) for n in MOMENTS[1:])]


def total_of_moments() -> Column:
    """The sum of the values, exact."""
    high = F.col("_high").cast(DecimalType(22, 0)) * F.lit(SPLIT_AT)
    low = F.col("_low").cast(DecimalType(28, 0)) / F.lit(STEPS)
    return (high + low.cast(DecimalType(28, 10))).cast(DecimalType(38, 10))


def _carry(value: Column) -> tuple[Column, Column]:
    """(quotient, remainder) of a whole number by LIMB, the remainder not negative."""
    below = F.floor(value, F.lit(-12)).cast(WHOLE)
    return (below / F.lit(LIMB)).cast(WHOLE), (value - below).cast(WHOLE)


def deviation_of_moments() -> Column:
    """Population standard deviation: n * sum of squares less the squared sum, exact, then one root.

    The difference is taken limb by limb in whole numbers and carried, so that nothing is lost where the
    values are nearly equal. Enough for ten million bills of one account below 1e12 each.
    """
    n = F.col("_n").cast(DecimalType(18, 0))

    def spread(product: str, a: str, b: str) -> Column:
        return ((n * F.col(product)).cast(WHOLE) - (F.col(a) * F.col(b)).cast(WHOLE)).cast(WHOLE)

    carry, lowest = _carry(spread("_low_low", "_low", "_low"))
    middle = (F.lit(2).cast(DecimalType(2, 0)) * spread("_high_low", "_high", "_low")).cast(WHOLE)
    carry, middle = _carry((middle + carry).cast(WHOLE))
    highest = (spread("_high_high", "_high", "_high") + carry).cast(WHOLE)
    whole = highest.cast("double") * float(LIMB) ** 2 + middle.cast("double") * float(LIMB) + lowest.cast("double")
    return F.sqrt(whole) / F.lit(float(STEPS)) / F.nullif(F.col("_n"), F.lit(0))


def limit(mean: Column, deviation: Column, sigma: float) -> Column:
    """Mean plus ``sigma`` population standard deviations, rounded."""
    return round2(mean + F.lit(float(sigma)) * deviation)


def event_type(url: Column) -> Column:
    """Text after the last slash; empty when there is none."""
    return F.when(F.contains(url, F.lit("/")), F.substring_index(url, "/", -1)).otherwise(F.lit(""))


def payload(business_partner: Column, contract_account: Column, ts: Column) -> Column:
    """Alert message as JSON. ``ts`` has no zone and is read as UTC; fractions of seconds drop."""
    when = F.concat(F.date_format(ts.cast("timestamp_ntz"), "yyyy-MM-dd'T'HH:mm:ss"), F.lit("Z"))
    return F.to_json(
        F.struct(
            business_partner.alias("businessPartnerNumber"),
            contract_account.alias("contractAccountNumber"),
            when.alias("alertDateTime"),
        )
    )
