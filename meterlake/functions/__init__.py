"""Column expressions shared by the operators. All are built-in Spark functions."""

from meterlake.functions.columns import (
    MOMENTS,
    total_of_moments,
    moments,
    merged_moments,
    deviation_of_moments,
    DATE,
    AMOUNT,
    EXACT,
    MONEY,
    amount,
    ntz,
    day_key,
    day_offset,
    day_part,
    days_span,
    epoch,
    event_type,
    limit,
    ltrim0,
    money,
    payload,
    per_day,
    round2,
    to_id,
)

__all__ = [
    "MOMENTS",
    "total_of_moments",
    "moments",
    "merged_moments",
    "deviation_of_moments",
    "DATE",
    "AMOUNT",
    "EXACT",
    "MONEY",
    "amount",
    "ntz",
    "day_key",
    "day_offset",
    "day_part",
    "days_span",
    "epoch",
    "event_type",
    "limit",
    "ltrim0",
    "money",
    "payload",
    "per_day",
    "round2",
    "to_id",
]
