"""Usage since the last billing reading, its projection, and the high-usage test."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meterlake.functions import DATE, EXACT, amount, day_part, ltrim0, money, round2, to_id
from meterlake.operators import billing
from meterlake.operators.horizon import after_event, having, where_code
from meterlake.params import Params

# Endpoint group and endpoint type of the meters in question.
AMI_GROUP = "AMI"
AMI_ENDPOINT = "20"


def daily_usage(reads: DataFrame, suffix: str = "") -> DataFrame:
    """Daily rows of the reads mart, with the account keys of the billing tables."""
    daily = where_code(reads, "read_interval_type", f"DAILY{suffix}")
    return daily.select(
        ltrim0(F.col("equipmentnumber")).alias("meter_id"),
        F.col("businesspartnernumber").alias("business_partner_number"),
        to_id(F.col("contractaccount")).alias("connection_contract_number"),
        "register",
        "equipmentnumber",
        "reading_datetime",
        amount(F.col("consumption")).alias("consumption"),
        *([DATE] if DATE in reads.columns else []),
    )


def reads_after_bill(reads: DataFrame, last_bill: DataFrame) -> DataFrame:
    """Reads later than the account meter's last billing reading.

    Of a mart with a folder for each day, only those from the earliest last reading on are read: a bound that
    Spark finds at run time, before it lists the files.
    """
    if DATE in reads.columns:
        least = last_bill.agg(F.min(F.to_date("last_read_time")).alias("least"))
        reads = reads.where(F.col(DATE) >= least.scalar()).drop(DATE)
    joined = reads.join(last_bill, list(billing.ACCOUNT))
    return after_event(joined, "reading_datetime", "last_read_time")


def usage_since(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Usage per ``keys``, which include the account meter and so fix its last billing reading."""
    return df.groupBy(*keys).agg(
        F.max("last_read_time").alias("last_read_time"),
        F.sum("consumption").alias("current_usage"),
        F.max("reading_datetime").alias("last_reading"),
    )


def with_stats(usage: DataFrame, stats: DataFrame, keys: Sequence[str]) -> DataFrame:
    return usage.join(stats, list(keys))


def with_premise(df: DataFrame, contracts: DataFrame) -> DataFrame:
    """Add the premise of the connection contract."""
    premises = contracts.select(
        "business_partner_number",
        to_id(F.col("connection_contract_number")).alias("connection_contract_number"),
        "premise_id",
    )
    return df.join(premises, ["business_partner_number", "connection_contract_number"])


def _account_usage(reads: DataFrame, last_bill: DataFrame, params: Params) -> DataFrame:
    """Usage since the last bill. By register, or with parity by raw equipment number."""
    own = "equipmentnumber" if params.parity else "register"
    daily = daily_usage(reads, params.interval_suffix)
    recent = reads_after_bill(daily, last_bill)
    return usage_since(recent, [*billing.ACCOUNT, own])


def _repeats(stats: DataFrame, keys: Sequence[str], parity: bool) -> DataFrame:
    """Distinct statistics and how often the historic join by account alone repeats each."""
    if not parity:
        return stats.select(*keys).distinct().withColumn("_repeats", F.lit(1))
    return stats.groupBy(*keys).agg(F.count(F.lit(1)).alias("_repeats"))


def _with_accounts_rate(usage: DataFrame, rates: DataFrame) -> DataFrame:
    """Usage with the rates of its register; a register without any bill has rate 0 up to the next reads of its account.

    One pass over the usage: a row without a rate of its own goes on with the dates of its account, which are one row.
    """
    match = [*billing.ACCOUNT, "register"]
    own = usage.join(rates.withColumn("_own", F.lit(True)), match, "left")
    coming = F.struct("next_read_date", "_repeats")
    dates = rates.groupBy(*billing.ACCOUNT).agg(F.collect_set(coming).alias("_dates"))
    chosen = F.when(F.col("_own"), F.array(coming)).otherwise(F.col("_dates"))
    rate = F.when(F.col("_own"), F.col("per_day_consumption")).otherwise(F.lit(0.0))
    rows = own.join(dates, list(billing.ACCOUNT)).withColumns({"_coming": F.explode(chosen), "per_day_consumption": rate})
    return rows.select(*usage.columns, "per_day_consumption", "_coming.*")


def high_usage(
    reads: DataFrame,
    bills: DataFrame,
    meters: DataFrame,
    next_read: DataFrame,
    params: Params,
) -> DataFrame:
    """Accounts whose usage since the last bill is above their own limit and above the floor.

    One row per account meter and register, whose statistics are over all its reading units that have a
    next read. With ``params.parity`` statistics are per next read, and registers are added up and meet
    the limit of each register, as a usage repeated for every register with that limit.
    """
    keys = ["meter_id", "installation", "register"]
    active = where_code(billing.active_meters(meters), "end_point_type_1", AMI_ENDPOINT)
    totals = billing.bill_totals(bills, keys, params.as_of_ts, params.months)
    base = billing.bills_with_meters(totals, active, keys)

    stats_keys = [*billing.ACCOUNT, "register", *(["next_read_date"] if params.parity else [])]
    stats = billing.billing_stats(billing.with_next_read(base, next_read), stats_keys, params.sigma)
    match = [*billing.ACCOUNT] if params.parity else [*billing.ACCOUNT, "register"]
    limits = _repeats(stats, [*match, "high_usage_limit"], params.parity)

    last = billing.last_bill(bills, active, keys)
    usage = with_stats(_account_usage(reads, last, params), limits, match)
    summed = F.col("current_usage") * F.col("_repeats")
    alerts = having(
        usage.withColumn("current_usage", summed),
        (F.col("high_usage_limit") < F.col("current_usage"))
        & (F.col("current_usage") > F.lit(params.min_usage).cast(EXACT)),
    )
    return alerts.select(
        F.col("business_partner_number").alias("businesspartnernumber"),
        F.col("connection_contract_number").alias("contractaccount"),
        F.col("meter_id").alias("equipmentnumber"),
        *([] if params.parity else ["register"]),
        "last_read_time",
        money(F.col("current_usage")).alias("current_usage"),
        "high_usage_limit",
    )


def project_consumption(
    reads: DataFrame,
    bills: DataFrame,
    meters: DataFrame,
    endpoint_types: DataFrame,
    next_read: DataFrame,
    contracts: DataFrame,
    params: Params,
) -> DataFrame:
    """Usage since the last bill, extended to the next read at the historic daily rate.

    One row per account meter, register and next read, each register at its own rate, one without bills of its
    own at rate 0; with ``params.parity`` per raw equipment number, repeated as the join by account alone
    does. A next read before the last reading gives negative days, and a projection below the usage.
    """
    active = billing.with_endpoint(billing.active_meters(meters), endpoint_types, AMI_GROUP)
    keys = ["meter_id"] if params.parity else ["meter_id", "register"]
    totals = billing.bill_totals(bills, keys, params.as_of_ts, params.months)
    base = billing.bills_with_meters(totals, active, keys)

    stats_keys = [*billing.ACCOUNT, "register", "next_read_date"]
    stats = billing.billing_stats(billing.with_next_read(base, next_read), stats_keys, params.sigma)
    match = [*billing.ACCOUNT] if params.parity else [*billing.ACCOUNT, "register"]
    rates = _repeats(stats, [*match, "per_day_consumption", "next_read_date"], params.parity)

    premises = contracts if params.parity else contracts.dropDuplicates(
        ["business_partner_number", "connection_contract_number", "premise_id"]
    )
    last = billing.last_bill(bills, active, ["meter_id"])
    usage = _account_usage(reads, last, params)
    usage = with_stats(usage, rates, match) if params.parity else _with_accounts_rate(usage, rates)
    rows = with_premise(usage, premises)
    group = [
        *billing.ACCOUNT,
        "equipmentnumber" if params.parity else "register",
        "premise_id",
        "last_read_time",
        "per_day_consumption",
        "next_read_date",
    ]
    summed = rows.groupBy(*group).agg(
        F.sum(F.col("current_usage") * F.col("_repeats")).alias("current_usage"),
        F.max("last_reading").alias("last_reading"),
    )
    days = day_part(F.col("next_read_date"), F.col("last_reading"))
    return summed.select(
        "business_partner_number",
        "premise_id",
        "connection_contract_number",
        "meter_id",
        *([] if params.parity else ["register"]),
        F.to_date("last_read_time").alias("service_period_start"),
        F.to_date("next_read_date").alias("service_period_end"),
        money(F.col("current_usage")).alias("curr_read_consumption"),
        F.to_date("last_reading").alias("curr_read_date"),
        round2(F.col("per_day_consumption")).alias("per_day_consumption"),
        days.alias("days_to_next_read"),
        (money(F.col("current_usage")) + round2(days * F.col("per_day_consumption")))
        .cast("decimal(18,2)")
        .alias("projected_consumption"),
    )
