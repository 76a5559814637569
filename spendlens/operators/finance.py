"""Reward liability, merchant settlement and reconciliation."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.exprs import case, cents, derive, prefixed_hash, rate, round_money
from ..functions.rules import funding_split
from .cleaning import first_per_key
from .matching import small_side

# Tolerance and reason texts of a reconciliation row.
TOLERANCE = "0.01"
TIES_OUT = "Transaction amount ties to settlement and platform fee"
NO_SETTLEMENT = "Missing merchant settlement record"
OFF_TOLERANCE = "Settlement delta exceeds tolerance"


def reward_liability(redemptions: DataFrame, owner: Column | str = "merchant") -> DataFrame:
    """One accrued liability per redemption, split between merchant and platform."""
    owner_col = F.lit(owner) if isinstance(owner, str) else owner
    rows = redemptions.withColumns({"liability_owner": owner_col, "reward_amount": F.col("calculated_reward_amount")})
    return derive(rows, funding_split()).select(
        prefixed_hash("rew_", ["redemption_id"]).alias("reward_liability_id"),
        "redemption_id", "transaction_id", "activation_id", "tokenized_cardmember_id", "offer_id", "campaign_id",
        "merchant_id",
        F.col("redemption_date").alias("liability_date"),
        F.col("redemption_timestamp").alias("liability_timestamp"),
        "reward_amount", "liability_owner", "merchant_funded_amount", "platform_funded_amount",
        F.lit("accrued").alias("liability_status"),
    )


SETTLEMENT = {
    "reward_amount": "coalesce(__reward, 0D)",
    "liability_owner": "coalesce(__owner, 'none')",
    "merchant_funded_amount": "coalesce(__merchant_funded, 0D)",
    "platform_funded_amount": "coalesce(__platform_funded, 0D)",
    "platform_fee_amount": round_money(f"{cents('gross_transaction_amount')} * {rate('platform_fee_rate')}"),
    "merchant_settlement_amount": round_money(
        f"{cents('gross_transaction_amount')} - {cents('platform_fee_amount')}"
    ),
    "merchant_net_after_reward": round_money(
        f"{cents('merchant_settlement_amount')} - {cents('merchant_funded_amount')}"
    ),
}
SETTLEMENT_COLUMNS = (
    "settlement_id", "transaction_id", "redemption_id", "reward_liability_id", "merchant_id", "settlement_date",
    "gross_transaction_amount", "platform_fee_rate", "platform_fee_amount", "reward_amount", "liability_owner",
    "merchant_funded_amount", "platform_funded_amount", "merchant_settlement_amount", "merchant_net_after_reward",
    "settlement_status",
)


def settlements(tx: DataFrame, merchants: DataFrame, liability: DataFrame) -> DataFrame:
    """What each known merchant is paid per transaction, after fee and merchant-funded reward.

    Transactions of unknown merchants are dropped. Where a transaction has several liabilities the
    latest one counts; choosing it partitions by transaction, which the join then reuses.
    """
    latest = first_per_key(
        liability.select(
            "transaction_id", "redemption_id", "reward_liability_id", "liability_timestamp",
            F.col("reward_amount").alias("__reward"),
            F.col("liability_owner").alias("__owner"),
            F.col("merchant_funded_amount").alias("__merchant_funded"),
            F.col("platform_funded_amount").alias("__platform_funded"),
        ),
        ["transaction_id"],
        [F.desc("liability_timestamp"), F.desc("reward_liability_id")],
    ).drop("liability_timestamp")
    fees = first_per_key(merchants.select("merchant_id", "platform_fee_rate"), ["merchant_id"])
    gross = tx.select(
        "transaction_id", "merchant_id", F.col("transaction_date").alias("settlement_date"),
        F.col("transaction_amount").alias("gross_transaction_amount"),
    )
    joined = gross.join(small_side(fees), "merchant_id").join(latest, "transaction_id", "left")
    return (
        derive(joined, SETTLEMENT)
        .withColumns(
            {
                "settlement_id": prefixed_hash("settle_", ["transaction_id"]),
                "settlement_status": F.lit("pending"),
            }
        )
        .select(*SETTLEMENT_COLUMNS)
    )


_DELTA = (
    f"{cents('transaction_amount')} - {cents('merchant_settlement_amount')} - {cents('platform_fee_amount')}"
)
RECONCILIATION = {
    "merchant_settlement_amount": "coalesce(__settled, 0D)",
    "platform_fee_amount": "coalesce(__fee, 0D)",
    "reward_amount": "coalesce(__reward, 0D)",
    "merchant_funded_amount": "coalesce(__merchant_funded, 0D)",
    "platform_funded_amount": "coalesce(__platform_funded, 0D)",
    "settlement_delta": round_money(_DELTA),
    "reconciliation_status": case(
        [("__found IS NULL", "mismatched"), (f"abs({_DELTA}) <= {TOLERANCE}", "matched")], "mismatched"
    ),
    "reconciliation_reason": case(
        [("__found IS NULL", NO_SETTLEMENT), (f"abs({_DELTA}) <= {TOLERANCE}", TIES_OUT)], OFF_TOLERANCE
    ),
}
RECONCILIATION_COLUMNS = (
    "reconciliation_id", "transaction_id", "merchant_id", "reconciliation_date", "transaction_amount",
    "merchant_settlement_amount", "platform_fee_amount", "reward_amount", "merchant_funded_amount",
    "platform_funded_amount", "settlement_delta", "reconciliation_status", "reconciliation_reason",
)


def reconciliation(tx: DataFrame, settled: DataFrame) -> DataFrame:
    """Every transaction against its settlement: does amount = settlement + fee hold?"""
    found = first_per_key(
        settled.select(
            "transaction_id", "settlement_id",
            F.lit(True).alias("__found"),
            F.col("merchant_settlement_amount").alias("__settled"),
            F.col("platform_fee_amount").alias("__fee"),
            F.col("reward_amount").alias("__reward"),
            F.col("merchant_funded_amount").alias("__merchant_funded"),
            F.col("platform_funded_amount").alias("__platform_funded"),
        ),
        ["transaction_id"],
        [F.desc("settlement_id")],
    ).drop("settlement_id")
    base = tx.select(
        "transaction_id", "merchant_id", F.col("transaction_date").alias("reconciliation_date"), "transaction_amount"
    )
    joined = base.join(found, "transaction_id", "left")
    return (
        derive(joined, RECONCILIATION)
        .withColumn("reconciliation_id", prefixed_hash("recon_", ["transaction_id"]))
        .select(*RECONCILIATION_COLUMNS)
    )
