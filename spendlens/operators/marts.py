"""Daily economics of merchants and offers, and the finance and funnel summaries."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.exprs import derive, money_mean, money_sum, present, ratio_pos, require
from ..sources.contracts import CELL, MERCHANT_DAILY_COLUMNS, MERCHANT_DAY, OFFER_DAILY_COLUMNS
from .cleaning import first_per_key
from .matching import small_side


#: Id columns that the caller knows to be unique: all of them, none, or those named.
Unique = bool | Sequence[str]


def known_unique(column: str, unique: Unique) -> bool:
    return unique if isinstance(unique, bool) else column in unique


def how_many(column: str, unique: Unique) -> Column:
    """Distinct count, or a plain count where the caller knows the ids to be unique.

    Several distinct counts in one aggregate multiply every row before the shuffle. Clean tables
    have unique ids, so the pipeline passes `unique=True` and keeps at most one distinct count.
    """
    return F.count(column) if known_unique(column, unique) else F.countDistinct(column)


def with_first_mark(df: DataFrame, by: Sequence[str], column: str, mark: str) -> DataFrame:
    """Add `mark`: true on one row of each value of `column` within the groups `by`.

    The first of two levels of counting: the number of marked rows is the distinct count, without a distinct
    aggregate. Rows are spread by group and value, so a hot group is as many tasks' work as it has values.
    """
    one = Window.partitionBy(*by, column).orderBy(column)
    return df.withColumn(mark, F.row_number().over(one) == 1)


def counted_in_two_levels(df: DataFrame, by: Sequence[str], columns: Sequence[str], unique: Unique) -> tuple[DataFrame, dict[str, Column]]:
    """`df` with the marks it needs, and the count of each column: all but the last are marked, the last is counted distinct.

    One distinct count is left, so Spark multiplies no row; columns known to be unique are plainly counted.
    """
    open_ones = [c for c in columns if not known_unique(c, unique)]
    counts = {c: how_many(c, unique) for c in columns}
    for c in open_ones[:-1]:
        df = with_first_mark(df, by, c, f"__first_{c}")
        counts[c] = F.count_if(f"__first_{c}")
    return df, counts


def metrics(name_columns: Sequence[str], prefix: str) -> list[str]:
    """Mart columns without the metadata triplet."""
    return [c for c in name_columns if not c.startswith((f"{prefix}_pipeline", f"{prefix}_rule", f"{prefix}_created"))]


def merchant_daily_spend(tx: DataFrame, unique_ids: Unique = False, statuses: Sequence[str] | None = None) -> DataFrame:
    """Transactions, spend and average ticket per merchant and day (all statuses by default)."""
    needed = ("transaction_id", "merchant_id", "transaction_date", "transaction_amount")
    usable = require(tx, needed, "transactions").filter(present(*needed) & (F.col("transaction_amount") >= 0))
    if statuses is not None:
        usable = usable.filter(F.lower("transaction_status").isin(*statuses))
    return usable.groupBy(F.col("transaction_date").alias("business_date"), "merchant_id").agg(
        how_many("transaction_id", unique_ids).alias("transaction_count"),
        money_sum("transaction_amount").alias("gross_spend_amount"),
        money_mean("transaction_amount").alias("average_transaction_amount"),
    )


def merchant_daily_rewards(matches: DataFrame, unique_ids: Unique = False) -> DataFrame:
    """Redemptions and reward cost per merchant and day."""
    needed = (
        "matched_redemption_id", "transaction_id", "merchant_id", "transaction_date", "calculated_reward_amount",
    )
    usable = require(matches, needed, "matches").filter(present(*needed) & (F.col("calculated_reward_amount") >= 0))
    return usable.groupBy(F.col("transaction_date").alias("business_date"), "merchant_id").agg(
        how_many("matched_redemption_id", unique_ids).alias("matched_redemption_count"),
        how_many("transaction_id", unique_ids).alias("redeemed_transaction_count"),
        money_sum("calculated_reward_amount").alias("reward_cost_amount"),
        money_mean("calculated_reward_amount").alias("average_reward_amount"),
    )


MERCHANT_DAILY = {
    "matched_redemption_count": "coalesce(__matched, 0L)",
    "redeemed_transaction_count": "coalesce(__redeemed, 0L)",
    "reward_cost_amount": "coalesce(__reward, 0D)",
    "average_reward_amount": "coalesce(__average_reward, 0D)",
    "merchant_margin_rate": "coalesce(__margin_rate, 0D)",
    "platform_fee_rate": "coalesce(__fee_rate, 0D)",
    "platform_fee_amount": "gross_spend_amount * platform_fee_rate",
    "estimated_merchant_margin_amount": "gross_spend_amount * merchant_margin_rate",
    "merchant_net_after_reward": "estimated_merchant_margin_amount - platform_fee_amount - reward_cost_amount",
    "redemption_rate": ratio_pos("redeemed_transaction_count", "transaction_count"),
}


def merchant_rates(merchants: DataFrame, margin: str, fee: str) -> DataFrame:
    """One pair of rates per merchant."""
    narrow = merchants.select("merchant_id", "merchant_margin_rate", "platform_fee_rate")
    one = first_per_key(narrow, ["merchant_id"])
    return one.select("merchant_id", F.col("merchant_margin_rate").alias(margin), F.col("platform_fee_rate").alias(fee))


def merchant_daily_economics(spend: DataFrame, rewards: DataFrame, merchants: DataFrame) -> DataFrame:
    """Spend with rewards and the merchant's current rates: fee, margin and net per day.

    Both aggregates are already partitioned by merchant and day, so their join does not shuffle.
    """
    rewards = rewards.select(
        *MERCHANT_DAY,
        F.col("matched_redemption_count").alias("__matched"),
        F.col("redeemed_transaction_count").alias("__redeemed"),
        F.col("reward_cost_amount").alias("__reward"),
        F.col("average_reward_amount").alias("__average_reward"),
    )
    rates = merchant_rates(merchants, "__margin_rate", "__fee_rate")
    joined = spend.join(rewards, list(MERCHANT_DAY), "left").join(small_side(rates), "merchant_id", "left")
    return derive(joined, MERCHANT_DAILY).select(*metrics(MERCHANT_DAILY_COLUMNS, "gold"))


def offer_daily_spend(matches: DataFrame, unique_ids: Unique = False) -> DataFrame:
    """Redemptions, redeemed spend and reward cost per offer cell and day."""
    needed = (
        "matched_redemption_id", "transaction_id", "offer_id", "campaign_id", "merchant_id", "transaction_date",
        "transaction_amount", "calculated_reward_amount",
    )
    amounts_ok = (F.col("transaction_amount") >= 0) & (F.col("calculated_reward_amount") >= 0)
    usable = require(matches, needed, "matches").filter(present(*needed) & amounts_ok)
    return usable.groupBy(F.col("transaction_date").alias("business_date"), *CELL[1:]).agg(
        how_many("matched_redemption_id", unique_ids).alias("matched_redemption_count"),
        how_many("transaction_id", unique_ids).alias("redeemed_transaction_count"),
        money_sum("transaction_amount").alias("gross_redeemed_spend_amount"),
        money_sum("calculated_reward_amount").alias("reward_cost_amount"),
        money_mean("transaction_amount").alias("average_redeemed_transaction_amount"),
        money_mean("calculated_reward_amount").alias("average_reward_amount"),
    )


OFFER_DAILY = {"reward_to_redeemed_spend_ratio": ratio_pos("reward_cost_amount", "gross_redeemed_spend_amount")}


def offer_terms(offers: DataFrame) -> DataFrame:
    """One pair of terms per offer, campaign and merchant (the columns they are joined on)."""
    keys = ["offer_id", "campaign_id", "merchant_id"]
    return first_per_key(offers.select(*keys, "minimum_spend_amount", "reward_amount"), keys)


def offer_daily_economics(cells: DataFrame, offers: DataFrame, campaigns: DataFrame) -> DataFrame:
    """Offer cells with the terms of the offer and the campaign."""
    names = campaigns.select("campaign_id", "campaign_name", "campaign_start_date", "campaign_end_date")
    joined = cells.join(small_side(offer_terms(offers)), ["offer_id", "campaign_id", "merchant_id"], "left").join(
        small_side(first_per_key(names, ["campaign_id"])), "campaign_id", "left"
    )
    return derive(joined, OFFER_DAILY).select(*metrics(OFFER_DAILY_COLUMNS, "gold"))


# ---------------------------------------------------------------- funnel and finance summaries


def offer_funnel(impressions: DataFrame, activations: DataFrame, matches: DataFrame) -> DataFrame:
    """Impressions, activations and redemptions per offer cell and day, with rates and breakage.

    The three facts are stacked as narrow rows and counted in one aggregation (partial counts on
    the map side) instead of three aggregates and two outer joins.
    """
    cell = ("offer_id", "campaign_id", "merchant_id")
    none = F.lit(None).cast("double")

    def step(df: DataFrame, day: str, number: int, spend: Column = none, reward: Column = none) -> DataFrame:
        return df.select(
            F.col(day).alias("business_date"), *cell, F.lit(number).alias("step"),
            spend.alias("spend"), reward.alias("reward"),
        )

    stacked = (
        step(impressions, "impression_date", 1)
        .unionByName(step(activations, "activation_date", 2))
        .unionByName(
            step(matches, "transaction_date", 3, F.col("transaction_amount"), F.col("calculated_reward_amount"))
        )
    )
    counted = stacked.groupBy(*CELL).agg(
        F.count_if(F.col("step") == 1).alias("impressions"),
        F.count_if(F.col("step") == 2).alias("activations"),
        F.count_if(F.col("step") == 3).alias("redemptions"),
        F.coalesce(money_sum("spend"), F.lit(0.0)).alias("gross_redeemed_spend"),
        F.coalesce(money_sum("reward"), F.lit(0.0)).alias("reward_cost"),
    )
    return derive(
        counted,
        {
            "activation_rate": ratio_pos("activations", "impressions"),
            "redemption_rate": ratio_pos("redemptions", "activations"),
            "breakage_rate": "1D - redemption_rate",
            "cost_per_redemption": ratio_pos("reward_cost", "redemptions"),
        },
    )


def liability_summary(liability: DataFrame) -> DataFrame:
    """Accrued, paid, reversed and remaining reward liability per day, offer cell and owner."""

    def part(status: str) -> Column:
        amount = F.when(F.col("liability_status") == status, F.col("reward_amount")).otherwise(F.lit(0.0))
        return money_sum(amount)

    grouped = liability.groupBy(F.col("liability_date").alias("business_date"), *CELL[1:], "liability_owner").agg(
        money_sum("reward_amount").alias("reward_amount"),
        money_sum("merchant_funded_amount").alias("merchant_funded_amount"),
        money_sum("platform_funded_amount").alias("platform_funded_amount"),
        part("accrued").alias("accrued_liability"),
        part("paid").alias("paid_liability"),
        part("reversed").alias("reversed_liability"),
    )
    return derive(grouped, {"remaining_liability": "reward_amount - paid_liability - reversed_liability"})


def settlement_summary(settlements: DataFrame) -> DataFrame:
    """Settled money per merchant and day."""
    amounts = (
        "gross_transaction_amount", "platform_fee_amount", "merchant_settlement_amount", "merchant_funded_amount",
        "platform_funded_amount", "merchant_net_after_reward",
    )
    return settlements.groupBy("settlement_date", "merchant_id").agg(
        *(money_sum(c).alias(c) for c in amounts), F.count(F.lit(1)).alias("settlement_count")
    )


def reconciliation_health(recon: DataFrame, large_delta: float = 1.0) -> DataFrame:
    """How well transactions tie out per merchant and day."""
    grouped = recon.groupBy("reconciliation_date", "merchant_id").agg(
        F.count(F.lit(1)).alias("transaction_count"),
        F.count_if(F.col("reconciliation_status") == "matched").alias("matched_count"),
        F.count_if(F.col("reconciliation_status") == "mismatched").alias("mismatched_count"),
        money_sum("settlement_delta").alias("total_settlement_delta"),
        money_mean("settlement_delta").alias("average_settlement_delta"),
        F.count_if(F.abs("settlement_delta") > large_delta).alias("large_delta_count"),
    )
    return derive(grouped, {"match_rate": ratio_pos("matched_count", "transaction_count")})


def abuse_summary(risk_events: DataFrame, matches: DataFrame) -> DataFrame:
    """Risk events per day, merchant, offer and rule with the mean score and the review state."""
    offers = first_per_key(matches.select("transaction_id", "offer_id"), ["transaction_id"])
    joined = risk_events.join(offers, "transaction_id", "left")
    return joined.groupBy(
        "event_date", "merchant_id", "offer_id", "risk_rule_name", "risk_category", "risk_severity"
    ).agg(
        F.count(F.lit(1)).alias("risk_event_count"),
        money_mean("risk_score").alias("average_risk_score"),
        F.count_if(F.col("risk_event_status") == "open").alias("open_event_count"),
        F.count_if(F.col("risk_event_status") == "reviewed").alias("reviewed_event_count"),
    )


def segment_response(impressions: DataFrame, activations: DataFrame, matches: DataFrame, cards: DataFrame) -> DataFrame:
    """Funnel, spend and reward per customer segment.

    Each fact is first reduced to one row per card, so the join to the segments moves cards, not
    events, and a card with very many events arrives as a single row.
    """
    none = F.lit(None).cast("double")
    card = "tokenized_cardmember_id"
    stacked = (
        impressions.select(card, F.lit(1).alias("step"), none.alias("spend"), none.alias("reward"))
        .unionByName(activations.select(card, F.lit(2).alias("step"), none.alias("spend"), none.alias("reward")))
        .unionByName(
            matches.select(
                card, F.lit(3).alias("step"), F.col("transaction_amount").alias("spend"),
                F.col("calculated_reward_amount").alias("reward"),
            )
        )
    )
    per_card = stacked.groupBy(card).agg(
        F.count_if(F.col("step") == 1).alias("impressions"),
        F.count_if(F.col("step") == 2).alias("activations"),
        F.count_if(F.col("step") == 3).alias("redemptions"),
        F.coalesce(money_sum("spend"), F.lit(0.0)).alias("spend"),
        F.coalesce(money_sum("reward"), F.lit(0.0)).alias("reward"),
    )
    joined = per_card.join(cards.select(card, "segment_id"), card, "left")
    grouped = joined.groupBy("segment_id").agg(
        F.count(F.lit(1)).alias("cardmember_count"),
        F.sum("impressions").alias("impressions"),
        F.sum("activations").alias("activations"),
        F.sum("redemptions").alias("redemptions"),
        money_sum("spend").alias("redeemed_spend"),
        money_sum("reward").alias("reward_cost"),
    )
    return derive(
        grouped,
        {
            "activation_rate": ratio_pos("activations", "impressions"),
            "redemption_rate": ratio_pos("redemptions", "activations"),
        },
    )


def category_performance(tx: DataFrame, matches: DataFrame, merchants: DataFrame) -> DataFrame:
    """Spend and redemptions per merchant category, reduced per merchant before the join."""
    spend = tx.groupBy("merchant_id").agg(
        F.count(F.lit(1)).alias("n"), money_sum("transaction_amount").alias("spend")
    )
    rewards = matches.groupBy("merchant_id").agg(
        F.count(F.lit(1)).alias("m"), money_sum("calculated_reward_amount").alias("reward")
    )
    categories = merchants.select("merchant_id", "category_id")
    joined = spend.join(rewards, "merchant_id", "left").join(small_side(categories), "merchant_id", "left")
    grouped = joined.groupBy("category_id").agg(
        F.count(F.lit(1)).alias("merchant_count"),
        F.sum("n").alias("transaction_count"),
        money_sum("spend").alias("gross_spend_amount"),
        F.coalesce(F.sum("m"), F.lit(0)).alias("redemption_count"),
        F.coalesce(money_sum("reward"), F.lit(0.0)).alias("reward_cost_amount"),
    )
    return derive(grouped, {"reward_share_of_spend": ratio_pos("reward_cost_amount", "gross_spend_amount")})
