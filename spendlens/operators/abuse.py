"""Rule-based detection of offer abuse and the risk events it produces."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.exprs import derive, prefixed_hash, present, ratio_pos, time_slice
from ..functions.rules import risk_event_status
from .cleaning import first_per_key
from .matching import small_side


def duplicate_redemptions(redemptions: DataFrame, allowed: int = 1) -> DataFrame:
    """Cards that redeemed one offer more often than allowed."""
    grouped = redemptions.groupBy("tokenized_cardmember_id", "offer_id").agg(
        F.count(F.lit(1)).alias("redemption_count"), F.min("transaction_id").alias("first_transaction_id")
    )
    return grouped.filter(F.col("redemption_count") > allowed)


def refunds_after_reward(tx: DataFrame, liability: DataFrame) -> DataFrame:
    """Refunded or reversed transactions for which a reward was created."""
    returned = tx.filter(F.col("transaction_status").isin("refunded", "reversed")).select(
        "transaction_id", "transaction_status", "transaction_amount"
    )
    rewards = liability.select(
        "transaction_id", "reward_liability_id", "tokenized_cardmember_id", "merchant_id", "reward_amount"
    )
    return rewards.join(returned, "transaction_id")


def redemption_velocity(
    events: DataFrame, time: str, window_seconds: int, threshold: int, card: str = "tokenized_cardmember_id",
    key: str = "transaction_id", parts: int = 24,
) -> DataFrame:
    """Events that are at least the `threshold`-th of their card within the trailing window.

    An event adds one to its card's count when it happens and takes one away just after the window has passed. The
    running sum of these steps is taken in time slices, `parts` to a window, and each slice starts from what
    the slices before it add up to. So a burst of one card is spread over as many tasks as it fills slices, even
    within one window. Events without a card or time have no window.
    """
    rows = events.select(card, key, time).filter(present(card, time))
    seconds = max(1, window_seconds // parts)
    steps = rows.withColumn("__step", F.lit(1)).unionByName(
        rows.select(card, F.lit(None).cast(rows.schema[key].dataType).alias(key),
                    (F.col(time) + F.expr(f"INTERVAL '{window_seconds}.000001' SECOND")).alias(time), F.lit(-1).alias("__step")))
    sliced = steps.withColumn("__slice", time_slice(steps, time, seconds))
    within = F.sum("__step").over(Window.partitionBy(card, "__slice").orderBy(time))  # events of one time count together
    sizes = sliced.groupBy(card, "__slice").agg(F.sum("__step").alias("__n"))
    before = Window.partitionBy(card).orderBy("__slice").rowsBetween(Window.unboundedPreceding, -1)
    carried = sizes.select(card, "__slice", F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__carried"))
    counted = sliced.withColumn("__within", within).filter("__step > 0").join(carried, [card, "__slice"])
    out = counted.select(card, key, time, (F.col("__within") + F.col("__carried")).alias("events_in_window"))
    return out.filter(F.col("events_in_window") >= threshold)


def location_anomalies(tx: DataFrame, merchants: DataFrame, max_locations: int) -> DataFrame:
    """Cards that bought in more merchant locations in one day than `max_locations`."""
    places = merchants.select("merchant_id", "location_id")
    per_day = (
        tx.select("tokenized_cardmember_id", "merchant_id", "transaction_date")
        .join(small_side(places), "merchant_id")
        .groupBy("tokenized_cardmember_id", "transaction_date")
        .agg(F.countDistinct("location_id").alias("location_count"), F.count(F.lit(1)).alias("transaction_count"))
    )
    return per_day.filter(F.col("location_count") > max_locations)


def reward_gaming(tx: DataFrame, matches: DataFrame, min_redemptions: int, min_share: float) -> DataFrame:
    """Cards whose purchases are mostly redemptions: behaviour aimed at rewards."""
    card = "tokenized_cardmember_id"
    stacked = tx.select(card, F.lit(0).alias("redeemed")).unionByName(matches.select(card, F.lit(1).alias("redeemed")))
    grouped = stacked.groupBy(card).agg(
        F.count_if(F.col("redeemed") == 0).alias("transaction_count"),
        F.count_if(F.col("redeemed") == 1).alias("redemption_count"),
    )
    shared = derive(grouped, {"redemption_share": ratio_pos("redemption_count", "transaction_count")})
    return shared.filter((F.col("redemption_count") >= min_redemptions) & (F.col("redemption_share") >= min_share))


def risk_events(hits: DataFrame, rules: DataFrame, redemptions: DataFrame) -> DataFrame:
    """Risk event rows from detected hits (transaction, card, merchant, time, rule name, score)."""
    rule = rules.filter("is_active").select(
        "risk_rule_id", "risk_rule_name", "risk_category", F.col("severity").alias("risk_severity"),
        F.col("risk_rule_description").alias("risk_event_description"),
    )
    redeemed = first_per_key(redemptions.select("transaction_id", "redemption_id"), ["transaction_id"])
    joined = hits.join(small_side(rule), "risk_rule_name").join(redeemed, "transaction_id", "left")
    return derive(joined, {"risk_event_status": risk_event_status()}).select(
        prefixed_hash("fraud_", ["transaction_id", "risk_rule_id"]).alias("fraud_event_id"),
        "transaction_id", "redemption_id", "tokenized_cardmember_id", "merchant_id", "risk_rule_id",
        "risk_rule_name", "risk_category", "risk_severity", "risk_score",
        F.col("transaction_timestamp").alias("event_timestamp"), F.col("transaction_date").alias("event_date"),
        "risk_event_status", "risk_event_description",
    )


# From how much evidence on a rule speaks. Velocity counts events a day, a location anomaly places a day.
LIMITS = {
    "duplicate_redemption": 1, "high_redemption_velocity": 5, "merchant_location_anomaly": 2, "reward_gaming_pattern": 2,
}
DAY_SECONDS, GAMING_SHARE = 86_400, 0.1


def detected_hits(
    tx: DataFrame, redemptions: DataFrame, liability: DataFrame, merchants: DataFrame, limits: Mapping[str, int] = LIMITS,
    gaming_share: float = GAMING_SHARE,
) -> DataFrame:
    """transaction_id, risk_rule_name, evidence, risk_score: every transaction that one of the five rules points at.

    Duplicates: redemptions of an offer by one card after its first. Refunds: refunded or reversed transactions with a
    reward. Velocity: redemptions that are the limit-th of their card within a day, or a later one. Location: transactions of a card's
    day in more places than the limit. Gaming: redemptions of cards that buy for rewards. A transaction has one
    row for each rule, with its strongest evidence; the score is 0.6 at the limit and 0.1 more for each step beyond, up to 1.
    `redemptions` have transaction_id, tokenized_cardmember_id, offer_id and transaction_timestamp.
    """
    card = "tokenized_cardmember_id"

    def hits(df: DataFrame, rule: str, evidence: Column) -> DataFrame:
        return df.select("transaction_id", F.lit(rule).alias("risk_rule_name"), evidence.cast("double").alias("evidence"))

    repeated = redemptions.groupBy(card, "offer_id").agg(
        F.count("*").alias("n"), F.min(F.struct("transaction_timestamp", "transaction_id")).alias("first"),
    ).filter(F.col("n") > limits["duplicate_redemption"])
    again = redemptions.join(repeated, [card, "offer_id"]).filter(F.col("transaction_id") != F.col("first.transaction_id"))
    places = location_anomalies(tx, merchants, limits["merchant_location_anomaly"])
    gaming = reward_gaming(tx, redemptions, limits["reward_gaming_pattern"], gaming_share)
    speed = redemption_velocity(redemptions, "transaction_timestamp", DAY_SECONDS, limits["high_redemption_velocity"])
    stream = reduce(DataFrame.unionByName, [
        hits(again, "duplicate_redemption", F.col("n") - limits["duplicate_redemption"]),
        hits(refunds_after_reward(tx, liability), "refund_after_reward", F.lit(4)),
        hits(speed, "high_redemption_velocity", F.col("events_in_window") - limits["high_redemption_velocity"] + 1),
        hits(tx.join(places.select(card, "transaction_date", "location_count"), [card, "transaction_date"]),
             "merchant_location_anomaly", F.col("location_count") - limits["merchant_location_anomaly"]),
        hits(redemptions.join(gaming.select(card, "redemption_count"), card),
             "reward_gaming_pattern", F.col("redemption_count") - limits["reward_gaming_pattern"] + 1),
    ])
    one = stream.groupBy("transaction_id", "risk_rule_name").agg(F.max("evidence").alias("evidence"))
    return one.withColumn("risk_score", F.round(F.least(0.5 + 0.1 * F.col("evidence"), F.lit(1.0)), 4))


def detected_events(
    tx: DataFrame, redemptions: DataFrame, liability: DataFrame, merchants: DataFrame, rules: DataFrame, redeemed: DataFrame,
) -> DataFrame:
    """Risk events from detection: one for each transaction and active rule."""
    found = detected_hits(tx, redemptions, liability, merchants)
    about = tx.select("transaction_id", "tokenized_cardmember_id", "merchant_id", "transaction_timestamp", "transaction_date")
    return risk_events(found.join(about, "transaction_id"), rules, redeemed)
