"""Redemption matching: which activated offer, if any, does a transaction redeem?"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.exprs import derive, lowered_in, prefixed_hash, present, require, time_slice
from ..functions.rules import reward_amount
from ..sources.contracts import MATCH_RULES, MATCHED_COLUMNS
from .cleaning import RANK, first_per_key

# Statuses that can take part, and the text recorded with a chosen match.
TRANSACTION_STATUSES = ("approved", "posted", "settled")
ACTIVATION_STATUSES = ("active", "activated", "eligible")
CHOICE_REASON = "selected_highest_reward_then_earliest_activation_then_offer_id"

TX_NEEDED = (
    "transaction_id", "tokenized_cardmember_id", "merchant_id",
    "transaction_timestamp", "transaction_date", "transaction_amount",
)
ACT_NEEDED = (
    "activation_id", "tokenized_cardmember_id", "offer_id", "activation_timestamp", "offer_expiry_timestamp",
)
RULE_NEEDED = ("offer_id", "campaign_id", "merchant_id", "minimum_spend_amount", "reward_amount")
PERCENT_NEEDED = ("offer_type", "reward_multiplier", "max_reward_amount")

# A side is broadcast only when the optimizer's size for it stays under this many bytes.
BROADCAST_LIMIT = 32 * 1024 * 1024


def small_side(df: DataFrame, limit: int = BROADCAST_LIMIT) -> DataFrame:
    """Broadcast hint behind a size check; a larger side is left to a shuffle join and AQE."""
    plan = getattr(df, "_jdf", None)
    if plan is None:
        return df
    size = int(str(plan.queryExecution().optimizedPlan().stats().sizeInBytes()))
    return F.broadcast(df) if size <= limit else df


def _with_status(df: DataFrame, needed: Sequence[str], status: str, values: Sequence[str]) -> DataFrame:
    if status not in df.columns:
        return df.selectExpr(*needed)
    return df.filter(lowered_in(status, values)).selectExpr(*needed, status)


def match_ready_transactions(tx: DataFrame, statuses: Sequence[str] = TRANSACTION_STATUSES) -> DataFrame:
    """Complete, non-negative purchases in a final status, narrowed to the matching columns."""
    ready = require(tx, TX_NEEDED, "transactions").filter(present(*TX_NEEDED) & (F.col("transaction_amount") >= 0))
    return _with_status(ready, TX_NEEDED, "transaction_status", statuses)


def match_ready_activations(act: DataFrame, statuses: Sequence[str] = ACTIVATION_STATUSES) -> DataFrame:
    """Complete activations whose window is not inverted, in a live status."""
    window_ok = F.col("offer_expiry_timestamp") >= F.col("activation_timestamp")
    ready = require(act, ACT_NEEDED, "activations").filter(present(*ACT_NEEDED) & window_ok)
    return _with_status(ready, ACT_NEEDED, "activation_status", statuses)


def offer_rules(offers: DataFrame) -> DataFrame:
    """One usable rule per offer; the percent columns ride along where the source has them."""
    extra = [c for c in PERCENT_NEEDED if c in offers.columns]
    usable = present(*RULE_NEEDED) & (F.col("minimum_spend_amount") >= 0) & (F.col("reward_amount") >= 0)
    rules = require(offers, RULE_NEEDED, "offers").filter(usable).select(*RULE_NEEDED, *extra)
    return first_per_key(rules, ["offer_id"])


def activation_offers(act: DataFrame, rules: DataFrame) -> DataFrame:
    """Activations with their offer's rule. The rule table is broadcast only if it is small."""
    extra = [c for c in PERCENT_NEEDED if c in rules.columns]
    return act.join(small_side(rules), "offer_id").select(
        "activation_id", "tokenized_cardmember_id", "offer_id", "campaign_id", "merchant_id",
        "activation_timestamp", "offer_expiry_timestamp", "minimum_spend_amount", "reward_amount", *extra,
    )


def activation_terms(act: DataFrame, offers: DataFrame) -> DataFrame:
    """Every activation with the reward terms of its offer; activations of unknown offers stay."""
    wanted = ("offer_type", "minimum_spend_amount", "reward_amount", "reward_multiplier", "max_reward_amount",
              "offer_status")
    terms = first_per_key(offers.select("offer_id", *wanted), ["offer_id"])
    return act.join(small_side(terms), "offer_id", "left")


def _qualifies() -> Column:
    at = F.col("tx.transaction_timestamp")
    return (
        (at >= F.col("act.activation_timestamp"))
        & (at <= F.col("act.offer_expiry_timestamp"))
        & (F.col("tx.transaction_amount") >= F.col("act.minimum_spend_amount"))
    )


def _pair_columns(act: DataFrame) -> list[str]:
    extra = [f"act.{c}" for c in PERCENT_NEEDED if c in act.columns]
    return [f"tx.{c}" for c in TX_NEEDED] + [
        "act.activation_id", "act.offer_id", "act.campaign_id", "act.activation_timestamp",
        "act.offer_expiry_timestamp", "act.minimum_spend_amount", "act.reward_amount", *extra,
    ]


def candidates(tx: DataFrame, act: DataFrame, strategy: str | None = None) -> DataFrame:
    """Every qualifying (transaction, activation) pair.

    Card and merchant are the equi keys, window and minimum spend the residual condition.
    `strategy` is an optional Spark join hint for the activation side ("merge", "shuffle_hash", or
    "broadcast", which is followed only if that side is small); without one Catalyst and AQE
    choose, including the split of skewed partitions.
    """
    if strategy == "broadcast":
        right = small_side(act)
    else:
        right = act.hint(strategy) if strategy else act
    same = (F.col("tx.tokenized_cardmember_id") == F.col("act.tokenized_cardmember_id")) & (
        F.col("tx.merchant_id") == F.col("act.merchant_id")
    )
    return tx.alias("tx").join(right.alias("act"), same & _qualifies()).select(*_pair_columns(act))


def with_reward(pairs: DataFrame, policy: str = "flat") -> DataFrame:
    """Reward of each pair: "flat" pays the offer's fixed amount, "capped" follows the offer type."""
    if policy == "flat":
        return pairs.withColumn("calculated_reward_amount", F.col("reward_amount").cast("double"))
    if policy == "capped":
        return derive(pairs, {"calculated_reward_amount": reward_amount()})
    raise ValueError(f"unknown reward policy: {policy}")


def matched_rows(pairs: DataFrame, run_id: str, policy: str = "flat") -> DataFrame:
    """Redemption rows: deterministic id, reward, lineage."""
    rewarded = pairs if "calculated_reward_amount" in pairs.columns else with_reward(pairs, policy)
    return rewarded.withColumns(
        {
            "matched_redemption_id": prefixed_hash("mred_", ["transaction_id", "activation_id", "offer_id"]),
            "match_rule_version": F.lit(MATCH_RULES),
            "match_pipeline_run_id": F.lit(run_id),
            "matched_at": F.current_timestamp(),
        }
    ).select(*[c for c in MATCHED_COLUMNS if c != "match_deduplication_reason"])


def best_per_transaction(matches: DataFrame) -> DataFrame:
    """Highest reward, then earliest activation, then offer id, then activation id."""
    window = Window.partitionBy("transaction_id").orderBy(
        F.desc("calculated_reward_amount"), "activation_timestamp", "offer_id", "activation_id"
    )
    top = matches.withColumn(RANK, F.row_number().over(window)).filter(F.col(RANK) == 1).drop(RANK)
    return top.withColumn("match_deduplication_reason", F.lit(CHOICE_REASON))


def deciding_windows(act: DataFrame, slice_seconds: int = 3600) -> DataFrame:
    """Cut the activations of each (card, offer) into disjoint windows in which each one decides.

    All activations of one offer pay the same reward, so the earliest one that covers a purchase
    wins. An activation therefore decides only after the latest expiry among those before it;
    one that never does is dropped. What remains has strictly increasing expiries.

    The running maximum has two levels: within a time slice, and over the maxima of the slices.
    No task has to hold more than one slice of a (card, offer), and the second level sees one
    row per slice.
    """
    group = ["tokenized_cardmember_id", "offer_id"]
    sliced = act.withColumn("__slice", time_slice(act, "activation_timestamp", slice_seconds))
    maxima = sliced.groupBy(*group, "__slice").agg(F.max("offer_expiry_timestamp").alias("__max"))
    before = Window.partitionBy(*group).orderBy("__slice").rowsBetween(Window.unboundedPreceding, -1)
    carried = maxima.select(*group, "__slice", F.max("__max").over(before).alias("__carried"))
    inside = (
        Window.partitionBy(*group, "__slice")
        .orderBy("activation_timestamp", "activation_id")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    covered = (
        sliced.withColumn("__covered", F.max("offer_expiry_timestamp").over(inside))
        .join(carried, [*group, "__slice"])
        .withColumn("decides_after", F.greatest("__covered", "__carried"))
    )
    decides = F.col("decides_after").isNull() | (F.col("decides_after") < F.col("offer_expiry_timestamp"))
    return covered.filter(decides).drop("__slice", "__covered", "__carried")


def _same_clock(tx: DataFrame, act: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Zoneless timestamps and instants cannot be ordered together: cast both sides to instants."""
    if tx.schema["transaction_timestamp"].dataType == act.schema["activation_timestamp"].dataType:
        return tx, act
    ends = ("activation_timestamp", "offer_expiry_timestamp")
    return (
        tx.withColumn("transaction_timestamp", F.col("transaction_timestamp").cast("timestamp")),
        act.withColumns({c: F.col(c).cast("timestamp") for c in ends}),
    )


def purchases_per_offer(tx: DataFrame, act: DataFrame, terms: Sequence[str]) -> DataFrame:
    """Each transaction once per offer its card has activated at its merchant and whose minimum it meets."""
    offered = act.select("tokenized_cardmember_id", "merchant_id", "offer_id", *terms).distinct()
    return tx.select(*TX_NEEDED).join(offered, ["tokenized_cardmember_id", "merchant_id"]).filter(
        F.col("transaction_amount") >= F.col("minimum_spend_amount")
    )


def in_busy_slices(act: DataFrame, tx: DataFrame, first: str, last: str, seconds: int) -> DataFrame:
    """Activations once per time slice from `first` to `last` in which their card bought at their merchant.

    The slices of a card and merchant are gathered first, with map-side combining: an array as long
    as the purchases have slices. An open-ended activation therefore adds no row without a purchase.
    """
    pair = ["tokenized_cardmember_id", "merchant_id"]
    busy = tx.groupBy(*pair).agg(F.collect_set(time_slice(tx, "transaction_timestamp", seconds)).alias("__busy"))
    low, high = time_slice(act, first, seconds), time_slice(act, last, seconds)
    bounded = act.withColumns({"__low": low, "__high": high}).join(busy, pair)
    touched = F.filter("__busy", lambda s: (s >= F.col("__low")) & (s <= F.col("__high")))
    return bounded.withColumn("__slice", F.explode(touched)).drop("__busy", "__low", "__high")


def choose(tx: DataFrame, act: DataFrame, policy: str = "flat", slice_days: int = 7) -> DataFrame:
    """The best pair of each transaction, found by sorting instead of by building all pairs.

    1. Each transaction meets the distinct offers its card has activated at its merchant: at most
       one row per offer, however many activations there are.
    2. For each of them the deciding activation is the first window that ends at or after the
       purchase, if it had begun by then. Purchases and windows are stacked and sorted by time;
       a window is repeated in every time slice it touches and the card bought in, so that the
       slices of a (card, offer) are independent and a busy one is spread over many tasks.
    3. The best offer per transaction is ranked, after a map-side limit of one row each.

    Every step is linear in its rows apart from sorting; no step compares all transactions of a
    card and merchant with all of its activations.
    """
    tx, act = _same_clock(tx, act)
    seconds = slice_days * 86400
    group = ["tokenized_cardmember_id", "offer_id"]
    terms = ["campaign_id", "reward_amount", "minimum_spend_amount", *(c for c in PERCENT_NEEDED if c in act.columns)]
    asked = purchases_per_offer(tx, act, terms)
    windows = deciding_windows(act)
    windows = windows.withColumn("__from", F.greatest("activation_timestamp", "decides_after"))
    windows = in_busy_slices(windows, tx, "__from", "offer_expiry_timestamp", seconds)
    window = F.struct("activation_id", "activation_timestamp", "offer_expiry_timestamp")
    purchase = [c for c in TX_NEEDED if c not in group] + terms
    stacked = asked.select(
        *group, time_slice(asked, "transaction_timestamp", seconds).alias("__slice"),
        F.col("transaction_timestamp").alias("__at"), F.struct(*purchase).alias("__tx"),
    ).unionByName(
        windows.select(
            *group, "__slice", F.col("offer_expiry_timestamp").alias("__at"), window.alias("__window"),
        ),
        allowMissingColumns=True,
    )
    # Backwards in time; at the same instant the window comes first, because its end is inclusive.
    backwards = (
        Window.partitionBy(*group, "__slice")
        .orderBy(F.desc("__at"), F.col("__window").isNull())
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    ending = stacked.withColumn("__next", F.last("__window", ignorenulls=True).over(backwards))
    begun = F.col("__tx").isNotNull() & (F.col("__next.activation_timestamp") <= F.col("__at"))
    pairs = ending.filter(begun).select(*group, "__tx.*", "__next.*")
    return best_per_transaction(with_reward(pairs, policy))


def match_redemptions(
    transactions: DataFrame, activations: DataFrame, offers: DataFrame, run_id: str, policy: str = "flat"
) -> DataFrame:
    """The whole matching job as one lazy plan: filters, offer rules, best pair, redemption rows."""
    act = activation_offers(match_ready_activations(activations), offer_rules(offers))
    best = choose(match_ready_transactions(transactions), act, policy)
    rows = matched_rows(best, run_id)
    return rows.withColumn("match_deduplication_reason", F.lit(CHOICE_REASON)).select(*MATCHED_COLUMNS)


def first_redemption(
    transactions: DataFrame, activations: DataFrame, offers: DataFrame, slice_days: int = 7
) -> DataFrame:
    """Redemption fact: the first settled transaction that qualifies for each activation.

    Earliest time, then lowest id. Found by sorting like `choose`: in every time slice it touches
    an activation sees the first purchase at or after its start, and the earliest over its slices
    counts, through an aggregate with map-side combining.
    """
    seconds, group = slice_days * 86400, ["tokenized_cardmember_id", "offer_id"]
    settled = transactions.filter("transaction_status = 'settled'").select(*TX_NEEDED)
    rules = first_per_key(offers.select(*RULE_NEEDED, *PERCENT_NEEDED), ["offer_id"])
    act = activation_offers(activations.select(*ACT_NEEDED), rules)
    settled, act = _same_clock(settled, act)
    act = act.filter(F.col("offer_expiry_timestamp") >= F.col("activation_timestamp"))

    asked = purchases_per_offer(settled, act, ["minimum_spend_amount"])
    purchase = F.struct("transaction_timestamp", "transaction_id", "transaction_date", "transaction_amount")
    own = ["activation_id", "merchant_id", "campaign_id", "reward_amount", *PERCENT_NEEDED, "offer_expiry_timestamp"]
    stacked = asked.select(
        *group, time_slice(asked, "transaction_timestamp", seconds).alias("__slice"),
        F.col("transaction_timestamp").alias("__at"), purchase.alias("__tx"),
    ).unionByName(
        in_busy_slices(act, settled, "activation_timestamp", "offer_expiry_timestamp", seconds).select(
            *group, "__slice", F.col("activation_timestamp").alias("__at"), F.struct(*own).alias("__act"),
        ),
        allowMissingColumns=True,
    )
    # Backwards in time; at the same instant purchases come first (highest id first), then activations.
    backwards = (
        Window.partitionBy(*group, "__slice")
        .orderBy(F.desc("__at"), F.col("__tx").isNull(), F.desc("__tx.transaction_id"))
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    following = stacked.withColumn("__next", F.last("__tx", ignorenulls=True).over(backwards))
    in_time = F.col("__act").isNotNull() & (
        F.col("__next.transaction_timestamp") <= F.col("__act.offer_expiry_timestamp")
    )
    first = following.filter(in_time).select(*group, "__act.*", "__next").drop("offer_expiry_timestamp")
    keys = [*group, *(c for c in own if c != "offer_expiry_timestamp")]
    flat = first.groupBy(*keys).agg(F.min("__next").alias("t")).select(*keys, "t.*")
    return derive(flat, {"calculated_reward_amount": reward_amount()}).select(
        F.concat(F.lit("red_"), F.col("activation_id").cast("string")).alias("redemption_id"),
        "transaction_id", "activation_id", "tokenized_cardmember_id", "offer_id", "campaign_id", "merchant_id",
        F.col("transaction_timestamp").alias("redemption_timestamp"),
        F.col("transaction_date").alias("redemption_date"),
        "transaction_amount", "calculated_reward_amount", F.lit("qualified").alias("redemption_status"),
    )


def candidate_counts(tx: DataFrame, act: DataFrame, slice_days: int = 7) -> DataFrame:
    """How many pairs `candidates` has per transaction and offer, without building them.

    Per (card, offer) and time slice the live activations are a running sum: plus one where one
    begins, minus one after one has ended.
    """
    tx, act = _same_clock(tx, act)
    seconds, group = slice_days * 86400, ["tokenized_cardmember_id", "offer_id"]
    act = act.filter(F.col("offer_expiry_timestamp") >= F.col("activation_timestamp"))
    asked = purchases_per_offer(tx, act, ["minimum_spend_amount"])
    end = F.col("offer_expiry_timestamp")

    def event(df: DataFrame, at: Column, slice_number: Column, turn: int, change: int, key: Column) -> DataFrame:
        return df.select(
            *group, slice_number.alias("__slice"), at.alias("__at"), F.lit(turn).alias("__turn"),
            F.lit(change).alias("__change"), key.alias("transaction_id"),
        )

    none = F.lit(None).cast(tx.schema["transaction_id"].dataType)
    live = in_busy_slices(act, tx, "activation_timestamp", "offer_expiry_timestamp", seconds)
    events = (
        event(live, F.col("activation_timestamp"), F.col("__slice"), 0, 1, none)
        .unionByName(event(asked, F.col("transaction_timestamp"), time_slice(asked, "transaction_timestamp", seconds), 1, 0,
                           F.col("transaction_id")))
        .unionByName(event(act, end, time_slice(act, "offer_expiry_timestamp", seconds), 2, -1, none))
    )
    so_far = (
        Window.partitionBy(*group, "__slice").orderBy("__at", "__turn")
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    live = events.withColumn("candidate_count", F.sum("__change").over(so_far))
    return live.filter((F.col("__turn") == 1) & (F.col("candidate_count") > 0)).select(
        "transaction_id", "offer_id", "candidate_count"
    )
